"""Evaluation of scored frames: columns ``label`` (0/1), ``prediction`` (0/1) and ``score``.

``by`` lists group columns, for metrics per split, model or region. Counting metrics are one
aggregate. Curves and the area under them first reduce to one row per distinct score.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambar.fixed import CRITICAL_RISK, CUTS, RISK_EDGES, RISK_LABELS
from ambar.functions.scalars import bands, no_nan, ratio, share
from ambar.operators.profile import with_percent
from ambar.operators.running import next_values, running_totals, with_rank
from ambar.session import materialise


def _cells() -> tuple[Column, Column, Column, Column]:
    return F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")


def _rates() -> dict[str, Column]:
    """Metrics of the positive class from the four counts; 0 where undefined."""
    tn, fp, fn, tp = _cells()
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
    }


def confusion_counts(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row (per group) with tn, fp, fn, tp."""

    def cell(label: int, prediction: int) -> Column:
        return F.count(F.when((F.col("label") == label) & (F.col("prediction") == prediction), 1))

    return scored.groupBy(*(by or [])).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """All four cells as rows: label, prediction, n, and the share within the label."""
    tn, fp, fn, tp = _cells()
    cells = F.array(
        *[
            F.struct(
                F.lit(label).alias("label"),
                F.lit(prediction).alias("prediction"),
                n.alias("n"),
                share(n, total).alias("share_of_label"),
            )
            for label, prediction, n, total in [
                (0, 0, tn, tn + fp), (0, 1, fp, tn + fp), (1, 0, fn, fn + tp), (1, 1, tp, fn + tp),
            ]
        ]
    )
    return confusion_counts(scored).select(F.inline(cells))


def basic_metrics(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """accuracy, precision, recall and f1_score of the positive class; 0 where undefined."""
    return confusion_counts(scored, by).select(
        *(by or []), *[rate.alias(name) for name, rate in _rates().items()]
    )


def sensitivity_specificity(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    tn, fp, fn, tp = _cells()
    return confusion_counts(scored, by).select(
        *(by or []), share(tp, tp + fn).alias("sensitivity"), share(tn, tn + fp).alias("specificity")
    )


def score_counts(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Positives and negatives per distinct score."""
    return (
        scored.where(F.col("score").isNotNull())
        .groupBy(*(by or []), "score")
        .agg(*_classes())
    )


def roc_auc(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve, exact, tied scores counting one half; NULL with one class only."""
    run = running_totals(score_counts(scored, by), ["score"], ["pos", "neg"], by)
    won = F.col("pos") * (F.col("neg_run") - F.col("neg") / 2)
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return run.groupBy(*(by or [])).agg(F.try_divide(F.sum(won), F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def metrics(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Basic metrics and the area under the ROC curve."""
    basic, area = basic_metrics(scored, by), roc_auc(scored, by)
    if by:
        # Joined on a struct, so that a missing group value finds its own area.
        group = F.struct(*by)
        areas = area.select(group.alias("_group"), "roc_auc")
        return basic.withColumn("_group", group).join(areas, "_group", "left").drop("_group")
    return basic.withColumn("roc_auc", area.scalar())


def roc_curve(scored: DataFrame) -> DataFrame:
    """fpr, tpr, threshold at every distinct score, and the start (0, 0) at an infinite threshold."""
    run = running_totals(score_counts(scored), [F.desc("score")], ["pos", "neg"])
    points = run.select(
        share(F.col("neg_run"), F.col("neg_total")).alias("fpr"),
        share(F.col("pos_run"), F.col("pos_total")).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    start = scored.sparkSession.range(1).select(
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold")
    )
    return points.unionByName(start)


def roc_curve_compact(scored: DataFrame) -> DataFrame:
    """The corners of the ROC curve: points on a straight line between their neighbours are left out.

    The area under it is that of the full curve. A point goes if the counts of its score and of the next lower one point
    in the same direction; the neighbour is found in even slices, not in a single-task window.
    """
    run = running_totals(score_counts(scored), [F.desc("score")], ["pos", "neg"])
    run = next_values(run, [F.desc("score")], ["pos", "neg"])
    straight = F.col("pos") * F.col("next_neg") == F.col("next_pos") * F.col("neg")
    corners = run.where(F.col("next_pos").isNull() | ~straight).select(
        share(F.col("neg_run"), F.col("neg_total")).alias("fpr"), share(F.col("pos_run"), F.col("pos_total")).alias("tpr"), F.col("score").alias("threshold"),
    )
    start = scored.sparkSession.range(1).select(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold"))
    return corners.unionByName(start)


def curve_area(curve: DataFrame) -> DataFrame:
    """Area under a curve of (fpr, tpr, threshold) points by trapezoids."""
    ahead = next_values(curve, [F.desc("threshold")], ["fpr", "tpr"])
    strip = (F.col("next_fpr") - F.col("fpr")) * (F.col("next_tpr") + F.col("tpr")) / 2
    return ahead.agg(F.sum(strip).alias("area"), F.count("*").alias("n_points"))


def metrics_rollup(scored: DataFrame, by: list[str]) -> DataFrame:
    """Basic metrics per combination of ``by``, per prefix of it, and in total, from one scan.

    ``level`` is the number of group columns that a row keeps; those it sums over are NULL. (A group whose value is missing
    is NULL too, at its own level.)
    """
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    counts = [F.count(F.when((F.col("label") == label) & (F.col("prediction") == p), 1)).alias(name) for name, (label, p) in cells.items()]
    level = sum((1 - F.grouping(c) for c in by[1:]), 1 - F.grouping(by[0])).cast("int").alias("level")
    rolled = scored.rollup(*by).agg(level, F.count("*").alias("n_rows"), *counts)
    return rolled.select(*by, "level", "n_rows", *[rate.alias(name) for name, rate in _rates().items()])


def leakage_screen(df: DataFrame, label: str, columns: list[str], suspect: float = 0.95) -> DataFrame:
    """How well each column alone tells the label: (column, n_known, roc_auc, separation, suspicious), strongest first.

    The areas of all columns come from one scan: rows are turned into (column, value), counted by value, and totalled per
    column in even slices. Text columns count by the label rate of their values, as a tree would split them; that favours
    columns of many values (ids), which are just what has to be looked at. ``separation`` is the area, or one less it.
    """
    kinds = dict(df.dtypes)
    numbers, texts = [c for c in columns if kinds[c] != "string"], [c for c in columns if kinds[c] == "string"]
    value = lambda c: no_nan(F.col(f"`{c}`").cast("double"))
    parts = []
    if numbers:
        entries = F.array(*[F.struct(F.lit(c).alias("column"), value(c).alias("score")) for c in numbers])
        parts.append(df.select(F.inline(entries), F.col(label).alias("label")).where("score IS NOT NULL").groupBy("column", "score").agg(*_classes()))
    if texts:
        entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in texts])
        counted = df.select(F.inline(entries), F.col(label).alias("label")).where("value IS NOT NULL").groupBy("column", "value").agg(*_classes())
        rate = share(F.col("pos"), F.col("pos") + F.col("neg"))
        parts.append(counted.withColumn("score", rate).where("score IS NOT NULL").groupBy("column", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    run = running_totals(reduce(DataFrame.unionByName, parts), ["score"], ["pos", "neg"], ["column"])
    won = F.col("pos") * (F.col("neg_run") - F.col("neg") / 2)
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    areas = run.groupBy("column").agg(F.sum(F.col("pos") + F.col("neg")).alias("n_known"), F.try_divide(F.sum(won), F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))
    apart = F.greatest(F.col("roc_auc"), 1 - F.col("roc_auc"))
    return areas.select("*", apart.alias("separation"), (apart >= suspect).alias("suspicious")).orderBy(F.desc("separation"), "column")


def _classes() -> tuple[Column, Column]:
    return F.count(F.when(F.col("label") == 1, 1)).alias("pos"), F.count(F.when(F.col("label") == 0, 1)).alias("neg")


def metrics_by_threshold(scored: DataFrame) -> DataFrame:
    """precision, recall and f1_score when every distinct score in turn is the cut."""
    run = running_totals(score_counts(scored), [F.desc("score")], ["pos", "neg"])
    precision = share(F.col("pos_run"), F.col("pos_run") + F.col("neg_run"))
    recall = share(F.col("pos_run"), F.col("pos_total"))
    points = run.select(F.col("score").alias("threshold"), precision.alias("precision"), recall.alias("recall"))
    # The small constant keeps the ratio defined at P = R = 0, as in the usual chart code.
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(1e-10))
    return points.withColumn("f1_score", f1)


def pr_curve(scored: DataFrame) -> DataFrame:
    """precision, recall, threshold at every distinct score, and the end point (1, 0)."""
    end = scored.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return metrics_by_threshold(scored).drop("f1_score").unionByName(end)


def best_f1(scored: DataFrame) -> DataFrame:
    """The cut with the highest F1; the lowest such cut on ties."""
    return metrics_by_threshold(scored).orderBy(F.desc("f1_score"), "threshold").limit(1)


def classification_report(scored: DataFrame, names: tuple[str, str] = ("0", "1")) -> DataFrame:
    """precision, recall, f1_score and support per class, with accuracy, macro and weighted averages."""
    tn, fp, fn, tp = _cells()
    rates, n0, n1 = _rates(), tn + fp, fn + tp
    accuracy = rates["accuracy"]
    per_class = [
        (names[0], ratio(tn, tn + fn), ratio(tn, n0), ratio(2 * tn, 2 * tn + fp + fn), n0),
        (names[1], rates["precision"], rates["recall"], rates["f1_score"], n1),
    ]
    (_, p0, r0, f0, _), (_, p1, r1, f1, _) = per_class
    total = n0 + n1

    def weighted(a: Column, b: Column) -> Column:
        return ratio(a * n0 + b * n1, total)

    lines = per_class + [
        ("accuracy", accuracy, accuracy, accuracy, total),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        ("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), total),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"), n.alias("support")
        )
        for name, p, r, f, n in lines
    ]
    return confusion_counts(scored).select(F.inline(F.array(*rows)))


def majority_baseline(scored: DataFrame) -> DataFrame:
    """Accuracy of always answering the most frequent class."""
    positive, negative = F.count(F.when(F.col("label") == 1, 1)), F.count(F.when(F.col("label") == 0, 1))
    return scored.agg(share(F.greatest(positive, negative), positive + negative).alias("majority_accuracy"))


def threshold_sweep(scored: DataFrame, cuts: list[float] = CUTS) -> DataFrame:
    """Accuracy at each cut (``score >= cut``). All cuts in one pass over the rows."""
    known = scored.where(F.col("score").isNotNull())
    right = [
        F.struct(
            F.lit(cut).alias("threshold"),
            share(
                F.count(F.when((F.col("score") >= cut).cast("int") == F.col("label"), 1)), F.count("*")
            ).alias("accuracy"),
        )
        for cut in cuts
    ]
    return known.agg(F.array(*right).alias("rows")).select(F.inline("rows"))


def best_threshold(validation: DataFrame, cuts: list[float] = CUTS) -> DataFrame:
    """The cut with the best accuracy, the lowest one on ties; 0.5 if no cut gets a row right.

    Give a validation frame (for instance out-of-fold train scores), not the frame to be reported.
    """
    best = threshold_sweep(validation, cuts).orderBy(F.desc("accuracy"), "threshold").limit(1)
    return best.withColumn("threshold", F.when(F.col("accuracy") > 0, F.col("threshold")).otherwise(0.5))


def apply_cut(scored: DataFrame, cut: Column | float) -> DataFrame:
    """Predictions at another cut."""
    cut = F.lit(cut) if isinstance(cut, (int, float)) else cut
    return scored.withColumn("prediction", (F.col("score") >= cut).cast("int"))


def compare_models(models: list[tuple[str, DataFrame]]) -> DataFrame:
    """Metrics of several scored frames, and the gain over the first in percentage points."""
    tagged = [f.select("label", "prediction", "score", F.lit(name).alias("model")) for name, f in models]
    table = materialise(metrics(reduce(DataFrame.unionByName, tagged), ["model"]))
    base = table.where(F.col("model") == models[0][0])
    return table.select(
        "*",
        ((F.col("accuracy") - base.select("accuracy").scalar()) * 100).alias("gain_accuracy_pp"),
        ((F.col("roc_auc") - base.select("roc_auc").scalar()) * 100).alias("gain_auc_pp"),
    )


def risk_bands(scored: DataFrame) -> DataFrame:
    """Rows per risk band of the literacy score, with percentages."""
    banded = scored.where(F.col("score").isNotNull()).select(bands("score", RISK_EDGES, RISK_LABELS).alias("risk"))
    return with_percent(banded.groupBy("risk").agg(F.count("*").alias("n")))


def critical_count(scored: DataFrame, below: float = CRITICAL_RISK) -> DataFrame:
    """Rows at critical risk, out of all scored rows."""
    return scored.agg(
        F.count(F.when(F.col("score") < below, 1)).alias("n_critical"), F.count("score").alias("n_scored")
    )


def group_alert(scored: DataFrame, group: list[str], below: float = CRITICAL_RISK) -> DataFrame:
    """Mean score and critical rows per group, ranked with the lowest mean first."""
    alert = scored.groupBy(*group).agg(
        F.avg("score").alias("mean_score"),
        F.count(F.when(F.col("score") < below, 1)).alias("n_critical"),
        F.count("*").alias("n_rows"),
    )
    return with_rank(alert, "mean_score", "rank")
