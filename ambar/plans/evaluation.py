"""Queries over scored frames, with attendance as a deterministic score."""

from __future__ import annotations

from pyspark.sql import functions as F

from ambar.fixed import CUTS
from ambar.operators import evaluate, profile, splits
from ambar.plans.oracle import near, near_columns, sql
from ambar.sources import tpch

TRAIN, TEST = tpch.TRAIN_YEAR, tpch.TEST_YEAR
METRICS = ["accuracy", "precision", "recall", "f1_score"]
CUT_MODELS = [("cut_030", 0.3), ("cut_050", 0.5), ("cut_070", 0.7)]


def scored(spark, sf_dir):
    return tpch.scored(tpch.alunos(spark, sf_dir))


def split_scored(spark, sf_dir):
    pupils = tpch.alunos(spark, sf_dir, (TRAIN, TEST))
    return splits.with_split(tpch.scored(pupils), "ano", TRAIN, TEST)


def metrics_basic(spark, sf_dir):
    return near_columns(evaluate.basic_metrics(scored(spark, sf_dir)), *METRICS)


def roc_auc(spark, sf_dir):
    return near_columns(evaluate.roc_auc(scored(spark, sf_dir)), "roc_auc")


def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(scored(spark, sf_dir)).drop("share_of_label")


def confusion_norm(spark, sf_dir):
    return near_columns(evaluate.confusion_matrix(scored(spark, sf_dir)).drop("n"), "share_of_label")


def sens_spec(spark, sf_dir):
    return near_columns(evaluate.sensitivity_specificity(scored(spark, sf_dir)), "sensitivity", "specificity")


def roc_curve(spark, sf_dir):
    return evaluate.roc_curve(scored(spark, sf_dir))


def pr_curve(spark, sf_dir):
    return evaluate.pr_curve(scored(spark, sf_dir))


def metrics_vs_threshold(spark, sf_dir):
    return near_columns(evaluate.metrics_by_threshold(scored(spark, sf_dir)), "f1_score")


def best_f1(spark, sf_dir):
    return near_columns(evaluate.best_f1(scored(spark, sf_dir)), "f1_score")


def classification_report(spark, sf_dir):
    out = evaluate.classification_report(scored(spark, sf_dir), ("nao_alfabetizado", "alfabetizado"))
    return near_columns(out, "precision", "recall", "f1_score")


def metrics_by_split(spark, sf_dir):
    return near_columns(evaluate.metrics(split_scored(spark, sf_dir), ["split"]), *METRICS, "roc_auc")


def metrics_by_group(spark, sf_dir):
    return near_columns(evaluate.basic_metrics(scored(spark, sf_dir), ["rede"]), *METRICS)


def model_comparison(spark, sf_dir):
    base = scored(spark, sf_dir)
    out = evaluate.compare_models([(name, evaluate.apply_cut(base, cut)) for name, cut in CUT_MODELS])
    return near_columns(out, *METRICS, "roc_auc", "gain_accuracy_pp", "gain_auc_pp")


def majority_baseline(spark, sf_dir):
    return near_columns(evaluate.majority_baseline(scored(spark, sf_dir)), "majority_accuracy")


def threshold_sweep(spark, sf_dir):
    return near_columns(evaluate.threshold_sweep(scored(spark, sf_dir)), "accuracy")


def best_threshold(spark, sf_dir):
    return near_columns(evaluate.best_threshold(scored(spark, sf_dir)), "accuracy")


def metrics_at_best(spark, sf_dir):
    """The cut is chosen on the train edition and reported on the test edition."""
    both = split_scored(spark, sf_dir)
    test = both.where("split = 'test'")
    cut = evaluate.best_threshold(both.where("split = 'train'")).first()["threshold"]
    out = evaluate.compare_models([("cut_default", test), ("cut_tuned", evaluate.apply_cut(test, cut))])
    return near_columns(
        out.withColumn("threshold", F.when(F.col("model") == "cut_default", 0.5).otherwise(cut)),
        *METRICS, "roc_auc", "gain_accuracy_pp", "gain_auc_pp",
    )


def risk_bands(spark, sf_dir):
    return near_columns(evaluate.risk_bands(scored(spark, sf_dir)), "pct")


def risk_critical(spark, sf_dir):
    return evaluate.critical_count(scored(spark, sf_dir))


def score_histogram(spark, sf_dir):
    return near_columns(profile.histogram(scored(spark, sf_dir), "score", 30, 0.5), "lower", "upper")


def school_alert(spark, sf_dir):
    # The mean is rounded before ranking would matter; rank and mean are both shown.
    return near_columns(evaluate.group_alert(scored(spark, sf_dir), ["id_escola", "ano"]), "mean_score")


QUERIES = {
    "metrics_basic": metrics_basic,
    "roc_auc": roc_auc,
    "confusion_matrix": confusion_matrix,
    "confusion_norm": confusion_norm,
    "sens_spec": sens_spec,
    "roc_curve": roc_curve,
    "pr_curve": pr_curve,
    "metrics_vs_threshold": metrics_vs_threshold,
    "best_f1": best_f1,
    "classification_report": classification_report,
    "metrics_by_split": metrics_by_split,
    "metrics_by_group": metrics_by_group,
    "model_comparison": model_comparison,
    "majority_baseline": majority_baseline,
    "threshold_sweep": threshold_sweep,
    "best_threshold": best_threshold,
    "metrics_at_best": metrics_at_best,
    "risk_bands": risk_bands,
    "risk_critical": risk_critical,
    "score_histogram": score_histogram,
    "school_alert": school_alert,
}

COUNTS = """count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp"""


def _div(top: str, bottom: str) -> str:
    return f"(({top})::DOUBLE / nullif({bottom}, 0))"


def _zero(top: str, bottom: str) -> str:
    return f"coalesce({_div(top, bottom)}, 0)"


BASIC = {
    "accuracy": _zero("tp + tn", "tp + tn + fp + fn"),
    "precision": _zero("tp", "tp + fp"),
    "recall": _zero("tp", "tp + fn"),
    "f1_score": _zero("2 * tp", "2 * tp + fp + fn"),
}
BASIC_SQL = ", ".join(f"{near(v)} AS {k}" for k, v in BASIC.items())


def _auc(source: str, by: str) -> dict[str, str]:
    """Rank-sum area per group, as extra views ending in ``area``."""
    return {
        "by_score": f"""SELECT {by} AS g, score, count(*) FILTER (WHERE label = 1) AS pos,
            count(*) FILTER (WHERE label = 0) AS neg FROM {source} GROUP BY ALL""",
        "below": "SELECT *, sum(neg) OVER (PARTITION BY g ORDER BY score) - neg / 2.0e0 AS won FROM by_score",
        "area": "SELECT g, sum(pos * won) / nullif(sum(pos)::DOUBLE * sum(neg), 0) AS roc_auc FROM below GROUP BY g",
    }


CURVE = {
    "by_score": """SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
        FROM scored GROUP BY score""",
    "run": """SELECT score AS threshold, (sum(pos) OVER d)::DOUBLE AS tp, (sum(neg) OVER d)::DOUBLE AS fp,
        sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM by_score WINDOW d AS (ORDER BY score DESC)""",
    "pts": "SELECT threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM run",
    "f1": "SELECT *, 2 * precision * recall / (precision + recall + 1e-10) AS f1_score FROM pts",
}
SPLIT_SQL = f"SELECT *, CASE ano WHEN {TRAIN} THEN 'train' ELSE 'test' END AS split FROM scored WHERE ano IN ({TRAIN}, {TEST})"


def _sweep(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {c!r}::DOUBLE AS threshold, "
        f"count(*) FILTER (WHERE (score >= {c!r}::DOUBLE)::INT = label)::DOUBLE / count(*) AS accuracy FROM {source}"
        for c in CUTS
    )


P0, R0, F0 = _zero("tn", "tn + fn"), _zero("tn", "tn + fp"), _zero("2 * tn", "2 * tn + fp + fn")


def _report_line(name: str, p: str, r: str, f: str, n: str) -> str:
    return f"SELECT '{name}' AS class, {near(p)} AS precision, {near(r)} AS recall, {near(f)} AS f1_score, {n} AS support FROM c"


def _weighted(a: str, b: str) -> str:
    return f"({a} * (tn + fp) + {b} * (fn + tp)) / (tn + fp + fn + tp)"


P1, R1, F1, ACC = BASIC["precision"], BASIC["recall"], BASIC["f1_score"], BASIC["accuracy"]
ALL = "tn + fp + fn + tp"
CELLS = [(0, 0, "tn", "tn + fp"), (0, 1, "fp", "tn + fp"), (1, 0, "fn", "fn + tp"), (1, 1, "tp", "fn + tp")]


def _compare(models: list[tuple[str, str, str]], extra: str = "") -> dict[str, str]:
    """Views ending in ``table``: metrics per (name, prediction, source), then gains over the first."""
    tagged = " UNION ALL ".join(
        f"SELECT '{name}' AS model, label, score, ({prediction})::INT AS prediction FROM {source}" for name, prediction, source in models
    )
    return {
        "tagged": tagged,
        "c": f"SELECT model, {COUNTS} FROM tagged GROUP BY model",
        **_auc("tagged", "model"),
        "metric": f"SELECT model, {', '.join(f'{v} AS {k}' for k, v in BASIC.items())}, roc_auc FROM c JOIN area ON g = model",
    }


def _compare_body(first: str, extra: str = "") -> str:
    shown = ", ".join(f"{near('m.' + k)} AS {k}" for k in [*BASIC, "roc_auc"])
    return f"""SELECT m.model, {shown}, {near('(m.accuracy - b.accuracy) * 100')} AS gain_accuracy_pp,
        {near('(m.roc_auc - b.roc_auc) * 100')} AS gain_auc_pp{extra} FROM metric m CROSS JOIN (SELECT * FROM metric WHERE model = '{first}') b"""


TUNED = "(SELECT threshold FROM best)"

ORACLES = {
    "metrics_basic": sql("scored", c=f"SELECT {COUNTS} FROM scored", body=f"SELECT {BASIC_SQL} FROM c"),
    "roc_auc": sql("scored", **_auc("scored", "0"), body=f"SELECT {near('roc_auc')} AS roc_auc FROM area"),
    "confusion_matrix": sql(
        "scored", c=f"SELECT {COUNTS} FROM scored",
        body=" UNION ALL ".join(f"SELECT {a} AS label, {b} AS prediction, {n} AS n FROM c" for a, b, n, _ in CELLS),
    ),
    "confusion_norm": sql(
        "scored", c=f"SELECT {COUNTS} FROM scored",
        body=" UNION ALL ".join(
            f"SELECT {a} AS label, {b} AS prediction, {near(_div(n, t))} AS share_of_label FROM c" for a, b, n, t in CELLS
        ),
    ),
    "sens_spec": sql(
        "scored", c=f"SELECT {COUNTS} FROM scored",
        body=f"SELECT {near(_div('tp', 'tp + fn'))} AS sensitivity, {near(_div('tn', 'tn + fp'))} AS specificity FROM c",
    ),
    "roc_curve": sql(
        "scored", **CURVE,
        body="SELECT fp / n AS fpr, tp / p AS tpr, threshold FROM run UNION ALL SELECT 0e0, 0e0, 'infinity'::DOUBLE",
    ),
    "pr_curve": sql(
        "scored", **CURVE,
        body="SELECT precision, recall, threshold FROM pts UNION ALL SELECT 1e0, 0e0, NULL",
    ),
    "metrics_vs_threshold": sql(
        "scored", **CURVE, body=f"SELECT threshold, precision, recall, {near('f1_score')} AS f1_score FROM f1"
    ),
    "best_f1": sql(
        "scored", **CURVE,
        body=f"SELECT threshold, precision, recall, {near('f1_score')} AS f1_score FROM f1 ORDER BY f1.f1_score DESC, threshold LIMIT 1",
    ),
    "classification_report": sql(
        "scored", c=f"SELECT {COUNTS} FROM scored",
        body=" UNION ALL ".join(
            [
                _report_line("nao_alfabetizado", P0, R0, F0, "tn + fp"),
                _report_line("alfabetizado", P1, R1, F1, "fn + tp"),
                _report_line("accuracy", ACC, ACC, ACC, ALL),
                _report_line("macro avg", f"({P0} + {P1}) / 2", f"({R0} + {R1}) / 2", f"({F0} + {F1}) / 2", ALL),
                _report_line("weighted avg", _weighted(P0, P1), _weighted(R0, R1), _weighted(F0, F1), ALL),
            ]
        ),
    ),
    "metrics_by_split": sql(
        "scored", s=SPLIT_SQL, c=f"SELECT split, {COUNTS} FROM s GROUP BY split", **_auc("s", "split"),
        body=f"SELECT split, {BASIC_SQL}, {near('roc_auc')} AS roc_auc FROM c JOIN area ON g = split",
    ),
    "metrics_by_group": sql(
        "scored", c=f"SELECT rede, {COUNTS} FROM scored GROUP BY rede", body=f"SELECT rede, {BASIC_SQL} FROM c"
    ),
    "model_comparison": sql(
        "scored",
        **_compare([(name, f"score >= {cut!r}::DOUBLE", "scored") for name, cut in CUT_MODELS]),
        body=_compare_body("cut_030"),
    ),
    "majority_baseline": sql(
        "scored",
        body=f"""SELECT {near('greatest(count(*) FILTER (WHERE label = 1), count(*) FILTER (WHERE label = 0))::DOUBLE / count(*)')}
        AS majority_accuracy FROM scored""",
    ),
    "threshold_sweep": sql(
        "scored", s=_sweep("scored"), body=f"SELECT threshold, {near('accuracy')} AS accuracy FROM s"
    ),
    "best_threshold": sql(
        "scored", s=_sweep("scored"),
        body=f"SELECT threshold, {near('accuracy')} AS accuracy FROM s ORDER BY s.accuracy DESC, threshold LIMIT 1",
    ),
    "metrics_at_best": sql(
        "scored",
        train_rows=f"SELECT * FROM scored WHERE ano = {TRAIN}",
        test_rows=f"SELECT * FROM scored WHERE ano = {TEST}",
        sweep=_sweep("train_rows"),
        best="SELECT threshold FROM sweep ORDER BY accuracy DESC, threshold LIMIT 1",
        **_compare([("cut_default", "prediction", "test_rows"), ("cut_tuned", f"score >= {TUNED}", "test_rows")]),
        body=_compare_body("cut_default", f", CASE m.model WHEN 'cut_default' THEN 0.5e0 ELSE {TUNED} END AS threshold"),
    ),
    "risk_bands": sql(
        "scored",
        body=f"""SELECT CASE WHEN score < 0.3e0 THEN 'critico' WHEN score < 0.5e0 THEN 'alto' WHEN score < 0.7e0 THEN 'medio'
        WHEN score < 0.9e0 THEN 'baixo' ELSE 'minimo' END AS risk, count(*) AS n,
        {near('100 * (count(*) / (SELECT count(*) FROM scored)::DOUBLE)')} AS pct FROM scored GROUP BY 1""",
    ),
    "risk_critical": sql(
        "scored",
        body="SELECT count(*) FILTER (WHERE score < 0.3e0) AS n_critical, count(score) AS n_scored FROM scored",
    ),
    "score_histogram": sql(
        "scored",
        r="SELECT min(score) AS lo, (max(score) - min(score)) / 30 AS w FROM scored",
        b="""SELECT CAST(least(floor((score - lo) / w), 29) AS INTEGER) AS bin, count(*) AS n,
            count(*) FILTER (WHERE score >= 0.5e0) AS n_at_or_above FROM scored, r GROUP BY 1""",
        body=f"""SELECT CAST(g.i AS INTEGER) AS bin, {near('lo + g.i * w')} AS lower, {near('lo + (g.i + 1) * w')} AS upper,
        coalesce(n, 0) AS n, coalesce(n_at_or_above, 0) AS n_at_or_above
        FROM range(30) g(i) CROSS JOIN r LEFT JOIN b ON b.bin = g.i""",
    ),
    "school_alert": sql(
        "scored",
        a="""SELECT id_escola, ano, avg(score) AS mean_score, count(*) FILTER (WHERE score < 0.3e0) AS n_critical, count(*) AS n_rows
            FROM scored GROUP BY id_escola, ano""",
        body=f"""SELECT id_escola, ano, {near('mean_score')} AS mean_score, n_critical, n_rows,
        rank() OVER (ORDER BY mean_score) AS rank FROM a""",
    ),
}
