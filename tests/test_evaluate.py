import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ambar.operators import evaluate

# Published counts of one model, and the rates they give.
GOLDEN = {"tn": 26991, "fp": 74390, "fn": 0, "tp": 111018}


@pytest.fixture(scope="module")
def golden(spark):
    edge1 = GOLDEN["tn"]
    edge2 = edge1 + GOLDEN["fp"]
    return spark.range(sum(GOLDEN.values())).select(
        (F.col("id") >= edge2).cast("int").alias("label"),
        (F.col("id") >= edge1).cast("int").alias("prediction"),
        (F.col("id") % 10 / 10).alias("score"),
    )


def frame(spark, labels, scores, cut=0.5):
    rows = [(y, int(s >= cut), float(s)) for y, s in zip(labels, scores)]
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_published_matrix(golden):
    row = evaluate.basic_metrics(golden).first()
    assert [round(row[c], 5) for c in ("accuracy", "precision", "recall", "f1_score")] == [0.64976, 0.59878, 1.0, 0.74904]
    assert round(evaluate.sensitivity_specificity(golden).first()["specificity"], 5) == 0.26623
    assert round(evaluate.majority_baseline(golden).first()[0], 5) == 0.52269
    cells = {(r["label"], r["prediction"]): r["n"] for r in evaluate.confusion_matrix(golden).collect()}
    assert cells == {(0, 0): 26991, (0, 1): 74390, (1, 0): 0, (1, 1): 111018}


def test_area_equals_evaluator_with_ties(spark):
    rng = np.random.default_rng(0)
    scores = np.round(rng.random(800), 2)
    labels = (rng.random(800) < scores).astype(int).tolist()
    df = frame(spark, labels, scores)
    want = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(df)
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(want, abs=1e-12)
    curve = sorted((r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df).collect())
    area = sum((x1 - x0) * (y0 + y1) / 2 for (x0, y0), (x1, y1) in zip(curve, curve[1:]))
    assert area == pytest.approx(want, abs=1e-12) and curve[0] == (0, 0) and curve[-1] == (1, 1)


def test_equal_scores_and_single_class(spark):
    assert evaluate.roc_auc(frame(spark, [0, 1, 1], [0.4, 0.4, 0.4])).first()[0] == 0.5
    one = frame(spark, [0, 0], [0.1, 0.2])
    row = evaluate.metrics(one).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["roc_auc"]) == (0.0, 0.0, 0.0, None)


def test_lowest_cut_wins_ties(spark):
    df = frame(spark, [0, 1], [0.2, 0.8])
    assert evaluate.best_threshold(df).first()[:] == (0.3, 1.0)
    assert len(evaluate.threshold_sweep(df).collect()) == 40
    assert evaluate.best_threshold(frame(spark, [1, 0], [0.1, 0.9])).first()[:] == (0.5, 0.0)
    applied = evaluate.apply_cut(df, 0.9).collect()
    assert [r["prediction"] for r in applied] == [0, 0]


def test_best_f1_is_first_maximum(spark):
    labels, scores = [1, 0, 1, 0], [0.9, 0.8, 0.7, 0.1]
    row = evaluate.best_f1(frame(spark, labels, scores)).first()
    assert row["threshold"] == 0.7 and row["f1_score"] == pytest.approx(0.8)
    ends = evaluate.pr_curve(frame(spark, labels, scores)).where("threshold is null").collect()
    assert [(r["precision"], r["recall"]) for r in ends] == [(1.0, 0.0)]


def test_report_lines(spark):
    rows = {r["class"]: r for r in evaluate.classification_report(frame(spark, [0, 0, 1, 1, 1], [0.1, 0.9, 0.9, 0.9, 0.2])).collect()}
    assert rows["0"]["support"] == 2 and rows["1"]["support"] == 3
    assert rows["accuracy"]["f1_score"] == pytest.approx(0.6)
    assert rows["macro avg"]["recall"] == pytest.approx((0.5 + 2 / 3) / 2)
    assert rows["weighted avg"]["precision"] == pytest.approx((0.5 * 2 + 2 / 3 * 3) / 5)


def test_metrics_per_group_include_area(spark):
    df = frame(spark, [0, 1, 0, 1], [0.1, 0.9, 0.8, 0.3]).withColumn("g", F.when(F.col("score").isin(0.1, 0.9), "a").otherwise("b"))
    got = {r["g"]: (r["accuracy"], r["roc_auc"]) for r in evaluate.metrics(df, ["g"]).collect()}
    assert got == {"a": (1.0, 1.0), "b": (0.0, 0.0)}


def test_missing_group_keeps_its_metrics(spark):
    df = frame(spark, [0, 1, 0, 1], [0.1, 0.9, 0.2, 0.8]).withColumn("g", F.when(F.col("score").isin(0.1, 0.9), "a"))
    got = {r["g"]: r["roc_auc"] for r in evaluate.metrics(df, ["g"]).collect()}
    assert got == {"a": 1.0, None: 1.0}


def test_comparison_gain_is_against_the_first(spark):
    df = frame(spark, [0, 1, 1, 1], [0.4, 0.45, 0.9, 0.9])
    got = {r["model"]: r["gain_accuracy_pp"] for r in evaluate.compare_models([("a", df), ("b", evaluate.apply_cut(df, 0.42))]).collect()}
    assert got == {"a": 0.0, "b": pytest.approx(25.0)}


def test_alert_ranks_the_lowest_mean_first(spark):
    df = spark.createDataFrame([("x", 0.2), ("x", 0.4), ("y", 0.9)], "school string, score double")
    got = {r["school"]: (r["n_critical"], r["rank"]) for r in evaluate.group_alert(df, ["school"]).collect()}
    assert got == {"x": (1, 1), "y": (0, 2)}
