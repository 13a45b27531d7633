"""The search over the booster's parameters: nothing is left out, and its own fits are those of Spark's booster."""

import inspect

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ambar.fixed import SEARCH_DRAWS, SEARCH_FOLDS
from ambar.operators import boosting, models, tuning
from ambar.operators.evaluate import roc_auc
from ambar.operators.prep import TabularPreprocessor, fit_bins
from ambar.plans import learning

# No random numbers: trees are the same whoever grows them.
STILL = {"subsample": 1.0, "colsample_bytree": 1.0}


class Reached(Exception):
    pass


def test_the_search_query_fits_all_candidates_with_all_their_trees(spark, sf_dir, monkeypatch):
    found, signature = {}, inspect.signature(tuning.random_search)

    def asked(*args, **options):
        bound = signature.bind(*args, **options)
        bound.apply_defaults()
        found.update(bound.arguments)
        raise Reached

    monkeypatch.setattr(tuning, "random_search", asked)
    learning.forget()
    with pytest.raises(Reached):
        learning.random_search(spark, sf_dir)
    assert found["rungs"] == 1 and found["early_stop"] is None and not found["overrides"]
    assert (found["draws"], found["folds"]) == (SEARCH_DRAWS, SEARCH_FOLDS) == (30, 3)


@pytest.fixture(scope="module")
def rows(spark):
    """Missing numbers and categories, and a category of one fold only."""
    df = spark.range(3000).selectExpr(
        "id", "CAST((id * 7919) % 10007 / 10007 AS double) AS x", "CAST(pmod(hash(id), 4) AS string) AS c",
        "CAST(pmod(xxhash64(id), 100) < 20 + 50 * ((id * 7919) % 10007) / 10007 + 10 * pmod(hash(id), 4) AS int) AS y",
        "CAST(pmod(hash(id, 5), 2) AS int) AS fold",
    )
    x = F.when(F.col("id") % 13 != 0, F.col("x"))
    c = F.when(F.col("id") % 11 == 0, None).when((F.col("fold") == 1) & (F.col("id") % 17 == 0), "rare").otherwise(F.col("c"))
    return df.select("id", x.alias("x"), c.alias("c"), "y", "fold").localCheckpoint()


def by_spark(train, **params) -> PipelineModel:
    bins = fit_bins(train, ["x"])
    fitted = TabularPreprocessor(["x"], ["c"]).fit(bins.transform(train))
    model = models.booster("melhorado", "y", **params).fit(models.gathered(fitted.transform(bins.transform(train))))
    return PipelineModel([bins, fitted, model])


def test_fits_on_cells_are_those_of_the_booster_on_rows(spark, rows, tmp_path):
    params = {"n_estimators": 2, "max_depth": 3, "min_child_weight": 40, "learning_rate": 0.1, **STILL}
    best, ranked = tuning.random_search(rows, "y", TabularPreprocessor(["x"], ["c"]), draws=1, folds=2, **params)
    models.save_model(best, str(tmp_path / "best"))
    want = {r["id"]: r["score"] for r in models.score(by_spark(rows, **params), rows, "y").collect()}
    for found in (best, models.load_model(spark, str(tmp_path / "best"))):
        got = {r["id"]: r["score"] for r in models.score(found, rows, "y").collect()}
        assert got == pytest.approx(want, abs=1e-9) and len(set(got.values())) > 8
    areas = []
    for i in range(2):
        model = by_spark(rows.where(F.col("fold") != i), **params)
        areas.append(roc_auc(models.score(model, rows.where(F.col("fold") == i), "y")).first()["roc_auc"])
    assert ranked.first()["mean_auc"] == pytest.approx(sum(areas) / 2, abs=1e-9)
    assert models.feature_importance(best).agg(F.sum("importance")).first()[0] == pytest.approx(1)


@pytest.mark.parametrize("options", [{}, {"early_stop": 0.0, "learning_rate": 1.0, "n_estimators": 4}])
def test_many_cells_are_fitted_by_the_booster_itself(rows, options):
    params = {"n_estimators": 2, "max_depth": 2, "min_child_weight": 1, **STILL, **options}
    few, many = (
        tuning.random_search(rows, "y", TabularPreprocessor(["x"], ["c"]), draws=1, folds=2, most_cells=most, **params)[1].first()
        for most in (10_000, 0)
    )
    assert few["mean_auc"] == pytest.approx(many["mean_auc"], abs=1e-9)


def test_early_stop_leaves_out_trees_that_only_fit_the_training_rows():
    table = np.array([[x, 30, 10 + 2 * x, 10, 10] for x in range(10)], float)
    growth = boosting.Growth(40, 1.0, 3, 1, 0.0, 1.0, "all", 42)
    stopped, whole = [], []
    boosting.Cells(table, []).boost(growth, 0.0, stopped)
    boosting.Cells(table, []).boost(growth, None, whole)
    assert len(stopped) < len(whole) == 40


def test_a_subsample_draws_rows_of_every_cell(monkeypatch):
    cells = boosting.Cells(np.array([[x, 400, 600, 0, 0] for x in range(20)], float), [])
    drawn, grow = [], boosting.Cells.grow
    monkeypatch.setattr(boosting.Cells, "grow", lambda self, n, *a: (drawn.append(n), grow(self, n, *a))[1])
    cells.boost(boosting.Growth(10, 0.1, 3, 1, 0.0, 0.6, "all", 42))
    drawn = np.array(drawn)
    assert drawn.shape == (10, 20) and drawn.min() > 500 and drawn.max() < 700 and abs(drawn.mean() - 600) < 5
    assert len({tuple(n) for n in drawn}) == 10


def test_minima_count_rows_and_features_are_drawn_per_node():
    table = np.array([[0, 0, 0, 9, 0, 0], [0, 1, 0, 50, 0, 0], [1, 0, 60, 0, 0, 0], [1, 2, 0, 0, 5, 5]], float)
    for least, parts in ((9, 3), (10, 2)):
        margin = boosting.Cells(table, [2]).boost(boosting.Growth(1, 0.1, 5, least, 0.0, 1.0, "all", 42))
        assert len(set(margin)) <= parts and margin[0] == margin[1] == 1 and margin[2] == -1
    assert [boosting.features_per_node(s, 7) for s in ("all", "0.6", "0.8", "1.0", "3", "9", "sqrt")] == [7, 5, 6, 7, 3, 7, 3]


def test_area_of_cells_counts_ties_one_half():
    table = np.array([[0, 1, 1, 3, 1], [1, 1, 1, 2, 2], [2, 1, 1, 0, 4]], float)
    cells = boosting.Cells(table, [])
    scores = [s for s, row in zip((0.1, 0.5, 0.5), table) for s in [s] * int(row[3])], [s for s, row in zip((0.1, 0.5, 0.5), table) for s in [s] * int(row[4])]
    want = np.mean([(p > n) + (p == n) / 2 for n in scores[0] for p in scores[1]])
    assert cells.area(np.array([0.1, 0.5, 0.5])) == pytest.approx(want)
    # Without held-back rows as Spark's evaluator has it.
    assert boosting.Cells(table * [1, 1, 1, 0, 0], []).area(np.zeros(3)) == 0.5


def test_labels_must_be_0_or_1(rows):
    odd = rows.withColumn("y", F.when(F.col("id") != 5, F.col("y")))
    with pytest.raises(ValueError, match="1 rows have a y"):
        tuning.random_search(odd, "y", TabularPreprocessor(["x"], ["c"]), draws=1, folds=2)


def test_few_files_are_scored_on_all_cores(spark):
    one = spark.range(100).coalesce(1)
    wide = models.spread(one)
    assert wide.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r["id"] for r in wide.collect()) == list(range(100))
    assert models.spread(wide) is wide


def test_the_winner_scores_every_row_once(spark, sf_dir, monkeypatch):
    best, ranked = learning._search(spark, sf_dir)[:2]
    assert ranked.count() == 30 and best.stages[-1].getMaxIter() == ranked.orderBy("rank").first()["n_estimators"] == len(best.stages[-1].trees)
    seen, metrics = [], learning.evaluate.metrics
    monkeypatch.setattr(learning.evaluate, "metrics", lambda scored: (seen.append(scored), metrics(scored))[1])
    found = learning.random_search_best(spark, sf_dir).first()
    assert "UDF" not in seen[0]._jdf.queryExecution().executedPlan().toString()
    assert seen[0].count() == learning.editions(spark, sf_dir).where(F.col("ano") == learning.TEST).count()
    assert 0.5 < found["roc_auc"] < 1
