import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ambar.operators import running


def test_running_totals_match_pandas_with_a_missing_group(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 500), "x": rng.permutation(500), "v": rng.integers(0, 9, 500)})
    df = spark.createDataFrame(pdf).withColumn("g", F.when(F.col("g") == "NaN", None).otherwise(F.col("g")))
    got = running.running_totals(df, [F.desc("x")], ["v"], ["g"]).toPandas()
    got["g"], pdf["g"] = got["g"].fillna("-"), pdf["g"].fillna("-")
    pdf = pdf.sort_values("x", ascending=False)
    pdf["run"] = pdf.groupby("g")["v"].cumsum()
    pdf["total"] = pdf.groupby("g")["v"].transform("sum")
    both = got.merge(pdf, on=["g", "x"])
    assert len(both) == len(got) == 500
    assert (both["v_run"] == both["run"]).all() and (both["v_total"] == both["total"]).all()


def test_slices_are_even(spark):
    df = spark.range(20000).select((F.col("id") / 7).alias("x"), F.lit(1).alias("v"))
    got = running.running_totals(df, ["x"], ["v"])
    assert got.agg(F.max("v_run"), F.count("*"), F.countDistinct("v_run")).first()[:] == (20000, 20000, 20000)


@pytest.mark.parametrize("values", [[1, 2, 3, 4], [5], [1, 1, 1, 9], [2.5, -1, 7, 7, 0, 3]])
def test_quantiles_interpolate(spark, values):
    df = spark.createDataFrame([(float(v),) for v in [*values]] + [(None,), (float("nan"),)], "a double")
    probabilities = [0, 0.1, 0.25, 0.5, 0.75, 1]
    row = running.exact_quantiles(df, ["a"], probabilities).first()
    assert row["n"] == len(values)
    assert [row[f"q{i}"] for i in range(6)] == pytest.approx(list(np.quantile(values, probabilities)))


def test_quantiles_of_several_columns_by_group(spark):
    df = spark.createDataFrame([("x", 1, 10.0), ("x", 3, 20.0), ("y", 8, None)], "g string, a int, b double")
    got = {(r["g"], r["column"]): r["q0"] for r in running.exact_quantiles(df, ["a", "b"], [0.5], ["g"]).collect()}
    assert got == {("x", "a"): 2.0, ("x", "b"): 15.0, ("y", "a"): 8.0}


def test_rank_shares_ties_and_puts_missing_last(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", 2.0), ("d", None), ("e", 3.0)], "k string, v double")
    up = {r["k"]: r["rank"] for r in running.with_rank(df, "v").collect()}
    down = {r["k"]: r["rank"] for r in running.with_rank(df, "v", descending=True).collect()}
    assert up == {"b": 1, "a": 2, "c": 2, "e": 4, "d": 5}
    assert down == {"e": 1, "a": 2, "c": 2, "b": 4, "d": 5}


def test_cumulative_share_counts_rows_needed(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.15), ("d", 0.05)], "f string, w double")
    shares, needed = running.cumulative_share(df, "f", "w", [0.8, 0.9])
    got = [r["cumulative_share"] for r in shares.orderBy("cumulative_share").collect()]
    assert got == pytest.approx([0.5, 0.8, 0.95, 1.0])
    assert needed.first()["n_90"] == 3


def test_narrowed_quantiles_equal_counted_ones(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.normal(size=30000), np.zeros(15000), [np.nan]])
    df = spark.createDataFrame(pd.DataFrame({"a": values, "b": np.round(values)}))
    probabilities = [0, 0.01, 0.25, 0.3, 0.5, 0.75, 0.999, 1]
    got = {r["column"]: r for r in running.exact_quantiles(df, ["a", "b"], probabilities).collect()}
    for c, v in (("a", values[:-1]), ("b", np.round(values[:-1]))):
        assert [got[c][f"q{i}"] for i in range(8)] == pytest.approx(list(np.quantile(v, probabilities)), abs=1e-12)


def test_rank_outside_its_band_is_counted_in_full(spark, monkeypatch):
    df = spark.range(101).select(F.col("id").cast("double").alias("a"))
    monkeypatch.setattr(running, "_bands", lambda *_: {"a": [(0.0, 3.0), (90.0, 95.0)]})
    assert running.exact_quantiles(df, ["a"], [0.5, 0.91]).first()[:] == ("a", 101, 50.0, 91.0)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    assert [tuple(r) for r in running.exact_quantiles(df, ["a", "b"], [0.5]).collect()] == [("b", 2, 2.0)]


def test_rank_of_a_column_that_differs_at_every_evaluation(spark):
    from pyspark.sql import functions as F

    from ambar.operators.running import with_rank

    ticking = spark.range(10).select("id", F.expr("cast(reflect('java.lang.System', 'nanoTime') AS double)").alias("t"))
    assert with_rank(ticking, "t").count() == 10
