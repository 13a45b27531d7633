import os

from pyspark.sql import functions as F

from ambar.fixed import LEAKY_COLUMNS
from ambar.operators import columns, profile, splits
from ambar.session import stored
from ambar.sources import samples, tables, tpch


def test_read_by_name_and_path(spark, sf_dir):
    tpch.table(spark, sf_dir, "nation").createOrReplaceTempView("nation_view")
    assert tables.read_table(spark, "nation_view").count() == tables.read_table(spark, f"{sf_dir}/nation.parquet", ["n_name"]).count()


def test_year_range_reaches_the_scan(spark, sf_dir):
    plan = tpch.alunos(spark, sf_dir, (1999, 2000))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_hash_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(10000)
    ids = lambda frame: sorted(r[0] for r in samples.hash_sample(frame, "id", 0.1).collect())
    few = ids(df.repartition(2))
    assert few == ids(df.repartition(7)) and 910 <= len(few) <= 1090


def test_stratified_sample_leaves_out_unnamed_classes(spark):
    df = spark.range(3000).withColumn("y", (F.col("id") % 3).cast("int"))
    got = {r["y"]: r["count"] for r in samples.stratified_sample(df, "y", {0: 1.0, 1: 0.2}, "id").groupBy("y").count().collect()}
    assert got[0] == 1000 and 150 < got[1] < 250 and 2 not in got


def test_native_stratified_sample(spark):
    df = spark.range(3000).withColumn("y", (F.col("id") % 2).cast("int"))
    assert 200 < samples.stratified_sample_native(df, "y", {0: 0.1, 1: 0.1}).count() < 400


def test_export_writes_csv_with_header(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    manifest = samples.export_samples({"t": df}, str(tmp_path)).collect()
    assert [tuple(r) for r in manifest] == [("t", 2)]
    parts = [p for p in os.listdir(tmp_path / "sample_t") if p.endswith(".csv")]
    assert all((tmp_path / "sample_t" / p).read_text().startswith("x,y") for p in parts)


def test_stored_table_keeps_columns_and_prunes(spark):
    df = spark.createDataFrame([(1, 1999, "a"), (2, 2000, None)], "x int, ano int, y string")
    table = stored(df, ["ano"])
    assert table.dtypes == [("x", "int"), ("y", "string"), ("ano", "int")] or set(table.dtypes) == set(df.dtypes)
    assert [r["x"] for r in table.where("ano = 2000").collect()] == [2]


def test_profile_rows(spark):
    rows = tables.table_profile(spark.createDataFrame([(1, "a")], "x int, y string")).collect()
    assert [tuple(r) for r in rows] == [(0, "x", "int", 1, 2), (1, "y", "string", 1, 2)]


def test_safe_projection_drops_repeats_and_absent_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert columns.select_existing(df, ["b", "b", "z", "a"]).columns == ["b", "a"]
    got = {r["column"]: (r["present"], r["n_values"]) for r in columns.missing_columns(df, ["a", "z"]).collect()}
    assert got == {"a": (True, 1), "z": (False, 0)}


def test_leaky_columns_go_and_absent_ones_are_ignored(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3)], "proficiencia double, nivel_3 double, x int")
    assert columns.drop_columns(df, LEAKY_COLUMNS).columns == ["x"]


def test_first_of_duplicate_columns_stays(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").select("a", "b", F.lit(9).alias("a"))
    assert [tuple(r) for r in columns.dedup_columns(df).collect()] == [(1, 2)]


def test_roles_by_type_with_override(spark):
    df = spark.createDataFrame([(1, 2.0, "u", True)], "i int, d double, s string, b boolean").withColumn("arr", F.array("i"))
    assert columns.roles(df, ["i"]) == (["d", "b"], ["i", "s"])
    got = {r["column"]: (r["role"], r["constant"]) for r in columns.feature_roles(df, ["i"]).collect()}
    assert got["arr"][0] == "ignored" and got["i"] == ("categorical", True)


def test_missing_value_counts_as_a_value_in_cardinality(spark):
    df = spark.createDataFrame([("a", 1), (None, 1)], "s string, n int")
    got = {r["column"]: r["n_distinct"] for r in profile.cardinality(df, ["s", "n"]).collect()}
    assert got == {"s": 2, "n": 1}


def test_null_audit_lists_only_gaps(spark):
    df = spark.createDataFrame([(None, 1, None), ("a", 2, None)], "s string, n int, d double")
    assert [tuple(r) for r in profile.null_audit(df).collect()] == [("d", 2), ("s", 1)]


def test_histogram_closes_the_last_bin_and_keeps_empty_ones(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.0,), (None,)], "v double")
    rows = profile.histogram(df, "v", 4, mark=5).orderBy("bin").collect()
    assert [(r["n"], r["n_at_or_above"]) for r in rows] == [(1, 0), (0, 0), (0, 0), (2, 2)]
    same = profile.histogram(df.where("v > 5"), "v", 2).orderBy("bin").collect()
    assert [r["n"] for r in same] == [2, 0]
    assert [r["n"] for r in profile.histogram(df.where("v > 50"), "v", 2).collect()] == [0, 0]


def test_folds_are_balanced_and_stable(spark):
    df = spark.range(1003).withColumn("y", (F.col("id") % 7 == 0).cast("int"))
    folded = splits.stratified_folds(df, "y", "id")
    assert folded.count() == 1003
    per = {}
    for r in folded.groupBy("y", "fold").count().collect():
        per.setdefault(r["y"], []).append(r["count"])
    assert all(len(c) == 5 and max(c) - min(c) <= 1 for c in per.values())
    again = splits.stratified_folds(df.repartition(3), "y", "id")
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, again.collect()))
    assert splits.fold_balance(folded, "y").count() == 5


def test_single_period_rows_keep_repeats_inside_the_period(spark):
    df = spark.createDataFrame([(1, 2023), (1, 2023), (2, 2023), (2, 2024), (3, 2024), (None, 2024)], "id int, ano int")
    for limit in (0, 10**9):
        got = splits.single_period_entities(df, "id", "ano", limit_bytes=limit)
        assert sorted(tuple(r) for r in got.collect()) == [(1, 2023), (1, 2023), (3, 2024)]
    split = splits.with_split(got, "ano", 2023, 2024)
    assert {r["n_shared"] for r in splits.split_audit(split.withColumn("y", F.lit(1)), "id", "y").collect()} == {0}


def test_empty_test_period(spark):
    df = spark.createDataFrame([(1, 2023)], "x int, ano int")
    train, test = splits.temporal_split(df, "ano", 2023, 2024)
    assert (train.count(), test.count(), train.columns) == (1, 0, ["x"])


def test_overlap_counts(spark):
    df = spark.createDataFrame([(1, 2023), (1, 2024), (1, 2024), (2, 2023)], "id int, ano int")
    assert profile.overlap_summary(df, "id", "ano", 2023, 2024).first()[:] == (2, 2, 1, 1, 50.0)
    assert sorted(tuple(r) for r in profile.overlap_distribution(df, "id", "ano").collect()) == [(1, 1, 50.0), (2, 1, 50.0)]


def test_nan_is_missing_in_histogram_and_audit(spark):
    from ambar.operators.profile import histogram, null_audit

    df = spark.createDataFrame([(float("nan"), None), (0.0, "a"), (1.0, "b"), (None, "c")], "x double, s string")
    rows = histogram(df, "x", bins=2).collect()
    assert [r["n"] for r in rows] == [1, 1] and rows[0]["lower"] == 0.0
    assert {r["column"]: r["n_missing"] for r in null_audit(df).collect()} == {"x": 2, "s": 1}


def test_one_category_with_missing_values_is_not_constant(spark):
    from ambar.operators.columns import constant_columns

    df = spark.createDataFrame([("a", "a", None, 1.0), (None, "a", None, None)], "c string, d string, e string, n double")
    assert constant_columns(df, ["c", "d", "e", "n"]) == ["d", "e", "n"]


def test_manifest_counts_rows_with_line_breaks(spark, tmp_path):
    from ambar.sources.samples import export_samples

    frame = spark.createDataFrame([("one\nline",), ("two",)], "s string")
    assert export_samples({"t": frame}, str(tmp_path)).first()["n_rows"] == 2
