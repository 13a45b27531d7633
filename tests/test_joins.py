import pytest
from pyspark.sql import functions as F

from ambar.operators import joins


@pytest.fixture(scope="module")
def frames(spark):
    """A third of the facts share one key, some have none; the other keys are even."""
    facts = spark.range(9000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("k"), F.col("id") % 97)
        ).alias("k"),
    )
    side = facts.where("k is not null").groupBy("k").agg(F.count("*").alias("n")).where("k <> 'k5'")
    return facts.persist(), side.persist()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("rows_col", [None, "n"])
def test_shuffled_join_equals_plain_join(frames, how, rows_col):
    facts, side = frames
    want = sorted(facts.join(side, ["k"], how).collect(), key=lambda r: r["id"])
    got = joins.sized_join(facts, side, ["k"], how, limit_bytes=0, rows_col=rows_col)
    assert sorted(got.collect(), key=lambda r: r["id"]) == want
    small = joins.sized_join(facts, side, ["k"], how)
    assert sorted(small.collect(), key=lambda r: r["id"]) == want


def test_hot_and_missing_keys_are_spread_over_tasks(spark, frames):
    facts, side = frames
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = joins.salted_join(facts, side, ["k"], "left", "n").withColumn("p", F.spark_partition_id())
        for condition in ("k = 'hot'", "k is null"):
            per_task = [r["count"] for r in out.where(condition).groupBy("p").count().collect()]
            assert len(per_task) == 8
            assert max(per_task) < 2.5 * sum(per_task) / 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_only_up_to_the_measured_limit(frames):
    facts, side = frames
    size = joins.measured_bytes(side)
    assert size == sum(16 + 16 + len(r["k"]) + 8 for r in side.collect())
    plan = lambda limit: joins.sized_join(facts, side, ["k"], limit_bytes=limit)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(size)
    assert "_salt" in plan(size - 1) and "_salt" not in plan(size)


def test_warm_keys_and_equal_rows_leave_no_large_task(spark):
    """5,000 equally warm keys, and one key with a third of the rows, all alike."""
    facts = spark.range(0, 90_000, numPartitions=16).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000).alias("k"), F.lit("same").alias("v"))
    side = facts.groupBy("k").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for rows_col in (None, "n"):
            out = joins.salted_join(facts, side, ["k"], "inner", rows_col)
            per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(per_task) == 90_000 and max(per_task) <= 2 * sum(per_task) / 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
