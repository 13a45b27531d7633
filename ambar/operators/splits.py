"""Splitting rows: temporal split and its audit, single-period entities, stratified folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambar.fixed import CV_FOLDS, SEED
from ambar.functions.scalars import hash32, share
from ambar.operators.joins import BROADCAST_BYTES, sized_join
from ambar.session import materialise


def temporal_split(df: DataFrame, period: str, train: int, test: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the train period and rows of the test period, without the period column."""
    return (
        df.where(F.col(period) == train).drop(period),
        df.where(F.col(period) == test).drop(period),
    )


def with_split(df: DataFrame, period: str, train: int, test: int) -> DataFrame:
    """The same split as one frame with a ``split`` column."""
    return df.where(F.col(period).isin(train, test)).withColumn(
        "split", F.when(F.col(period) == train, "train").otherwise("test")
    )


def split_audit(split: DataFrame, entity: str, label: str) -> DataFrame:
    """Per side: rows, positive share, entities, and how many of these also occur on the other side."""
    sides = split.groupBy("split").agg(F.count("*").alias("n_rows"), F.avg(label).alias("positive_share"))
    seen = split.groupBy(entity).agg(
        F.max((F.col("split") == "train").cast("int")).alias("in_train"),
        F.max((F.col("split") == "test").cast("int")).alias("in_test"),
    )
    both = F.sum(F.col("in_train") * F.col("in_test"))
    lines = [
        F.struct(F.lit(side).alias("split"), F.sum(f"in_{side}").alias("n_entities"), both.alias("n_shared"))
        for side in ("train", "test")
    ]
    return sides.join(seen.agg(F.array(*lines).alias("lines")).select(F.inline("lines")), "split")


def single_period_entities(
    df: DataFrame, entity: str, period: str, limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Keep the rows of entities that appear in exactly one period.

    One exchange finds them (first period equals last period); a semi join keeps their rows. Pass
    the periods that are compared, for instance the train and the test edition.
    """
    once = materialise(
        df.groupBy(entity)
        .agg(F.min(period).alias("_first"), F.max(period).alias("_last"), F.count("*").alias("_entity_rows"))
        .where(F.col("_first") == F.col("_last"))
        .select(entity, "_entity_rows")
    )
    return sized_join(df, once, [entity], "left_semi", limit_bytes, rows_col="_entity_rows")


# Hash buckets per shuffle partition, so that a class is cut into even parts for every task.
BUCKETS_PER_PARTITION = 8


def stratified_folds(
    df: DataFrame, label: str, key: str | Column, folds: int = CV_FOLDS, seed: int = SEED, out: str = "fold"
) -> DataFrame:
    """Deal the rows of each class over ``folds`` in a random order fixed by seed and unique key.

    Fold sizes of a class differ by at most one. The order is that of a hash, so its leading bits cut
    a class into even buckets (as many as the shuffle has tasks, times ``BUCKETS_PER_PARTITION``): rows
    are numbered inside buckets, and the bucket counts shift the numbers. One exchange of the rows.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The hash has 32 bits, so no more buckets than that are there to be had.
    bits = min(31, (partitions * BUCKETS_PER_PARTITION - 1).bit_length())
    # Rows without a key are spread by their content; by the empty key they would all meet in one bucket.
    own = F.col(key) if isinstance(key, str) else key
    spread = F.coalesce(own.cast("string"), F.concat(F.lit("\u0000"), F.xxhash64(*df.columns).cast("string")))
    keyed = df.withColumn("_hash", hash32(spread, seed)).withColumn("_bucket", F.shiftright("_hash", 32 - bits).cast("int"))
    # A label may be missing; inside a struct it still finds its own counts.
    place = F.struct(label, "_bucket").alias("_place")
    counts = keyed.groupBy(label, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(counts.select(place, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy(label, "_bucket").orderBy("_hash", own)
    numbered = keyed.withColumn("_row", F.row_number().over(inside)).withColumn("_place", place)
    position = F.col("_start") + F.col("_row") - 1
    return (
        sized_join(numbered, starts, ["_place"], "inner")
        .withColumn(out, F.pmod(position, F.lit(folds)).cast("int"))
        .select(*df.columns, out)
    )


def fold_balance(folded: DataFrame, label: str) -> DataFrame:
    """Rows and positive share of each fold."""
    return folded.groupBy("fold").agg(
        F.count("*").alias("n_rows"), share(F.sum(label), F.count(label)).alias("positive_share")
    )
