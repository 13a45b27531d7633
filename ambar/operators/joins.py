"""Joins that choose broadcast or shuffle by measured size, and never leave a hot key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambar.functions.scalars import any_null

BROADCAST_BYTES = 64 * 1024 * 1024
# A task's fair share of rows is cut in this many parts; a key with more rows than one part is spread.
PARTS = 8


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df``: fixed widths from the schema, text from its actual length."""
    fixed, text = 16, F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            text = text + F.coalesce(F.octet_length(field.name), F.lit(0))
            fixed += 16
        elif isinstance(field.dataType, T.UserDefinedType):
            # A vector: as its text, which is no shorter than its numbers.
            text = text + F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0)) * 2
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = text + F.octet_length(F.to_json(F.struct(field.name)))
        else:
            fixed += 8
    return df.agg(F.coalesce(F.sum(text + F.lit(fixed)), F.lit(0)).cast("bigint")).first()[0]


def sized_join(
    facts: DataFrame,
    side: DataFrame,
    keys: list[str],
    how: str = "left",
    limit_bytes: int | None = None,
    rows_col: str | None = None,
) -> DataFrame:
    """Join ``facts`` with ``side`` on equal ``keys`` (left, inner, left_semi or left_anti).

    ``side`` is measured first. Up to ``limit_bytes`` (``BROADCAST_BYTES`` unless given) it is broadcast and the facts do not move.
    Beyond that both sides are shuffled, and every key with more fact rows than a fraction of a
    task's fair share is spread over as many tasks as its own count asks for. No more keys than
    ``PARTS`` times the shuffle partitions can have that many rows, so the list of them is small by
    construction. ``rows_col`` names the column of ``side`` that already counts fact rows per key;
    without it they are counted.

    ``side`` is read twice, so give a stored or materialised frame.
    """
    if measured_bytes(side) <= (BROADCAST_BYTES if limit_bytes is None else limit_bytes):
        return facts.join(F.broadcast(side), keys, how)
    return salted_join(facts, side, keys, how, rows_col)


def sized(side: DataFrame, limit_bytes: int | None = None) -> DataFrame:
    """``side`` with a broadcast hint if it measures small, as it is otherwise."""
    return F.broadcast(side) if measured_bytes(side) <= (BROADCAST_BYTES if limit_bytes is None else limit_bytes) else side


def salted_join(
    facts: DataFrame, side: DataFrame, keys: list[str], how: str = "left", rows_col: str | None = None
) -> DataFrame:
    """The shuffled form of :func:`sized_join`."""
    if rows_col is None:
        counted = facts.groupBy(*keys).agg(F.count("*").alias("_rows"))
        total = facts.count()
    else:
        counted = side.groupBy(*keys).agg(F.max(rows_col).alias("_rows"))
        total = counted.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint")).first()[0]
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = max(1.0, total / (PARTS * tasks))
    hot = counted.where(~any_null(*keys) & (F.col("_rows") > part)).select(*keys, F.ceil(F.col("_rows") / part).cast("int").alias("_copies"))
    # By content and partition: the same for a row however often its task runs, and different for equal rows of different partitions.
    spread = F.xxhash64(*facts.columns, F.spark_partition_id())
    # A row with a missing key matches nothing, so it can go anywhere.
    over = F.when(any_null(*keys), F.lit(PARTS * tasks)).otherwise(F.coalesce("_copies", F.lit(1)))
    copies: Column = F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)
    left = facts.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.pmod(spread, over).cast("int")).drop("_copies")
    right = side.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.explode(copies)).drop("_copies")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
