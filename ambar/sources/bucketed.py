"""Tables bucketed by the keys that later steps group and join on, so that these steps need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambar.session import checkpoint_dir


def bucketed(df: DataFrame, keys: list[str], buckets: int | None = None) -> DataFrame:
    """``df`` written once as a table bucketed and sorted by ``keys`` below the checkpoint folder, and read back.

    One shuffle pays for every later aggregation and join on all of the keys. A key with very many rows makes one large
    bucket, which AQE can't split; where one may hold a large share of the rows, use ``context.attach_group_stats``.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"bucketed_{uuid.uuid4().hex}", f"{checkpoint_dir(spark)}/bucketed-{uuid.uuid4().hex}"
    # One file per bucket: rows are dealt as the buckets are before they are written.
    dealt = df.repartition(buckets, *keys)
    dealt.write.option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


def with_group_stats(table: DataFrame, keys: list[str], stats: list[Column]) -> DataFrame:
    """A bucketed table's rows with the statistics of their groups: aggregation and join inside each bucket."""
    grouped = table.groupBy(*keys).agg(*stats)
    known = table.alias("t").join(grouped.alias("g").hint("merge"), keys, "left")
    return known.select(*[F.col(f"t.{c}") for c in table.columns], *[F.col(f"g.{c}") for c in grouped.columns if c not in keys])
