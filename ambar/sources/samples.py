"""Sampling and the sample export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ambar.fixed import SEED
from ambar.functions.scalars import hash32
from ambar.session import small_frame

SPAN = 2**32


def hash_sample(df: DataFrame, key: str | Column, fraction: float, seed: int = SEED) -> DataFrame:
    """Keep about ``fraction`` of the rows, chosen by key. The choice does not depend on partitioning."""
    return df.where(hash32(key, seed) < fraction * SPAN)


def stratified_sample(
    df: DataFrame, label: str, fractions: dict, key: str | Column, seed: int = SEED
) -> DataFrame:
    """Keep its own fraction of each class; classes without a fraction are left out."""
    threshold = reduce(
        lambda acc, item: acc.when(F.col(label) == item[0], item[1] * SPAN), fractions.items(), F.when(F.lit(False), 0.0)
    )
    return df.where(hash32(key, seed) < threshold)


def stratified_sample_native(df: DataFrame, label: str, fractions: dict, seed: int = SEED) -> DataFrame:
    """Spark's own stratified sample. The rows drawn change with the partitioning."""
    return df.sampleBy(label, fractions, seed)


def export_samples(frames: dict[str, DataFrame], out_dir: str) -> DataFrame:
    """Write each frame as CSV with header below ``out_dir``; returns the manifest (table, n_rows).

    Executors write the parts themselves, and rows are counted while they are written: one job per table, no second read.
    """
    manifest, spark = [], None
    for name, frame in frames.items():
        spark, written = frame.sparkSession, Observation(f"written_{name}")
        path = f"{out_dir.rstrip('/')}/sample_{name}"
        frame.observe(written, F.count("*").alias("n_rows")).write.mode("overwrite").option("header", True).option("multiLine", True).csv(path)
        manifest.append((name, written.get["n_rows"]))
    return small_frame(spark, manifest, T.StructType([T.StructField("table", T.StringType()), T.StructField("n_rows", T.LongType())]))
