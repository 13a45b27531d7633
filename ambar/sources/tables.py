"""Reading tables and describing them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, name_or_path: str, columns: list[str] | None = None) -> DataFrame:
    """A catalog table by name, or a Parquet table by path (anything with a slash)."""
    df = spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)
    return df.select(*columns) if columns else df


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, column, type, and the table's row count and column count."""
    rows = F.count("*").alias("n_rows")
    columns = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(kind).alias("type"))
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    # No columns are read: Parquet row counts are enough.
    return df.agg(rows).select(F.inline(F.array(*columns)), "n_rows", F.lit(len(columns)).alias("n_columns"))
