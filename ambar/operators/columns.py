"""Choosing columns: safe projection, leakage and id removal, duplicate names, feature roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType,
)


def select_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Project the wanted columns that exist, each once, in the order asked for."""
    return df.select(*[c for c in dict.fromkeys(wanted) if c in df.columns])


def missing_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """One row per wanted column: is it there, and how many values does it hold."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(c in df.columns).alias("present"),
            (F.count(c) if c in df.columns else F.lit(0)).cast("bigint").alias("n_values"),
        )
        for c in dict.fromkeys(wanted)
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop deny-listed columns (leaky ones, ids); names that do not occur are ignored."""
    return df.drop(*names)


def dedup_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several columns with one name."""
    names = df.columns
    unique = df.toDF(*[f"_{i}_{name}" for i, name in enumerate(names)])
    first = {name: i for i, name in reversed(list(enumerate(names)))}
    return unique.select(*[F.col(f"`_{i}_{name}`").alias(name) for name, i in sorted(first.items(), key=lambda x: x[1])])


def roles(df: DataFrame, categorical: list[str] | None = None) -> tuple[list[str], list[str]]:
    """(numeric, categorical) columns by type. ``categorical`` forces columns into the second list."""
    forced = set(categorical or [])
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in forced]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) or f.name in forced]
    return numeric, text


def feature_roles(df: DataFrame, categorical: list[str] | None = None) -> DataFrame:
    """One row per column: role (numeric, categorical or ignored), filled values, and whether it is constant."""
    numeric, text = roles(df, categorical)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit("numeric" if c in numeric else "categorical" if c in text else "ignored").alias("role"),
            F.count(c).alias("n_values"),
            F.coalesce(F.min(c) == F.max(c), F.lit(True)).alias("constant"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def constant_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns with at most one distinct value, found in one pass; they carry nothing for a model.

    In a text column a missing value becomes a category of its own, so one value and some missing are two. A
    missing number is filled with the median.
    """
    kinds = dict(df.dtypes)

    def constant(c: str):
        one = F.coalesce(F.min(c) == F.max(c), F.lit(True))
        return one & (F.count(c).isin(0) | (F.count(c) == F.count("*"))) if kinds[c] == "string" else one

    row = df.agg(*[constant(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]
