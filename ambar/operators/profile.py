"""Profiles of a table: classes, overlap of periods, distributions, gaps and cardinalities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambar.functions.scalars import share, no_nan
from ambar.operators.running import exact_quantiles


def with_percent(counted: DataFrame, n: str = "n", out: str = "pct") -> DataFrame:
    """Add each row's percentage of the total; the total is a one-row subquery, not a global window."""
    total = counted.select(F.sum(n)).scalar()
    return counted.withColumn(out, 100 * share(F.col(n), total))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return with_percent(df.groupBy(label).agg(F.count("*").alias("n"))).orderBy(label)


def periods_per_entity(df: DataFrame, entity: str, period: str) -> DataFrame:
    """Per entity: number of distinct periods, and the periods in order.

    Distinct pairs first, so an entity brings at most one row per period to the collecting step.
    """
    pairs = df.select(entity, period).distinct()
    return pairs.groupBy(entity).agg(
        F.count(period).alias("n_periods"), F.array_sort(F.collect_list(period)).alias("periods")
    )


def overlap_distribution(df: DataFrame, entity: str, period: str) -> DataFrame:
    """How many entities appear in one, two, … periods."""
    per_entity = df.select(entity, period).distinct().groupBy(entity).agg(F.count(period).alias("n_periods"))
    return with_percent(per_entity.groupBy("n_periods").agg(F.count("*").alias("n"))).orderBy("n_periods")


def overlap_summary(df: DataFrame, entity: str, period: str, train: int, test: int) -> DataFrame:
    """Entities seen in both the train and the test period, out of all entities."""
    seen = df.groupBy(entity).agg(
        F.max((F.col(period) == train).cast("int")).alias("in_train"),
        F.max((F.col(period) == test).cast("int")).alias("in_test"),
    )
    return seen.agg(
        F.count("*").alias("n_entities"),
        F.coalesce(F.sum("in_train"), F.lit(0)).alias("n_train"),
        F.coalesce(F.sum("in_test"), F.lit(0)).alias("n_test"),
        F.count(F.when((F.col("in_train") == 1) & (F.col("in_test") == 1), 1)).alias("n_both"),
    ).withColumn("pct_both", 100 * share(F.col("n_both"), F.col("n_entities")))


def five_number(df: DataFrame, column: str) -> DataFrame:
    """Minimum, quartiles and maximum, exact."""
    named = dict(zip(["q0", "q1", "q2", "q3", "q4"], ["minimum", "p25", "p50", "p75", "maximum"]))
    return exact_quantiles(df, [column], [0, 0.25, 0.5, 0.75, 1]).drop("n").withColumnsRenamed(named)


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample deviation, minimum, quartiles and maximum per column."""
    moments = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.count(c).alias("n"),
                    F.avg(c).alias("mean"),
                    F.stddev_samp(c).alias("std"),
                    F.min(c).cast("double").alias("minimum"),
                    F.max(c).cast("double").alias("maximum"),
                )
                for c in columns
            ]
        ).alias("rows")
    ).select(F.inline("rows"))
    named = {"q0": "p25", "q1": "p50", "q2": "p75"}
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).drop("n").withColumnsRenamed(named)
    return moments.join(quartiles, "column", "left")


def null_audit(df: DataFrame) -> DataFrame:
    """Columns with missing values (NULL or NaN) and how many, most first. One pass for all columns."""
    missing = lambda c, kind: F.col(c).isNull() | F.isnan(c) if kind in ("double", "float") else F.col(c).isNull()
    rows = [
        F.struct(F.lit(c).alias("column"), F.count(F.when(missing(c, kind), 1)).alias("n_missing")) for c, kind in df.dtypes
    ]
    return (
        df.agg(F.array(*rows).alias("rows"))
        .select(F.inline("rows"))
        .where("n_missing > 0")
        .orderBy(F.desc("n_missing"), "column")
    )


def cardinality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values per column, a missing value counting as one more."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    # Distinct (column, value) pairs first: they combine before the shuffle and no column becomes one group.
    return (
        df.select(F.inline(pairs)).distinct().groupBy("column").agg(F.count("*").alias("n_distinct"))
    )


def histogram(df: DataFrame, column: str, bins: int = 30, mark: float | None = None) -> DataFrame:
    """Equal-width bins over the observed range (the last one closed), empty bins included.

    With ``mark``, also how many values of the bin lie at or above it.
    """
    values = df.select(no_nan(F.col(column).cast("double")).alias("value")).where(F.col("value").isNotNull())
    # Two numbers as literals, so the binning pass does not carry subqueries.
    low, high = values.agg(F.min("value"), F.max("value")).first()
    low, width = (low, (high - low) / bins) if low is not None else (0.0, 0.0)
    position = (F.col("value") - low) / width if width > 0 else F.lit(0.0)
    binned = values.select("value", F.greatest(F.least(F.floor(position), F.lit(bins - 1)), F.lit(0)).cast("int").alias("bin"))
    measures = [F.count("*").alias("n")]
    if mark is not None:
        measures.append(F.count(F.when(F.col("value") >= mark, 1)).alias("n_at_or_above"))
    counted = binned.groupBy("bin").agg(*measures)
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return edges.join(counted, "bin", "left").na.fill(0).select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("upper"),
        *[c for c in counted.columns if c != "bin"],
    )


def step_counts(steps: list[tuple[str, DataFrame]]) -> DataFrame:
    """Rows left after each cleaning step, in order."""
    counts = [
        frame.agg(F.lit(i).alias("step"), F.lit(name).alias("name"), F.count("*").alias("n_rows"))
        for i, (name, frame) in enumerate(steps)
    ]
    return reduce(DataFrame.unionByName, counts)
