"""Whole-table running totals, ranks and exact quantiles without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ambar.functions.scalars import no_nan
from ambar.operators.joins import sized_join
from ambar.session import materialise, small_frame


def _name(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def running_totals(df: DataFrame, order: list[Column | str], values: list[str], by: list[str] | None = None) -> DataFrame:
    """Add ``<v>_run`` (running total in ``order``, current row included) and ``<v>_total`` per group.

    Two levels: range partitioning puts consecutive rows into even slices, the slice totals (about
    one row per partition) give each slice its starting offset, and the windows run inside slices.
    ``order`` must be free of ties inside a group, so reduce to one row per ordering value first.
    The slice numbers depend on sampled bounds, hence the frame is materialised before it is read twice.
    """
    by = by or []
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A struct of group columns compares equal also where a group value is missing.
    group = F.struct(*by) if by else F.lit(0)
    order = [_name(c) for c in order]
    staged = materialise(
        df.withColumn("_group", group)
        .repartitionByRange(parts, F.col("_group"), *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    whole = Window.partitionBy("_group")
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged.groupBy("_group", "_slice").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    offsets = offsets.select(
        "_group",
        "_slice",
        *[F.sum(f"_sum_{v}").over(before).alias(f"_before_{v}") for v in values],
        *[F.sum(f"_sum_{v}").over(whole).alias(f"{v}_total") for v in values],
    )
    inside = Window.partitionBy("_group", "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = staged.select("*", *[F.sum(v).over(inside).alias(f"_local_{v}") for v in values])
    joined = local.join(offsets, ["_group", "_slice"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_local_{v}") + F.coalesce(F.col(f"_before_{v}"), F.lit(0))).alias(f"{v}_run") for v in values],
        *[f"{v}_total" for v in values],
    )


def next_values(df: DataFrame, order: list[Column | str], columns: list[str]) -> DataFrame:
    """Add ``next_<c>``, the value of ``c`` in the row that follows in ``order`` over the whole table (NULL for the last).

    Even range slices as in :func:`running_totals`: inside a slice a window looks ahead, and its last row takes the first
    values of the slice behind. ``order`` must be free of ties.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [_name(c) for c in order]
    staged = materialise(df.repartitionByRange(parts, *order).withColumn("_slice", F.spark_partition_id()))
    inside = Window.partitionBy("_slice").orderBy(*order)
    local = staged.select("*", F.struct(*columns).alias("_own"), F.row_number().over(inside).alias("_place"), F.lead(F.struct(*columns)).over(inside).alias("_ahead"))
    local = materialise(local)
    # One row per slice: few, whatever the size of the table.
    behind = F.lead("_own").over(Window.orderBy("_slice"))
    firsts = local.where("_place = 1").select("_slice", "_own").select("_slice", behind.alias("_behind"))
    found = F.coalesce("_ahead", "_behind")
    return local.join(F.broadcast(firsts), "_slice").select(*df.columns, *[found[c].alias(f"next_{c}") for c in columns])


ACCURACY = 10_000


def _bands(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, list[tuple[float, float]]]:
    """Per column, disjoint value ranges that hold the wanted ranks, from mergeable quantile summaries.

    A summary is off by at most 1/ACCURACY of the rows; the ranges reach twice as far to each side.
    """
    reach = 2 / ACCURACY
    ends = [q for p in probabilities for q in (max(0.0, p - reach), min(1.0, p + reach))]
    summaries = [
        F.percentile_approx(no_nan(F.col(c).cast("double")), ends, ACCURACY).alias(f"c{i}") for i, c in enumerate(columns)
    ]
    row, bands = df.agg(*summaries).first(), {}
    for i, c in enumerate(columns):
        found: list[tuple[float, float]] = []
        values = row[f"c{i}"] or []
        for low, high in sorted(zip(values[::2], values[1::2])):
            if found and low <= found[-1][1]:
                found[-1] = (found[-1][0], max(high, found[-1][1]))
            else:
                found.append((low, high))
        bands[c] = found
    return bands


def _segment(value: Column, bands: list[tuple[float, float]] | None) -> Column:
    """Position of a value among the bands: odd inside band ``segment // 2``, even between bands."""
    if bands is None:
        return F.lit(1)
    out = F.when(F.lit(False), 0)
    for i, (low, high) in enumerate(bands):
        out = out.when(value < low, 2 * i).when(value <= high, 2 * i + 1)
    return out.otherwise(2 * len(bands))


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], by: list[str] | None = None
) -> DataFrame:
    """Exact interpolated quantiles, all columns in one job: rows (by…, column, n, q0, q1, …).

    Without groups, a first pass narrows each wanted rank to a thin band of values. The second pass
    counts values one by one inside the bands and only in bulk between them, so little is shuffled
    and sorted. A rank that fell outside its band would show as a missing result; then, and with
    groups, all distinct values are counted. No aggregate buffer ever holds a whole column.
    Missing values are left out.
    """
    if by:
        return _counted_quantiles(df, columns, probabilities, by, dict.fromkeys(columns))
    narrow = _counted_quantiles(df, columns, probabilities, [], _bands(df, columns, probabilities))
    rows = narrow.collect()  # one per column
    if any(q is None for row in rows for q in row):
        return _counted_quantiles(df, columns, probabilities, [], dict.fromkeys(columns))
    return small_frame(df.sparkSession, rows, narrow.schema)


def _counted_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float], by: list[str], bands: dict
) -> DataFrame:
    entries = []
    for c in columns:
        value = F.col(c).cast("double")
        segment = _segment(value, bands[c])
        entries.append(
            F.struct(
                F.lit(c).alias("column"),
                segment.alias("segment"),
                F.when(segment % 2 == 1, value).alias("value"),
                (value.isNotNull() & ~F.isnan(value)).alias("known"),
            )
        )
    counted = (
        df.select(*by, F.inline(F.array(*entries)))
        .where("known")
        .groupBy(*by, "column", "segment", "value")
        .agg(F.count("*").alias("n"))
    )
    ranked = running_totals(counted, ["segment", "value"], ["n"], [*by, "column"])

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("n_run") - F.col("n")) & (rank < F.col("n_run")), F.col("value")))

    aggregates, outputs = [F.max("n_total").alias("n")], []
    for i, p in enumerate(probabilities):
        position = F.lit(float(p)) * (F.col("n_total") - 1)
        aggregates += [
            at(F.floor(position)).alias(f"_lo{i}"),
            at(F.ceil(position)).alias(f"_hi{i}"),
            F.max(position - F.floor(position)).alias(f"_at{i}"),
        ]
        outputs.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_at{i}")).alias(f"q{i}"))
    return ranked.groupBy(*by, "column").agg(*aggregates).select(*by, "column", "n", *outputs)


def with_rank(df: DataFrame, value: str, out: str = "rank", descending: bool = False) -> DataFrame:
    """Competition rank (ties share the best rank) over the whole table. Missing values rank last.

    ``df`` is computed once: ranks are found by value, and a value that came out differently the second time would
    find none.
    """
    df = materialise(df)
    counted = df.groupBy(value).agg(F.count("*").alias("n"))
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    ranks = materialise(
        running_totals(counted, [order], ["n"]).select(
            F.struct(F.col(value)).alias("_value"), "n", (F.col("n_run") - F.col("n") + 1).alias(out)
        )
    )
    keyed = df.withColumn("_value", F.struct(F.col(value)))
    return sized_join(keyed, ranks, ["_value"], "inner", rows_col="n").drop("_value", "n")


def cumulative_share(df: DataFrame, name: str, value: str, covers: list[float]) -> tuple[DataFrame, DataFrame]:
    """Running share of ``value`` from the largest down, and how many rows reach each cover.

    The second frame has one row: ``n_<percent>`` = rows with running share ≤ cover, plus one.
    """
    run = running_totals(df.select(name, value), [F.desc(value), F.asc(name)], [value])
    shares = run.select(name, value, (F.col(f"{value}_run") / F.col(f"{value}_total")).alias("cumulative_share"))
    needed = shares.agg(
        *[
            (F.count(F.when(F.col("cumulative_share") <= c, 1)) + 1).alias(f"n_{round(c * 100)}")
            for c in covers
        ]
    )
    return shares, needed
