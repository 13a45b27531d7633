"""Column expressions. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def threshold_label(value: str | Column, threshold: float) -> Column:
    """1 where the value reaches the threshold, else 0. A missing value counts as not reached."""
    return F.when(_col(value) >= threshold, 1).otherwise(0)


def cut(
    value: str | Column, edges: list[float], labels: list[str], right: bool = True, missing: str | None = "nan"
) -> Column:
    """Label of the interval holding the value: ``(lo, hi]``, or ``[lo, hi)`` when ``right`` is false.

    Values outside every interval, and missing ones, get ``missing``.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    v = _col(value)
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        inside = ((v > lo) & (v <= hi)) if right else ((v >= lo) & (v < hi))
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out.otherwise(F.lit(missing))


def bands(value: str | Column, edges: list[float], labels: list[str]) -> Column:
    """Label by increasing edges with open ends: below ``edges[0]``, then ``[lo, hi)``, then the rest."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    v = _col(value)
    out = F.when(v < edges[0], labels[0])
    for hi, label in zip(edges[1:], labels[1:]):
        out = out.when(v < hi, label)
    return out.when(v.isNotNull(), labels[-1])


def ratio(top: Column, bottom: Column) -> Column:
    """Division that is 0 when undefined, as for precision without positive predictions."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def share(top: Column, bottom: Column) -> Column:
    """Division that is NULL when undefined."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def state_code(municipality: str | Column) -> Column:
    """First two characters of the municipality id."""
    return F.substring(_col(municipality).cast("string"), 1, 2)


def no_nan(value: str | Column) -> Column:
    """One missing value only: NaN becomes NULL."""
    return F.nanvl(_col(value), F.lit(None).cast("double"))


def hash32(key: str | Column, seed: int) -> Column:
    """A uniform number in [0, 2^32) fixed by seed and key, whatever the partitioning or the engine.

    Rows without a key share the number of the empty key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(_col(key).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def any_null(*columns: str) -> Column:
    """True where at least one of the columns is missing."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
