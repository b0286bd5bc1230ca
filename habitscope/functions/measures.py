"""Aggregate Columns. Each is a declarative aggregate with map-side combine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from habitscope.functions.columns import ColumnOrName, as_column


def row_count() -> Column:
    return F.count(F.lit(1))


def _rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def mean_of(c: ColumnOrName, digits: int | None = None, times: float | None = None) -> Column:
    value = F.avg(as_column(c))
    if times is not None:
        value = value * F.lit(float(times))
    return _rounded(value, digits)


def ratio_of_means(
    numerator: ColumnOrName, denominator: ColumnOrName,
    digits: int | None = None, times: float | None = None,
) -> Column:
    """mean(n) / mean(d); NULL when mean(d) is zero or NULL."""
    top = mean_of(numerator, times=times)
    return _rounded(F.try_divide(top, F.avg(as_column(denominator))), digits)


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage as a double (a decimal literal would make it a decimal)."""
    return F.round(part.cast("double") * F.lit(100.0) / whole.cast("double"), digits)
