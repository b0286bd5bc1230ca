"""Scalar Column expressions used by the cleaning, encoding and feature steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# The two ways a typographic apostrophe reaches us. The second is
# the UTF-8 bytes of the first read as Windows-1252.
TYPOGRAPHIC_APOSTROPHE = "’"
MISREAD_APOSTROPHE = "â€™"


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- types and text ---------------------------------------------------------


def lenient_cast(c: ColumnOrName, target: str, source: T.DataType | None = None) -> Column:
    """Cast that yields NULL instead of failing the job under ANSI mode.

    Fractions are cut toward zero on the way to an integer. Text is read as a
    number first, so ``"3.0"`` becomes 3 and not NULL.
    """
    column = as_column(c)
    integral = target.lower() in ("tinyint", "smallint", "int", "integer", "bigint", "long")
    if integral and isinstance(source, T.StringType):
        column = column.try_cast("double")
    return column.try_cast(target)


def parsed_date(c: ColumnOrName, pattern: str = "M/d/yyyy") -> Column:
    """Date from text; unparseable text becomes NULL."""
    return F.try_to_date(as_column(c), pattern)


def straight_apostrophes(c: ColumnOrName) -> Column:
    """Replace the typographic apostrophe by ``'``, everywhere in the text."""
    return F.regexp_replace(as_column(c), TYPOGRAPHIC_APOSTROPHE, "'")


def repaired_apostrophes(c: ColumnOrName) -> Column:
    """Replace the misread three-character apostrophe by ``'``."""
    return F.regexp_replace(as_column(c), MISREAD_APOSTROPHE, "'")


def floored_int(c: ColumnOrName) -> Column:
    return F.floor(as_column(c)).cast("int")


# -- codes ------------------------------------------------------------------


def code_of(c: ColumnOrName, codes: Mapping[str, float]) -> Column:
    """One flat CASE from category to double code; anything unmapped is NULL."""
    column = as_column(c)
    expr = None
    for label, code in codes.items():
        arm = (column == F.lit(label), F.lit(float(code)))
        expr = F.when(*arm) if expr is None else expr.when(*arm)
    return F.lit(None).cast("double") if expr is None else expr


def first_match(
    rules: Sequence[tuple[str, Column]], default: str, null_label: str | None = None,
    null_when: Column | None = None,
) -> Column:
    """First rule that holds gives the label; the default also receives NULLs.

    ``null_label`` with ``null_when`` puts the NULL rows in a class of their own.
    """
    arms = list(rules)
    if null_label is not None and null_when is not None:
        arms.insert(0, (null_label, null_when))
    (label, predicate), *rest = arms
    expr = F.when(predicate, F.lit(label))
    for label, predicate in rest:
        expr = expr.when(predicate, F.lit(label))
    return expr.otherwise(F.lit(default))


# -- arithmetic -------------------------------------------------------------


def total_of(*cols: ColumnOrName) -> Column:
    """Sum across columns; NULL if any part is NULL."""
    return reduce(add, [as_column(c) for c in cols])


def guarded_ratio(
    numerator: ColumnOrName, denominator: ColumnOrName, otherwise: Column | float = 0.0
) -> Column:
    """``n / d`` where ``d > 0``; ``otherwise`` when it is zero, negative or NULL."""
    n, d = as_column(numerator), as_column(denominator)
    fallback = otherwise if isinstance(otherwise, Column) else F.lit(float(otherwise))
    return F.when(d > 0, n / d).otherwise(fallback)


def safe_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``n / d``, NULL for a zero or NULL divisor (plain ``/`` fails under ANSI)."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def add_one_ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    return (as_column(numerator) + 1) / (as_column(denominator) + 1)


def weighted_sum(weights: Mapping[str, float]) -> Column:
    return reduce(add, [F.col(name) * F.lit(float(w)) for name, w in weights.items()])


def weekly_total(per_week: ColumnOrName, per_day: ColumnOrName) -> Column:
    return as_column(per_week) + as_column(per_day) * 7


def years_since(year: ColumnOrName, as_of_year: int) -> Column:
    return F.lit(as_of_year) - as_column(year)


def scaled_down(c: ColumnOrName, by: float) -> Column:
    return as_column(c) / F.lit(float(by))


def gap_from(c: ColumnOrName, ideal: float, weight: float = 1.0) -> Column:
    """Weighted distance from an ideal value."""
    return F.abs(as_column(c) - F.lit(ideal)) * F.lit(float(weight))


def abs_z(c: ColumnOrName, mean: Column, sd: Column) -> Column:
    """Absolute z-score; NULL when the deviation is zero (a constant column)."""
    return F.abs(safe_ratio(as_column(c) - mean, sd))


def range_scaled(
    c: ColumnOrName, low: Column, high: Column, epsilon: float = 1e-5, scale: float = 1.0
) -> Column:
    """Min-max scaling; epsilon keeps a constant column from dividing by zero."""
    return (as_column(c) - low) / (high - low + F.lit(epsilon)) * F.lit(float(scale))


# -- stable row buckets -----------------------------------------------------

BUCKETS = 1 << 32


def key_fraction(*keys: ColumnOrName, seed: int = 42) -> Column:
    """A number in [0, 1) fixed by the key and the seed alone.

    Unlike ``rand``/``sample``/``randomSplit`` it does not depend on how rows are
    laid out over partitions, so a recomputed task (a lost executor) or another
    cluster size puts every row on the same side. MD5 rather than xxhash64, so
    that any SQL engine can reproduce it.
    """
    parts = [F.lit(str(seed)), *[as_column(k).cast("string") for k in keys]]
    head = F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(float(BUCKETS))
