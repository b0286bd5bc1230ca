"""Cleaning: dedupe, required columns, casts, text repair, filters, imputation, audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from habitscope.functions import columns as C
from habitscope.operators.onerow import STATS, attach_one_row, stat

# -- one row per key ----------------------------------------------------------


def keep_one_per_key(
    df: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = (), copies: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Keep, per key, the row with the greatest ``prefer`` tuple.

    The remaining columns break ties, so the outcome depends on the data only and
    never on row order; ``unique`` states that ``prefer`` has no ties, and columns that
    nobody reads afterwards are then not carried along. Every map task reduces its rows
    of a key to one before the shuffle, so a key that owns a third of the table costs no
    more than any other. ``copies`` names an optional column with the number of rows
    seen for the key.
    """
    columns = df.columns
    if not copies:
        ties = [] if unique else [F.col(c) for c in columns if c not in keys]
        order = [c.desc_nulls_last() for c in (*prefer, *ties)] or [F.lit(0)]
        best = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn("place_in_key", best).filter("place_in_key = 1").select(*columns)
    others = [c for c in columns if c not in keys]
    marks = [p.alias(f"prefer_{i}") for i, p in enumerate(prefer)]
    aggregates = [F.max(F.struct(*marks, *others)).alias("kept")]
    if copies:
        aggregates.append(F.count(F.lit(1)).alias(copies))
    kept = df.groupBy(*keys).agg(*aggregates)
    names = [f"kept.{c}" if c in others else c for c in columns]
    return kept.select(*names, *([copies] if copies else []))


def is_complete(required: Sequence[str]) -> Column:
    """1 where every required column is present, else 0: a ``prefer`` mark."""
    return reduce(and_, [F.col(c).isNotNull() for c in required]).cast("int")


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(required))


# -- types and text -----------------------------------------------------------


def cast_columns(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Cast in place, all columns in one projection."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: C.lenient_cast(c, t, types[c]) for c, t in targets.items()})


def cast_and_move_last(df: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Untouched columns first, then the cast ones in the given order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    kept = [c for c in df.columns if c not in targets]
    cast = [C.lenient_cast(c, t, types[c]).alias(c) for c, t in targets.items()]
    return df.select(*kept, *cast)


def repair_apostrophes(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns(
        {c: C.repaired_apostrophes(C.straight_apostrophes(c)) for c in cols}
    )


def parse_dates(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: C.parsed_date(c, p) for c, p in patterns.items()})


def floor_to_int(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: C.floored_int(c) for c in cols})


# -- filters --------------------------------------------------------------------

Range = tuple[float, float]


def in_ranges(ranges: Mapping[str, Range]) -> Column:
    """Every column inside its closed range; a NULL makes the row fail."""
    return reduce(and_, [F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()])


def within_ranges(df: DataFrame, ranges: Mapping[str, Range]) -> DataFrame:
    return df.filter(in_ranges(ranges))


def exclude_value(df: DataFrame, col: str, value: str) -> DataFrame:
    """Rows where the column differs from the value; NULL rows go as well."""
    return df.filter(F.col(col) != F.lit(value))


# -- imputation -------------------------------------------------------------------


def column_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row of means, ignoring NULLs. A column without values has a NULL mean."""
    return df.agg(*[F.avg(c).alias(c) for c in cols])


def fill_from(df: DataFrame, means: DataFrame) -> DataFrame:
    """Fill NULLs of the columns of ``means`` from its one row.

    ``means`` may come from another table: fit on the training part, apply to both.
    """
    filled = {c: F.coalesce(F.col(c), stat(c)) for c in means.columns}
    return attach_one_row(df, means).withColumns(filled).drop(STATS)


def impute_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fill_from(df, column_means(df, cols))


# -- audit ------------------------------------------------------------------------


def shape_audit(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Row count, column count and, per rule, how many rows satisfy it; one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        *[F.count_if(p).alias(name) for name, p in rules.items()],
    )


def first_failed_rule(rules: Mapping[str, Column], kept: str = "kept") -> Column:
    """Name of the first rule a row fails; a rule that is NULL counts as failed."""
    failed = [(name, ~F.coalesce(p, F.lit(False))) for name, p in rules.items()]
    return C.first_match(failed, kept)


def reject_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows per first failed rule, plus the rows kept: sums to the input size."""
    outcome = first_failed_rule(rules).alias("outcome")
    return df.groupBy(outcome).agg(F.count(F.lit(1)).alias("rows"))
