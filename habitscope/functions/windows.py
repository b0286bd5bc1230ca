"""Window Columns for ranking and shares over *aggregated* rows.

Windows without a partition put all their rows in one task, so they belong on
the output of a ``groupBy`` over a bounded set of labels. For an unbounded
input use ``habitscope.operators.report.rank_everywhere`` and ``top_ranked``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, functions as F
from pyspark.sql.window import WindowSpec

from habitscope.functions.columns import ColumnOrName, as_column


def _spec(within: Sequence[ColumnOrName]) -> WindowSpec:
    return Window.partitionBy(*[as_column(k) for k in within])


def rank_desc(value: ColumnOrName, within: Sequence[ColumnOrName] = ()) -> Column:
    """RANK with gaps, largest first, NULLs last."""
    order = as_column(value).desc_nulls_last()
    return F.rank().over(_spec(within).orderBy(order)).cast("bigint")


def number_desc(
    value: ColumnOrName, tiebreak: Sequence[ColumnOrName],
    within: Sequence[ColumnOrName] = (),
) -> Column:
    """ROW_NUMBER, largest first; the tiebreak makes it reproducible."""
    order = [as_column(value).desc_nulls_last(), *[as_column(t).asc_nulls_last() for t in tiebreak]]
    return F.row_number().over(_spec(within).orderBy(*order)).cast("bigint")


def number_asc(
    value: ColumnOrName, tiebreak: Sequence[ColumnOrName] = (),
    within: Sequence[ColumnOrName] = (),
) -> Column:
    order = [as_column(c).asc_nulls_last() for c in (value, *tiebreak)]
    return F.row_number().over(_spec(within).orderBy(*order)).cast("bigint")


def total_over(value: ColumnOrName, within: Sequence[ColumnOrName] = ()) -> Column:
    return F.sum(as_column(value)).over(_spec(within))
