"""Z-score columns against whole-table statistics, and classes built on them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from habitscope.functions.columns import abs_z
from habitscope.operators.onerow import STATS, attach_one_row, stat


def mean_and_deviation(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """One row: ``mean_<out>`` and population ``sd_<out>`` per (out, column)."""
    return df.agg(
        *[F.avg(c).alias(f"mean_{out}") for out, c in cols.items()],
        *[F.stddev_pop(c).alias(f"sd_{out}") for out, c in cols.items()],
    )


def with_abs_z(df: DataFrame, cols: Mapping[str, str], prefix: str = "z_") -> DataFrame:
    """Add ``z_<out>``: absolute z-score of each column, NULL for a constant column."""
    scores = {
        prefix + out: abs_z(c, stat(f"mean_{out}"), stat(f"sd_{out}")) for out, c in cols.items()
    }
    return attach_one_row(df, mean_and_deviation(df, cols)).withColumns(scores).drop(STATS)
