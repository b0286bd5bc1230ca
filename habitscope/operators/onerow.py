"""Attach a one-row statistics relation to every row of a table.

The statistics always come from an aggregate without keys, so there is exactly
one row. It travels as a scalar subquery: no join is planned, nothing grows with
the data, and Spark fails if the relation ever holds a second row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

STATS = "one_row_stats"


def attach_one_row(df: DataFrame, stats: DataFrame, name: str = STATS) -> DataFrame:
    """``df`` plus one struct column holding the fields of the one-row ``stats``."""
    return df.withColumn(name, stats.select(F.struct(*stats.columns)).scalar())


def stat(field: str, name: str = STATS) -> Column:
    return F.col(name).getField(field)
