"""Grouped reports: aggregate, filter groups, rank, share, order, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from habitscope.functions.columns import ColumnOrName, as_column
from habitscope.operators.onerow import STATS, attach_one_row, stat
from habitscope.sources.scratch import settled


def grouped(
    df: DataFrame, keys: Sequence[ColumnOrName], measures: Mapping[str, Column],
    having: Column | None = None,
) -> DataFrame:
    """Group by columns or labelled expressions; ``having`` sees keys and measures."""
    out = df.groupBy(*[as_column(k) for k in keys]).agg(
        *[m.alias(name) for name, m in measures.items()]
    )
    return out if having is None else out.filter(having)


def top_ranked(
    df: DataFrame, k: int, sort_by: Sequence[str], rank_by: str, rank_name: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """First ``k`` rows by ``sort_by`` descending, with their RANK by ``rank_by``.

    ``sort_by`` must be non-decreasing in ``rank_by`` (the same value, or a
    rounding of it). Breaking its ties by ``rank_by`` puts every row with a better
    rank inside the first ``k``, so ranking those k rows gives the rank among
    all: each task keeps k candidates and no global sort is needed.
    """
    first = df.orderBy(
        *[F.col(c).desc_nulls_last() for c in (*sort_by, rank_by)],
        *[F.col(c).asc_nulls_last() for c in tiebreak],
    ).limit(k)
    by_value = Window.partitionBy().orderBy(F.col(rank_by).desc_nulls_last())
    return first.withColumn(rank_name, F.rank().over(by_value).cast("bigint"))


def rank_everywhere(df: DataFrame, value: str, name: str, buckets: int | None = None) -> DataFrame:
    """RANK over the whole table (largest first, NULLs last) without one big sort.

    Equal values are counted first and the counts settled, so the input is read once
    for them and a value held by a third of the rows is one entry. The distinct values are cut into ranges at approximate percentiles
    (their precision only affects balance); the rank is the number of rows in
    higher ranges plus those before the value inside its own range. There are as many
    ranges as the session has shuffle partitions, if ``buckets`` is not given.
    """
    v = F.col(value)
    if buckets is None:
        buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = settled(df.groupBy(value).agg(F.count(F.lit(1)).alias("n")), "value-counts")
    steps = [i / buckets for i in range(1, buckets)]
    cuts = counts.agg(F.percentile_approx(v, steps).alias("cuts"))
    higher_cuts = F.size(F.filter(stat("cuts"), lambda cut: cut > v))
    # Never NULL, and visibly so: otherwise the join below makes Spark test the
    # bucket of every input row instead of every distinct value.
    bucket = F.coalesce(F.when(v.isNotNull(), higher_cuts), F.lit(buckets))
    bucketed = attach_one_row(counts, cuts).select(value, "n", bucket.alias("bucket"))
    before = Window.partitionBy("bucket").orderBy(v.desc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = Window.partitionBy().orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = bucketed.groupBy("bucket").agg(F.sum("n").alias("n")).select(
        "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    ranked = (
        bucketed.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(F.broadcast(starts), "bucket")  # at most buckets + 1 rows
        .select(v.alias("ranked_value"), (F.col("start") + F.col("before") + 1).alias(name))
    )
    return df.join(ranked, v.eqNullSafe(F.col("ranked_value"))).drop("ranked_value")


def share_of_all(df: DataFrame, part: str, name: str, digits: int = 2) -> DataFrame:
    """Percentage of the grand total of ``part``; the total is a one-row aggregate."""
    total = df.agg(F.sum(part).cast("double").alias("total"))
    share = F.round(F.col(part).cast("double") * F.lit(100.0) / stat("total"), digits)
    return attach_one_row(df, total).withColumn(name, share).drop(STATS)
