"""Row identities and ranks that hold however the rows are dealt out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habitscope.sources.scratch import settled

#: Bits of a page of a bit table (4 KB), and of all its pages. More numbers than that share bits.
PAGE, BITS = 1 << 15, 1 << 26


def as_scan(df: DataFrame) -> DataFrame:
    """``df`` if it is a file scan, else a copy written to the shared folder and read back."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"])
        return df
    except AnalysisException:
        return settled(df, "rows")


def file_rows(df: DataFrame) -> DataFrame:
    """``df`` with ``__path`` (its file) and ``__row`` (the row's place in the file).

    Both come from the scan, so they cost no shuffle, are unique even for repeated rows,
    and stay the same when a lost task runs again or the scan is split another way.
    """
    scan = as_scan(df)
    meta = scan.metadataColumn("_metadata")
    return scan.select("*", meta["file_path"].alias("__path"), meta["row_index"].alias("__row"))


def ranked_within(df: DataFrame, group: str, key: Column, *ties: Column, rank: str = "__rank",
                  bits: int = 10) -> DataFrame:
    """``df`` with the rank (from 0) of each row among those of its ``group``, in the order
    of a 64-bit hash ``key``.

    A group is cut into 2^bits ranges of the key. Ranges are counted, each is ranked by
    itself and moved by the rows of the ranges before it: no group, however large, is
    sorted in one task, and a group has at most 2^bits counts. ``df`` is read twice.
    """
    keyed = df.withColumn("__key", key).withColumn("__range", F.shiftrightunsigned("__key", 64 - bits))
    before = Window.partitionBy("__group").orderBy("__from").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy(F.col(group).alias("__group"), F.col("__range").alias("__from")).count()
        .select("__group", "__from", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    )
    inside = Window.partitionBy(group, "__range").orderBy("__key", *ties)
    return (
        keyed.withColumn("__in", F.row_number().over(inside) - 1)
        .join(starts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__range") == F.col("__from")))
        .withColumn(rank, (F.col("__start") + F.col("__in")).cast("long"))
        .drop("__group", "__from", "__start", "__in", "__key", "__range")
    )


def least_hashed(df: DataFrame, limit: int, seed: int, *columns: str) -> DataFrame:
    """At most ``limit`` rows of ``df``, those of least seeded hash of ``columns``.

    A threshold that lets about four times the limit through comes first, so what tasks
    send on is bounded by ``limit`` and not by their number. ``df`` is counted.
    """
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)
    share = min(1.0, (4 * limit + 64) / max(df.count(), 1))
    few = df.where(key <= F.lit(min(int(share * (1 << 63)), (1 << 63) - 1)))
    return few.withColumn("__key", key).orderBy("__key", *columns).limit(limit).drop("__key")


def at_places(df: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of the scan ``df`` at ``places`` (``__path``, ``__row``; a bounded sample,
    which is broadcast)."""
    return file_rows(df).join(F.broadcast(places.select("__path", "__row")), ["__path", "__row"]).drop("__path", "__row")


def picked(df: DataFrame, chosen: DataFrame, rows: int) -> DataFrame:
    """The rows of ``df`` whose ``row_number`` (0 .. ``rows`` - 1) is among those of ``chosen``,
    which may repeat them and has no other column.

    A bit for each number is broadcast, 8 MB at most, so a row that is left out is not
    shuffled. Numbers beyond share their bits with others; then what passes is joined
    exactly, and only that moves.
    """
    chosen = settled(chosen, "chosen")
    bit = F.col("row_number") % BITS
    pages = settled(
        chosen.groupBy(F.floor(bit / PAGE).alias("__page")).agg(F.bitmap_construct_agg(bit % PAGE).alias("__bits")), "bits")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit % PAGE / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    passed = (
        df.join(F.broadcast(pages), F.floor(bit / PAGE) == F.col("__page"))
        .where(F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1).drop("__page", "__bits")
    )
    return passed if rows <= BITS else passed.join(chosen.distinct(), "row_number", "left_semi")
