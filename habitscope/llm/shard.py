"""Shards by a keyed permutation of global row numbers (DataFrame functions only).

Global row numbers: rows are counted file by file and numbered in file order. A Feistel
network over pairs (left, right) below m = ceil(sqrt(n)) permutes 0 .. m*m - 1; a number
that leaves 0 .. n - 1 is permuted again until it is back (cycle walking), which is a
permutation of the n rows. Its result p gives shard p mod k and slot p div k: counts
differ by one at most, slots have no gaps, and both can be computed for any row number
without the data.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habitscope.llm.rows import as_scan, file_rows
from habitscope.sources.scratch import settled

PRIME = 2_147_483_647
FACTOR = 48_271
#: Up to so many files (a path and a count each) their starts are broadcast.
BROADCAST_FILES = 50_000


def round_keys(seed: int, rounds: int) -> list[int]:
    digests = (hashlib.sha256(f"{seed}:{i}".encode()).digest() for i in range(rounds))
    return [int.from_bytes(d[:4], "big") % PRIME for d in digests]


def _once(number: Column, side: int, keys: list[int]) -> Column:
    """One pass of the network; exact for numbers below 2^53."""
    def step(state: Column, key: Column) -> Column:
        linear = (state["right"] * FACTOR + key) % PRIME
        spread = ((linear * linear + key) % PRIME) % side
        return F.struct(state["right"].alias("left"), ((state["left"] + spread) % side).alias("right"))

    right = number % side
    start = F.struct(((number - right) / side).cast("long").alias("left"), right.alias("right"))
    return F.aggregate(F.array(*[F.lit(k).cast("long") for k in keys]), start, step,
                       lambda state: state["left"] * side + state["right"])


def permuted(number: Column, rows: int, seed: int, rounds: int = 6) -> Column:
    """Place of row ``number`` (long, 0 .. rows - 1) in the shuffle.

    At most 2 * side numbers lie outside, so a walk of 64 steps suffices for up to 1,024
    rows and beyond that fails with a chance below 16^-64; it would raise, not mislead.
    """
    side = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    keys = round_keys(seed, rounds)
    steps = F.sequence(F.lit(1), F.lit(max(64, min(2 * side + 1, 96))))
    walked = F.aggregate(steps, number, lambda at, _: F.when(at < rows, at).otherwise(_once(at, side, keys)))
    return F.when(number < rows, number).otherwise(
        F.when(walked < rows, walked).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long")))


def numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` with ``row_number`` (from 0, by file and place in the file), and their number.

    Only the files' row counts are put in order; no row is shuffled.
    """
    placed = file_rows(docs.drop("row_number"))
    files = placed.groupBy(F.col("__path").alias("__file")).count()
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = settled(
        files.select("__file", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start")), "files")
    n_files, rows = starts.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    starts = starts.drop("count")
    if n_files <= BROADCAST_FILES:
        starts = F.broadcast(starts)
    return (
        placed.join(starts, F.col("__path") == F.col("__file"))
        .withColumn("row_number", (F.col("__start") + F.col("__row")).cast("long"))
        .drop("__path", "__row", "__file", "__start")
    ), rows


def in_row_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``order_key``: row numbers spread evenly over 0 .. 2^63."""
    table, rows = numbered(as_scan(docs))
    step = (1 << 63) // max(rows, 1)
    return table.withColumn("order_key", F.col("row_number") * F.lit(min(step, (1 << 63) - 1))).drop("row_number")


def sharded(docs: DataFrame, shards: int, seed: int = 11, rounds: int = 6) -> DataFrame:
    """``docs`` with ``row_number``, ``shard`` and ``slot``; nothing is shuffled.

    Any column may be null and rows may repeat: only a row's place in the table counts.
    An empty table gives no rows. Columns of ``docs`` with these three names are replaced.
    The permutation is fixed by the table's files, the number of rows and the seed.
    """
    table, rows = numbered(as_scan(docs))
    side = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return (
        table.withColumn("__first", _once(F.col("row_number"), side, round_keys(seed, rounds)))
        .withColumn("__place", permuted(F.col("__first"), rows, seed, rounds))
        .withColumn("shard", (F.col("__place") % shards).cast("int"))
        .withColumn("slot", F.expr(f"__place div {shards}"))
        .drop("__first", "__place")
    )


def digest(docs: DataFrame, shards: int = 24, seed: int = 11) -> DataFrame:
    """The sharding of ``documents`` as one row per document."""
    sized = docs.select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    return sharded(sized, shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")
