"""Interleave sources to target weights by Pfair scheduling (DataFrame functions only).

A source's documents, in a seeded hash order, are cut into blocks. With weight w its
block k may start at slot floor(k / w) and must be placed before slot ceil((k + 1) / w);
in each slot the released block with the earliest deadline goes next. Weights are exact
integer ratios, so releases and deadlines are those of the weights that were asked for,
however long the table. The schedule is one pass over the blocks on the driver, which
holds one entry per source and hands the schedule on in pieces of bounded size; documents
find their slot by a join on source and block.

At every slot each source that still has blocks has been given its weight times the slot,
less than one block off. A source that runs out leaves its later slots to others that are
released, or empty; the others keep their proportions. Every document is placed once:
nothing is repeated or left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from heapq import heapify, heappop, heappush
from math import lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from habitscope.llm.rows import as_scan, file_rows, ranked_within
from habitscope.sources.scratch import new_scratch_path, settled

#: Numbers of an int column. Sources beyond share the last number, but not their turns.
MAX_QUEUES = 2 ** 31 - 1
#: Blocks of the schedule that the driver holds at a time.
PIECE = 1 << 18
#: Bytes of text of an output file, limits between files that are broadcast, and the bits of a
#: hash by which a row finds those it may lie between.
FILE_BYTES, BROADCAST_LIMITS, RANGE_BITS = 1 << 25, 1 << 18, 10
SEED = 5


def whole_slots(weights: list[float], period: int) -> list[int]:
    """Slots of a period for each weight: one at least, largest remainders first."""
    total = sum(weights)
    spare = period - len(weights)
    exact = [w / total * spare for w in weights]
    slots = [1 + int(x) for x in exact]
    by_rest = sorted(range(len(weights)), key=lambda i: (int(exact[i]) - exact[i], i))
    for i in by_rest[: period - sum(slots)]:
        slots[i] += 1
    return slots


def exact_shares(weights: list[float]) -> list[int]:
    """Whole numbers in exactly the proportions of positive ``weights``, which count as they
    are written: 0.9 is nine tenths."""
    ratios = [Fraction(str(w)) for w in weights]
    scale = lcm(*[r.denominator for r in ratios])
    return [r.numerator * (scale // r.denominator) for r in ratios]


def turns(blocks: list[int], shares: list[int]) -> Iterator[tuple[int, int, int]]:
    """(queue, block, slot) of every block of every queue, slot by slot: of the released
    blocks the one with the earliest deadline, then the first queue. A slot in which none
    is released stays empty."""
    total, slot = sum(shares), 0
    ready = [(-(-total // s), q, 0) for q, s in enumerate(shares)]
    later: list[tuple[int, int, int]] = []
    heapify(ready)
    while ready or later:
        if not ready:
            slot = max(slot, later[0][0])
        while later and later[0][0] <= slot:
            _, q, k = heappop(later)
            heappush(ready, (-(-(k + 1) * total // shares[q]), q, k))
        _, q, k = heappop(ready)
        yield q, k, slot
        slot += 1
        if k + 1 < blocks[q]:
            heappush(later, ((k + 1) * total // shares[q], q, k + 1))


def schedule(spark: SparkSession, sizes: list[int], weights: list[float | None], block: int,
             period: int | None = None) -> DataFrame:
    """``number`` (of the queue), ``block``, ``slot`` and ``before`` (documents of all queues in
    earlier slots), for queues of so many documents. Those without a weight come after all
    others, in proportion to the roots of their sizes."""
    path = new_scratch_path(spark, "mix-schedule")
    names = ("number", "block", "slot", "before")
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
    piece: list[tuple[int, int, int, int]] = []

    def write() -> None:
        columns = [pa.array(c, t) for c, t in zip(zip(*piece), types)]
        spark.createDataFrame(pa.table(columns, list(names))).write.mode("append").parquet(path)
        piece.clear()

    before = start = 0
    weighed = [q for q, w in enumerate(weights) if w is not None]
    for part in (weighed, [q for q, w in enumerate(weights) if w is None]):
        if not part:
            continue
        wanted = [sizes[q] ** 0.5 if weights[q] is None else weights[q] for q in part]
        shares = exact_shares(wanted) if period is None else whole_slots([float(w) for w in wanted], period)
        end = start
        for i, k, slot in turns([-(-sizes[q] // block) for q in part], shares):
            q = part[i]
            piece.append((q, k, start + slot, before))
            before += min(block, sizes[q] - k * block)
            end = start + slot + 1
            if len(piece) == PIECE:
                write()
        start = end
    if piece:
        write()
    return spark.read.parquet(path)


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def plan(docs: DataFrame, **options) -> DataFrame:
    """``__file`` (a hash of the path), ``__row``, ``queue``, ``block``, ``slot``, ``position``
    for each row of ``docs`` (columns ``doc_id``, ``source``, ``text``).

    Without ``weights`` a source of n documents weighs n ** ``temper``. Sources that
    ``weights`` does not name, or gives nothing, come after all others. With a ``period``
    the weights are first rounded to whole slots of it, one at least; otherwise they are
    exact. Every source has a queue of its own, numbered by size; a null source is a source.
    ``position`` runs from 0 without gaps. Repeated rows are rows like others.
    """
    return _placed(docs, **options).select("__file", "__row", "queue", "block", "slot", "position")


def _placed(docs: DataFrame, weights: dict[str | None, float] | None = None, temper: float = 0.5,
            block: int = 32, seed: int = SEED, period: int | None = None) -> DataFrame:
    """``plan``, with each row's ``source``, ``hash``, ``doc_id`` and ``bytes`` of text."""
    spark = docs.sparkSession
    keys = file_rows(docs).select(
        "source", _hash(seed).alias("hash"), "doc_id", F.xxhash64("__path").alias("__file"), "__row",
        F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"))
    keys = settled(keys, "mix-keys")
    rank = keys.groupBy("source").count().orderBy(F.desc("count"), "source").toArrow()
    if not len(rank):
        return keys.select("*", *[F.lit(0).cast(t).alias(c) for c, t in (
            ("queue", "int"), ("block", "long"), ("slot", "long"), ("position", "long"))])
    numbers = pa.table({"name": rank["source"], "number": pa.array(range(len(rank)), pa.int32())})
    number_of = settled(spark.createDataFrame(numbers), "mix-queues")
    queued = keys.join(number_of, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    sizes = rank["count"].to_pylist()
    wanted: list[float | None] = [float(n) ** temper for n in sizes]
    if weights is not None:
        wanted = [w if (w := weights.get(s.as_py(), 0)) > 0 else None for s in rank["source"]]
    ranked = ranked_within(queued, "number", F.col("hash"), F.col("doc_id"), F.col("__file"), F.col("__row"))
    return (
        ranked.withColumn("block", F.expr(f"__rank div {block}"))
        .join(schedule(spark, sizes, wanted, block, period), ["number", "block"])
        .select("source", "hash", "doc_id", "bytes", "__file", "__row", F.least("number", F.lit(MAX_QUEUES - 1)).alias("queue"), "block", "slot",
                (F.col("before") + F.col("__rank") % block).alias("position")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``queue``, ``block``, ``slot`` and ``position``; see ``plan``. Columns
    of these names are replaced."""
    mine = ("queue", "block", "slot", "position")
    docs = as_scan(docs)
    where = settled(plan(docs, **options), "mix-plan")
    rows = file_rows(docs.drop(*mine)).withColumn("__file", F.xxhash64("__path")).drop("__path")
    return rows.join(where, ["__file", "__row"]).drop("__file", "__row")


def in_mixed_order(docs: DataFrame, seed: int = SEED, **options) -> DataFrame:
    """The rows of ``docs``, unchanged, in the order of the mix: sorted over the output
    files and inside each.

    Positions of a source rise with the hash, so a row finds its file by the file's limits in
    its source. Texts move once, to that file, where they meet their positions.
    """
    docs = as_scan(docs)
    where = settled(_placed(docs, seed=seed, **options).select(
        "source", "hash", "doc_id", "bytes", "__file", "__row", "position"), "mix-order")
    rows, size = where.agg(F.count("*"), F.sum("bytes")).first()
    if not rows:
        return docs
    files = min(rows, -(-size // FILE_BYTES) or 1)
    where = where.withColumn("__to", F.floor(F.col("position") / -(-rows // files)).cast("int"))

    def own(hash_: str) -> Column:
        return F.struct(F.col(hash_).alias("hash"), "doc_id", "__file", "__row")

    def range_(hash_: str) -> Column:
        return F.shiftrightunsigned(hash_, 64 - RANGE_BITS)

    limits = settled(
        where.groupBy(F.col("source").alias("__source"), range_("hash").alias("__range"), "__to")
        .agg(F.min(own("hash")).alias("from")).groupBy("__source", "__range")
        .agg(F.collect_list(F.struct("from", "__to")).alias("__limits")), "mix-limits")
    if (limits.agg(F.sum(F.size("__limits"))).first()[0] or 0) <= BROADCAST_LIMITS:
        limits = F.broadcast(limits)
    passed = F.filter("__limits", lambda limit: limit["from"] <= own("__hash"))
    texts = (
        file_rows(docs).withColumns({"__file": F.xxhash64("__path"), "__hash": _hash(seed)})
        .join(limits, F.col("source").eqNullSafe(F.col("__source")) & (range_("__hash") == F.col("__range")))
        .select(*docs.columns, "__file", "__row", F.array_max(F.transform(passed, lambda limit: limit["__to"])).alias("__to"),
                F.lit(None).cast("long").alias("__position"))
    )
    positions = where.select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema], "__file", "__row", "__to",
        F.col("position").alias("__position"))
    return (
        texts.withColumn("__text", F.lit(True)).unionByName(positions.withColumn("__text", F.lit(False)))
        .repartitionById(files, "__to")
        .withColumn("__position", F.max("__position").over(Window.partitionBy("__to", "__file", "__row")))
        .where("__text").sortWithinPartitions("__position").select(*docs.columns)
    )
