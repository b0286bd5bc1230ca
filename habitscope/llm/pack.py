"""Pack documents into fixed-length sequences by cutting-stock column generation.

A document's tokens are cut into whole sequences and one rest. Rests are counted by size
class (``unit`` tokens), which bounds the problem by the sequence length and not by the
data. A linear program over patterns (how many rests of each class share a sequence) is
solved by column generation: a knapsack dynamic program prices new patterns with the
duals until none pays. Pattern counts are rounded down, what stays over is packed first
fit decreasing into further patterns, and the documents, ranked in each class, take the
slots of the patterns by arithmetic.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from habitscope.llm.rows import ranked_within
from habitscope.llm.words import piece_crc, slices, word_tokens
from habitscope.sources.scratch import settled

SEQUENCE = 4096
UNIT = 16
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, order_key long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 2, sequence: int = SEQUENCE,
           keep_ids: bool = False) -> DataFrame:
    """One row per piece of each document of ``docs`` (``doc_id``, ``text``): tokens
    ``start`` .. ``start + length`` of its ids, which end with ``end_id``. A null or empty
    text is that id alone. ``keep_ids`` adds the ids as little-endian 32-bit ``ids``. Pieces
    are ranked by ``order_key`` (long, spread over its range), by default a hash."""
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_tokens(vocabulary)
        for part in slices(batches):
            ids, begins = table.encode(part.column(part.schema.get_field_index("text")))
            total = np.diff(begins) + 1
            n_pieces = (total + sequence - 1) // sequence
            row = np.repeat(np.arange(len(total)), n_pieces)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)) * sequence
            length = np.minimum(total[row] - start, sequence)
            a = begins[row] + start
            b = np.minimum(a + length, begins[row + 1])
            last = start + length == total[row]
            crc = [piece_crc(ids[i:j], end if k else b"") for i, j, k in zip(a.tolist(), b.tolist(), last.tolist())]
            columns = [part.column(part.schema.get_field_index("doc_id")).take(pa.array(row)),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                       pa.array(total[row], pa.int64()),
                       part.column(part.schema.get_field_index("order_key")).take(pa.array(row))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "order_key"]
            if keep_ids:
                columns.append(pa.array([ids[i:j].astype("<u4").tobytes() + (end if k else b"")
                                         for i, j, k in zip(a.tolist(), b.tolist(), last.tolist())], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    key = F.col("order_key").cast("long") if "order_key" in docs.columns else F.xxhash64("doc_id", F.length("text"))
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), key.alias("order_key"))
    return docs.mapInArrow(cut, PIECE_SCHEMA + (", ids binary" if keep_ids else ""))


def best_pattern(value: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the counts of classes 1 .. size with the highest value that fill
    at most ``size``."""
    gain, taken = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    for room in range(1, size + 1):
        options = gain[room - 1::-1][:room] + value[:room]
        k = int(np.argmax(options))
        gain[room], taken[room] = (options[k], k + 1) if options[k] > gain[room - 1] else (gain[room - 1], 0)
    counts, room = np.zeros(size, np.int64), size
    while room > 0:
        if taken[room]:
            counts[taken[room] - 1] += 1
            room -= int(taken[room])
        else:
            room -= 1
    return float(gain[size]), counts


def solve(demand: np.ndarray, max_columns: int = 4000) -> list[tuple[np.ndarray, int]]:
    """Patterns (counts for classes 1 .. n) and how often each is used, covering ``demand``
    exactly. Each pattern fits in n units."""
    size = len(demand)
    classes = np.flatnonzero(demand)
    m = len(classes)
    columns = np.zeros((m, size), np.int64)
    columns[np.arange(m), classes] = size // (classes + 1)
    fit = np.array(columns[np.arange(m), classes], float)
    inverse, level = np.diag(1 / fit), demand[classes] / fit
    for _ in range(max_columns):
        duals = inverse.sum(axis=0)
        value = np.zeros(size)
        value[classes] = np.maximum(duals, 0)
        gain, pattern = best_pattern(value, size)
        if gain <= 1 + 1e-7:
            break
        direction = inverse @ pattern[classes]
        ratios = np.where(direction > 1e-9, level / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(np.argmin(ratios))
        step = ratios[leave]
        level = np.maximum(level - step * direction, 0)
        level[leave] = step
        inverse[leave] /= direction[leave]
        others = np.arange(m) != leave
        inverse[others] -= np.outer(direction[others], inverse[leave])
        columns[leave] = pattern
    left, used = demand.astype(np.int64).copy(), []
    for column, times in zip(columns, np.floor(level + 1e-6).astype(np.int64)):
        held = column > 0
        times = int(min(times, (left[held] // column[held]).min())) if held.any() else 0
        if times > 0:
            used.append((column, times))
            left -= column * times
    while left.any():
        pattern, room = np.zeros(size, np.int64), size
        for k in np.flatnonzero(left)[::-1]:
            n = min(int(left[k]), room // (int(k) + 1))
            pattern[k] += n
            room -= n * (int(k) + 1)
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        used.append((pattern, times))
        left -= pattern * times
    return used


def packed(piece_rows: DataFrame, sequence: int = SEQUENCE, unit: int = UNIT) -> DataFrame:
    """``piece_rows`` with ``sequence_id`` and ``offset`` (from 0 without gaps in each
    sequence). Read twice, so pass a settled table. Equal pieces, null ids and repeated
    rows are told apart by rank alone; an empty table gives no rows."""
    spark, size = piece_rows.sparkSession, sequence // unit
    classed = piece_rows.drop("sequence_id", "offset").withColumn(
        "__class", F.ceil(F.col("length") / unit).cast("int"))
    demand = np.zeros(size, np.int64)
    for r in classed.groupBy("__class").count().collect():  # at most ``size`` rows
        demand[r["__class"] - 1] = r["count"]
    slots, base, filled = {k: [] for k in range(1, size + 1)}, 0, np.zeros(size, np.int64)
    for pattern, times in solve(demand):
        for k in np.flatnonzero(pattern):
            slots[int(k) + 1].append((int(filled[k]), base, int(pattern[k])))
            filled[k] += int(pattern[k]) * times
        base += times
    plan = spark.createDataFrame(
        [(k, v) for k, v in slots.items() if v],
        "slot_class int, uses array<struct<first: bigint, base: bigint, each: bigint>>")
    ranked = ranked_within(
        classed, "__class", F.col("order_key"), F.col("doc_id"), F.col("start"))
    placed = (
        ranked.join(F.broadcast(plan), F.col("__class") == F.col("slot_class"))
        .withColumn("__use", F.element_at(F.filter("uses", lambda u: u["first"] <= F.col("__rank")), -1))
        .withColumn("sequence_id", F.expr("__use.base + (__rank - __use.first) div __use.each"))
    )
    before = Window.partitionBy("sequence_id").orderBy(F.desc("__class"), "__rank") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")) \
        .select(*[c for c in piece_rows.columns if c not in ("sequence_id", "offset", "order_key")],
                "sequence_id", "offset")


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, sequence: int = SEQUENCE, unit: int = UNIT,
         keep_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` with their place in the packed sequences."""
    return packed(settled(pieces(docs, vocabulary, end_id, sequence, keep_ids), "pieces"), sequence, unit)
