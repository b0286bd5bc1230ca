"""Approximate nearest neighbours with one-bit codes of randomly rotated vectors.

A vector of length one is turned by a random rotation and only the signs are kept: one bit
a dimension, and one correction scalar, the inner product of the turned vector and its
code. A query's inner product with the code, divided by that scalar, estimates its inner
product with the vector without bias, and the error's deviation is known from the scalar
alone. In each block the best estimates are resolved first; then every candidate whose
estimate plus error bound reaches the k-th best of these is resolved too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habitscope.llm.blocks import dealt, finite, longs, matrix, placed
from habitscope.sources.scratch import settled

#: Deviations of the estimate within which a candidate is still resolved.
SPREAD = 3.0
SEED = 20240523


@lru_cache(maxsize=2)
def rotation(width: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def code_width(width: int) -> int:
    """Bits of a code: the dimensions, filled up to whole bytes."""
    return max(8, -(-width // 8) * 8)


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings it near one: the same directions, without
    overflow in the squares."""
    most = np.abs(x).max(axis=1, initial=0)
    return np.ldexp(x, -np.frexp(most)[1][:, None])


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def turned(x: np.ndarray) -> np.ndarray:
    """Rows of length one, filled up with zeros and rotated."""
    bits = code_width(x.shape[1])
    unit = np.zeros((len(x), bits))
    unit[:, : x.shape[1]] = x / np.maximum(lengths(x), 1e-300)[:, None]
    return unit @ rotation(bits).T


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the turned rows, and each row's correction scalar."""
    t = turned(x)
    return np.packbits(t >= 0, axis=1), np.abs(t).sum(axis=1) / np.sqrt(t.shape[1])


def index(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", *keep: Column) -> DataFrame:
    """The written index: ``id``, ``v``, ``place``, ``width``, ``code`` and ``factor`` of every
    row that has an id and a vector that is finite and not zero, and ``keep``."""
    rows = placed(table, F.col(id_column).cast("long").alias("id"), finite(vector).alias("v"), *keep).where(
        F.col("id").isNotNull() & F.exists("v", lambda x: x != 0))

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            sizes = part.column(part.schema.get_field_index("v")).value_lengths().to_numpy()
            code, factor = [b""] * len(sizes), np.zeros(len(sizes))
            for width in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == width)
                x = matrix(pa.chunked_array([part.column(part.schema.get_field_index("v")).take(pa.array(own))]), width)
                packed, factor[own] = encode(scaled(x))
                for i, c in zip(own.tolist(), packed):
                    code[i] = c.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(code, pa.binary()), pa.array(factor)], [*part.schema.names, "code", "factor"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return settled(rows.mapInArrow(codes, f"{fields}, code binary, factor double"), "code-index")


def block_nearest(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, code: np.ndarray, factor: np.ndarray,
                  k: int, spread: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and cosines of the ``k`` nearest found, nearest first."""
    bits = code.shape[1] * 8
    signs = (np.unpackbits(code, axis=1).astype(np.float32) * 2 - 1) / np.sqrt(bits)
    estimate = (turned(q).astype(np.float32) @ signs.T) / factor.astype(np.float32)
    error = spread * np.sqrt(np.maximum(1 - factor ** 2, 0) / (factor ** 2 * max(bits - 1, 1))) + 1e-5
    x_length, q_length = lengths(x), lengths(q)
    foreign = ids[None, :] != own[:, None]
    estimate[~foreign] = -np.inf
    for i in range(len(q)):
        def cosines(at: np.ndarray) -> np.ndarray:
            return (x[at] * q[i]).sum(axis=1) / (q_length[i] * x_length[at])

        at = np.flatnonzero(foreign[i])
        if len(at) > k:
            first = np.argpartition(estimate[i], len(ids) - k)[len(ids) - k:]
            floor = cosines(first).min()
            at = np.flatnonzero(estimate[i] + error >= floor)
        score = cosines(at)
        order = np.lexsort((ids[at], -score))[:k]
        yield ids[at][order], score[order]


def search(indexed: DataFrame, asks: Column, k: int = 5, spread: float = SPREAD) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (cosine): the ``k`` nearest found
    for the rows of an ``index`` that ``asks`` holds for, among all rows with another id.

    Ties go to the smaller id. Fewer than ``k`` other rows give all of them. Rows that repeat
    an id are candidates each; a query that repeats is one query for each vector it has.
    Vectors of different widths are filled up with zeros; those of fewer bits than the widest
    are resolved without their code. An empty index gives no rows.
    """
    n_rows, n_asked, width = indexed.agg(
        F.count("*"), F.count_if(F.coalesce(asks, F.lit(False))), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    questions = indexed.where(asks).select("id", "v", "place", F.xxhash64("v").alias("q")).dropDuplicates(["id", "q"])
    questions, rows = dealt(indexed.select("id", "v", "place", "code", "factor"), questions, width, n_rows, n_asked)
    bits = code_width(width)

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, q_ids, marks = longs(right, "id"), longs(left, "id"), longs(left, "q")
        x, q = scaled(matrix(right.column("v"), width)), scaled(matrix(left.column("v"), width))
        code, factor = np.zeros((len(ids), bits // 8), np.uint8), longs(right, "factor").copy()
        for i, c in enumerate(right.column("code").to_pylist()):
            if len(c) == bits // 8:
                code[i] = np.frombuffer(c, np.uint8)
            else:
                factor[i] = 1e-6  # its error bound lets every query resolve it
        parts = []
        for start in range(0, len(q) if len(ids) else 0, 256):
            some = slice(start, start + 256)
            for owner, mark, (found, score) in zip(q_ids[some], marks[some], block_nearest(
                    q[some], q_ids[some], x, ids, code, factor, k, spread)):
                parts.append((np.full(len(found), owner), found, score, np.full(len(found), mark)))
        columns = [np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, kind)
                   for c, kind in enumerate((np.int64, np.int64, np.float64, np.int64))]
        return pa.table(dict(zip(("query_id", "vec_id", "score", "q"), columns)))

    found = questions.groupBy("batch", "block").cogroup(rows.groupBy("batch", "block")).applyInArrow(
        best, "query_id long, vec_id long, score double, q long")
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def nearest(table: DataFrame, asks: Column, k: int = 5, id_column: str = "vec_id", vector: str = "embedding",
            spread: float = SPREAD) -> DataFrame:
    """Index ``table`` and search it for the rows that ``asks`` (on the id column) holds for.
    Vectors that are null, zero or hold a null or non-finite component take no part, nor do
    rows without id. Other columns are not looked at."""
    kept = index(table.withColumn("__asks", F.coalesce(asks, F.lit(False))), id_column, vector, F.col("__asks").alias("asks"))
    return search(kept, F.col("asks"), k, spread)
