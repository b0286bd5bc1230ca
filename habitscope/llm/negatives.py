"""Hard negatives, found through summaries of vector segments.

A vector is cut into segments; of each its mean and deviation are stored. The inner product
of two segments of L components is L times the product of their means, plus or minus at
most L times the product of their deviations. Sums over the segments bound a score from both
sides. Coarse segments are looked at first; what they cannot rule out is bounded by finer
ones, and what these cannot rule out is scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habitscope.llm.blocks import dealt, longs, matrix, placed
from habitscope.llm.topk import as_longs, whole_vectors
from habitscope.sources.scratch import settled

#: Segments of a vector, coarse to fine.
LEVELS = (2, 8, 32)
EXACT = 1 << 53
CHUNK = 128


def summaries(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Means and deviations of each row's segments, and a segment's length. The last segment
    is filled up with zeros, which changes no inner product."""
    size = max(1, -(-x.shape[1] // segments))
    wide = np.zeros((len(x), segments * size))
    wide[:, : x.shape[1]] = x
    cut = wide.reshape(len(x), segments, size)
    return cut.mean(axis=2), cut.std(axis=2), size


def stored(table: DataFrame, label: str, id_column: str, vector: str, scale: int, asks: Column) -> DataFrame:
    """The written summary table: ``id``, ``label``, ``v`` (whole components), ``place``,
    ``asks``, and for each level ``mean_s`` and ``deviation_s`` of its s segments."""
    rows = placed(
        table.withColumn("__asks", F.coalesce(asks, F.lit(False))), F.col(id_column).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"), whole_vectors(table, vector, scale).alias("v"), F.col("__asks").alias("asks"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = settled(rows, "whole-vectors")
    width = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    names = [f"{kind}_{s}" for s in LEVELS for kind in ("mean", "deviation")]

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x = matrix(pa.chunked_array([part.column(part.schema.get_field_index("v"))]), width)
            columns = []
            for s in LEVELS:
                columns += [pa.FixedSizeListArray.from_arrays(pa.array(c.ravel()), s).cast(pa.list_(pa.float64()))
                            for c in summaries(x, s)[:2]]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return settled(rows.mapInArrow(summarise, fields + "".join(f", {n} array<double>" for n in names)), "summaries")


class Side:
    """Rows of one side of a pair of batch and block."""

    def __init__(self, table: pa.Table, width: int, rows: np.ndarray | None = None):
        self.ids, self.labels = longs(table, "id"), longs(table, "label")
        self.v = matrix(table.column("v"), width, np.int64)
        self.size = {s: max(1, -(-width // s)) for s in LEVELS}
        self.levels = {s: tuple(matrix(table.column(f"{k}_{s}"), s) for k in ("mean", "deviation")) for s in LEVELS}
        self.norm = np.sqrt((self.v.astype(float) ** 2).sum(axis=1))

    def largest(self) -> int:
        return max(abs(int(self.v.max(initial=0))), abs(int(self.v.min(initial=0))))


def bounds(a: Side, some: np.ndarray, b: Side, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of the rows ``some`` of ``a`` with all of ``b``."""
    size = a.size[level]
    (am, ad), (bm, bd) = a.levels[level], b.levels[level]
    middle = size * (am[some] @ bm.T)
    slack = size * (ad[some] @ bd.T) + 1e-9 * np.outer(a.norm[some], b.norm) + 1e-6  # rounding
    return middle - slack, middle + slack


def nth_largest(x: np.ndarray, n: int) -> np.ndarray:
    """The n-th largest of each row; minus infinity where there are fewer."""
    if x.shape[1] < n:
        return np.full(len(x), -np.inf)
    return np.partition(x, x.shape[1] - n, axis=1)[:, x.shape[1] - n]


def survivors_of_best(a: Side, some: np.ndarray, b: Side, allowed: np.ndarray, k: int) -> np.ndarray:
    """Which of ``allowed`` may be among the ``k`` best of each row of ``some``."""
    left = allowed
    for level in LEVELS:
        low, high = bounds(a, some, b, level)
        left = left & (high >= nth_largest(np.where(left, low, -np.inf), k)[:, None])
    return left


def survivors_of_bands(a: Side, some: np.ndarray, b: Side, allowed: np.ndarray, least: np.ndarray, most: np.ndarray,
                       k: int) -> np.ndarray:
    """Which of ``allowed`` may be among the ``k`` best of a row of ``some`` inside one of its
    bands, ``least`` to ``most`` (rows x bands; a band from inf to -inf is none)."""
    left = [allowed] * least.shape[1]
    for level in LEVELS:
        low, high = bounds(a, some, b, level)
        for j in range(least.shape[1]):
            near, far = least[:, j, None], most[:, j, None]
            able = left[j] & (high >= near) & (low <= far)
            sure = able & (low >= near) & (high <= far)
            left[j] = able & (high >= nth_largest(np.where(sure, low, -np.inf), k)[:, None])
    return np.logical_or.reduce(left) if left else np.zeros_like(allowed)


def exact_scores(query: np.ndarray, rows: np.ndarray, exact_float: bool) -> np.ndarray:
    if exact_float:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return as_longs(rows.astype(object) @ query.astype(object))


def hard_negatives(table: DataFrame, asks: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
                   label: str = "label", id_column: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``,
    ``negative_score`` and ``positive_rank``.

    Components become floor(scale * x); a score is the integer inner product with the anchor.
    An anchor's positives are the ``positives`` best other rows of its label; for each, the
    negatives are the ``negatives`` best rows of another label that score from ``least`` to
    ``most`` percent of the positive. Ties go to the smaller id; fewer give all. A positive
    below zero has no negatives, one of zero those of zero.

    Rows with a null label, id or vector, or a null or non-finite component, take no part.
    Rows that repeat an id are rows each, but never their own anchor's; an anchor that
    repeats is one anchor for each different label and vector. Scores beyond a long count as
    the nearest long. An empty table gives no rows; other columns are not looked at.
    """
    rows = stored(table, label, id_column, vector, scale, asks)
    n_rows, n_asked, width = rows.agg(
        F.count("*"), F.count_if("asks"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    levels = [f"{kind}_{s}" for s in LEVELS for kind in ("mean", "deviation")]
    facts = ["id", "label", "v", "place", *levels]
    anchors = rows.where("asks").select(*facts, F.xxhash64("label", "v").alias("mark")).dropDuplicates(["id", "mark"])

    def together(left: pa.Table, right: pa.Table) -> tuple[Side, Side, bool]:
        a, b = Side(left, width), Side(right, width)
        return a, b, a.largest() * b.largest() * max(width, 1) < EXACT

    def frame(names: tuple[str, ...], parts: list[tuple]) -> pa.Table:
        return pa.table({n: np.concatenate([p[i] for p in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
                         for i, n in enumerate(names)})

    def best_of_label(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b, plain = together(left, right)
        marks, parts = longs(left, "mark"), []
        for start in range(0, len(a.ids) if len(b.ids) else 0, CHUNK):
            some = np.arange(start, min(start + CHUNK, len(a.ids)))
            allowed = (a.labels[some, None] == b.labels) & (a.ids[some, None] != b.ids)
            left_over = survivors_of_best(a, some, b, allowed, positives)
            for i, row in enumerate(some.tolist()):
                at = np.flatnonzero(left_over[i])
                score = exact_scores(a.v[row], b.v[at], plain)
                order = np.lexsort((b.ids[at], -score.astype(object) if not plain else -score))[:positives]
                parts.append((np.full(len(order), a.ids[row]), np.full(len(order), marks[row]), b.ids[at][order], score[order]))
        return frame(("id", "mark", "positive_id", "positive_score"), parts)

    def pairs(questions: DataFrame) -> tuple:
        first, second = dealt(rows.select(*facts), questions, width, n_rows, n_asked)
        return first.groupBy("batch", "block"), second.groupBy("batch", "block")

    first, second = pairs(anchors)
    near = first.cogroup(second).applyInArrow(best_of_label, "id long, mark long, positive_id long, positive_score long")
    order = Window.partitionBy("id", "mark").orderBy(F.desc("positive_score"), "positive_id")
    near = settled(near.withColumn("positive_rank", F.row_number().over(order)).where(F.col("positive_rank") <= positives),
                   "positives")
    bands = near.groupBy("id", "mark").agg(F.sort_array(F.collect_list(F.struct(
        "positive_rank", "positive_id", "positive_score"))).alias("p")).select(
        "id", "mark", "p.positive_id", "p.positive_score")
    asking = anchors.join(bands, ["id", "mark"])

    def best_of_bands(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b, plain = together(left, right)
        marks, parts = longs(left, "mark"), []
        goals = [list(zip(*p)) for p in zip(left.column("positive_id").to_pylist(), left.column("positive_score").to_pylist())]
        for start in range(0, len(a.ids) if len(b.ids) else 0, CHUNK):
            some = np.arange(start, min(start + CHUNK, len(a.ids)))
            near_, far = np.full((len(some), positives), np.inf), np.full((len(some), positives), -np.inf)
            for i, row in enumerate(some.tolist()):
                for j, (_, score) in enumerate(goals[row]):
                    if score >= 0:
                        near_[i, j], far[i, j] = -(-least * score // 100), most * score // 100
            allowed = a.labels[some, None] != b.labels
            left_over = survivors_of_bands(a, some, b, allowed, near_, far, negatives)
            for i, row in enumerate(some.tolist()):
                at = np.flatnonzero(left_over[i])
                score = exact_scores(a.v[row], b.v[at], plain)
                order = np.lexsort((b.ids[at], -score.astype(object) if not plain else -score))
                at, score = at[order], score[order]
                for j, (positive, goal) in enumerate(goals[row]):
                    fits = np.flatnonzero((score >= -(-least * goal // 100)) & (score <= most * goal // 100))[:negatives]
                    if len(fits):
                        parts.append((*(np.full(len(fits), c) for c in (a.ids[row], marks[row], j + 1, positive, goal)),
                                      b.ids[at[fits]], score[fits]))
        return frame(("id", "mark", "positive_rank", "positive_id", "positive_score", "negative_id", "negative_score"), parts)

    first, second = pairs(asking)
    found = first.cogroup(second).applyInArrow(best_of_bands, (
        "id long, mark long, positive_rank long, positive_id long, positive_score long, negative_id long, negative_score long"))
    order = Window.partitionBy("id", "mark", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score",
        F.col("positive_rank").cast("int").alias("positive_rank"))
