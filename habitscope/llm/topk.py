"""Exact top-k inner products by sorted lists read in order, without random access.

Each dimension is a list of candidates in the order of their component: from the top for
a query's positive weights, from the bottom for negative ones. All lists are read to a
common depth. What a list has shown of a candidate is known; of the rest its last value
shown is the best and the list's other end the worst that can come. So every candidate has
an upper and a lower bound. The k-th best lower bound is a floor: a candidate whose upper
bound is below it cannot qualify. Lists are read deeper until no more candidates than
asked for can qualify or the lists end, and the final scores of those left are resolved.

Candidates are dealt into blocks with lists of their own, queries into batches; each block
gives its k best for each query and the k best of those are the answer. With the depth
fixed, the bounds of all queries and candidates of a block are matrix products.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEPTHS = (0.5, 0.8, 0.95, 1.0)
BLOCK, BATCH = 4096, 4096
EXACT_FLOAT32, EXACT_FLOAT64 = 1 << 24, 1 << 53


def whole_vectors(table: DataFrame, vector: str, scale: int) -> Column:
    """floor(scale * x) of each component; null for a vector that is null or holds a null or
    non-finite component."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(parts, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    most = F.lit(float(1 << 62))
    return F.when(fine, F.transform(
        parts, lambda x: F.floor(F.greatest(F.least(x * scale, most), -most)).cast("long")))


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def block_top(queries: np.ndarray, own: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int,
              depths: tuple[float, ...] = DEPTHS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and scores of its ``k`` best candidates (ties to the smaller
    id, the query's ``own`` id left out). All arithmetic is exact: sums are bounded first."""
    n = len(candidates)
    largest = [int(np.abs(m).max(initial=0)) for m in (queries, candidates)]
    bound = largest[0] * largest[1] * max(queries.shape[1], 1)
    kind = np.float32 if bound < EXACT_FLOAT32 else np.float64 if bound < EXACT_FLOAT64 else object
    q, x = queries.astype(kind), candidates.astype(kind)
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    rising = np.sort(candidates, axis=0)
    worst_low, worst_high = rising[0].astype(kind), rising[-1].astype(kind)
    foreign = ids[None, :] != own[:, None]
    left = np.ones((len(q), n), bool) & foreign
    for depth in depths:
        if depth >= 1 or k >= n:
            break
        shown = max(1, int(n * depth))
        last_high, last_low = rising[n - shown].astype(kind), rising[shown - 1].astype(kind)
        seen_high, seen_low = x >= last_high, x <= last_low
        upper = plus @ np.where(seen_high, x, last_high).T + minus @ np.where(seen_low, x, last_low).T
        lower = plus @ np.where(seen_high, x, worst_low).T + minus @ np.where(seen_low, x, worst_high).T
        lower[~foreign] = -np.inf if kind is not object else -bound - 1
        floor = np.partition(lower, n - k, axis=1)[:, n - k] if kind is not object \
            else np.sort(lower, axis=1)[:, n - k]
        left &= upper >= floor[:, None]
        if left.sum(axis=1).max(initial=0) <= k:
            break
    out = []
    for i in range(len(q)):
        at = np.flatnonzero(left[i])
        score = (x[at] @ q[i]).astype(np.int64) if kind is not object else x[at] @ q[i]
        if len(at) > k:  # ties of the k-th stay in until ids decide
            edge = np.partition(score, len(score) - k)[len(score) - k] if kind is not object else sorted(score)[-k]
            at, score = at[score >= edge], score[score >= edge]
        order = np.lexsort((ids[at], -score))[:k]
        out.append((ids[at][order], score[order]))
    return out


def as_longs(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers; one beyond their range becomes the nearest."""
    if scores.dtype != object:
        return scores.astype(np.int64)
    least, most = -(1 << 63), (1 << 63) - 1
    return np.array([min(max(int(s), least), most) for s in scores], np.int64)


def top_k(table: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector: str = "embedding",
          scale: int = 64, block: int = BLOCK, batch: int = BATCH) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` for the rows of ``table`` that
    ``is_query`` holds for, against every row with another id.

    Vectors that are null or hold a null or non-finite component, and rows without id, take
    no part. Rows that repeat an id are candidates each; a query that repeats is one query
    for each different vector it has. A score beyond the range of a long is the nearest
    long, and components beyond 2^62 are cut there. Fewer than ``k`` candidates give all. Blocks and batches have a
    fixed expected size, so their number follows the table and a task's memory does not.
    """
    rows = table.select(
        F.col(id_column).cast("long").alias("id"), whole_vectors(table, vector, scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks")).where("id IS NOT NULL AND v IS NOT NULL")
    asked, every = (max(1, -(-c // s)) for c, s in zip(
        rows.agg(F.count_if("asks"), F.count("*")).first(), (batch, block)))

    def spread(count: int, salt: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "id", "v"), F.lit(count)).cast("int")

    questions = rows.where("asks").select("id", "v").distinct().withColumn("batch", spread(asked, 1)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(every - 1))))
    candidates = rows.select("id", "v", F.monotonically_increasing_id().alias("__n")).select(
        "id", "v", F.pmod(F.xxhash64("id", "v", "__n"), F.lit(every)).cast("int").alias("block")).withColumn(
        "batch", F.explode(F.sequence(F.lit(0), F.lit(asked - 1))))

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score", "q")})
        left = left.sort_values("id", kind="stable")
        width = max(left.v.map(len).max(), right.v.map(len).max())
        x, ids, parts = matrix(right.v, width), right.id.to_numpy(np.int64), []
        for start in range(0, len(left), 512):
            some = left.iloc[start:start + 512]
            own = some.id.to_numpy(np.int64)
            found = block_top(matrix(some.v, width), own, x, ids, k)
            sizes = [len(i) for i, _ in found]
            parts.append(pd.DataFrame({
                "query_id": np.repeat(own, sizes), "vec_id": np.concatenate([i for i, _ in found]),
                "score": np.concatenate([as_longs(s) for _, s in found]),
                "q": np.repeat(some.q.to_numpy(np.int64), sizes)}))
        return pd.concat(parts)

    questions = questions.withColumn("q", F.xxhash64("v"))
    found = questions.groupBy("batch", "block").cogroup(candidates.groupBy("batch", "block")).applyInPandas(
        best, "query_id long, vec_id long, score long, q long")
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
