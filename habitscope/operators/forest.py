"""Bagged regression trees on binned features, all trees grown side by side.

How often a row counts in a tree is a Poisson(1) number drawn from an MD5 of its key, so the
trees do not depend on how rows are dealt out, and a recomputed task draws the same again.
A level of all trees is a few scans: tasks add up weights and labels by (tree, node, feature,
bin), as many cells at once as ``CELLS`` allows; these sums meet by node in other tasks, and
the driver gets one line a node, its best split. Labels are whole numbers of a unit fixed by
their range and number, so sums are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from habitscope.operators.boost import (
    BoostedModel, Tree, add_up, best_of_slots, by_slot, in_tasks, quantile_edges, sums_batch, to_bins, vectors_of)
from habitscope.sources.scratch import settled

#: A draw of 16 bits that reaches k of these gives a row the weight k: Poisson(1), at most 7.
CUTS = [int(65536 * math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1))) for k in range(7)]
DRAWS = 8  # of 16 bits in one MD5
#: Sums held at once, rows of a task, tasks whose sums a single task brings together, rows added up at once.
CELLS, TASK_ROWS, FEW_TASKS, SLICE_ROWS = 1 << 21, 250_000, 1, 8192


def draws(key: Column, trees: int, seed: int) -> Column:
    """16 bits a tree, as bytes: MD5 of ``seed:block:key``, eight trees to a block."""
    blocks = range(-(-trees // DRAWS))
    return F.unhex(F.concat(*[F.md5(F.concat(F.lit(f"{seed}:{b}:"), key)) for b in blocks]))


def key_text(keys: Sequence[str], features: str, label: str) -> Column:
    """The key columns joined by colons (null: empty); without any, the row's own contents."""
    if keys:
        return F.concat_ws(":", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    parts = F.concat_ws(",", vector_to_array(features).cast("array<string>"), F.col(label).cast("string"))
    return F.md5(parts)


def best_splits(sums: np.ndarray, min_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node the gain, feature and bin of the split that lowers squared error most, the
    first among equals; gain 0 if none. ``sums`` is [node, feature, bin, (label, weight)]."""
    g, n = np.cumsum(sums[..., 0], 2).astype(float), np.cumsum(sums[..., 1], 2)
    all_g, all_n = g[:, :, -1:], n[:, :, -1:]
    whole = all_g**2 / np.maximum(all_n, 1)
    gain = g**2 / np.maximum(n, 1) + (all_g - g) ** 2 / np.maximum(all_n - n, 1) - whole
    gain[(n < min_rows) | (all_n - n < min_rows) | (gain <= 1e-12 * whole)] = 0
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(1)
    return flat[np.arange(len(at)), at], at // gain.shape[2], at % gain.shape[2]


def _best(table: DataFrame, width: int, bins: int, trees: dict[int, Tree], nodes: list[tuple[int, int]],
          min_rows: int, tasks: int) -> list[tuple]:
    """The best splits of the given (tree, node) pairs."""
    places: dict[int, np.ndarray] = {}
    for slot, (t, node) in enumerate(nodes):
        places.setdefault(t, np.full(len(trees[t].feature), -1, np.int64))[node] = slot

    def add(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        total = np.zeros((2, width, len(nodes) * bins), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                x, weights = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint8).reshape(part.num_rows, -1)
                              for i in (0, 1))
                label = part.column(2).to_numpy()
                for t, place in places.items():
                    own = np.flatnonzero(weights[:, t])
                    slot = place[trees[t].leaf_of(x[own])]
                    own, slot = own[slot >= 0], slot[slot >= 0]
                    if not len(own):
                        continue
                    w = weights[own, t].astype(np.int64)
                    add_up(total, slot, x[own], bins, (label[own] * w, w))
        return sums_batch(by_slot(total, bins))

    return best_of_slots(table, add, lambda sums: best_splits(sums, min_rows), len(nodes), width, bins, tasks, FEW_TASKS)


class _Growing:
    """A tree while nodes are added; lists in place of arrays."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right = [-1], [0], [-1], [-1]
        self.value, self.rows, self.gain = [0.0], [0], [0.0]

    def split(self, node: int, feature: int, at: int, gain: float) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.bin[node], self.gain[node] = feature, at, gain
        self.left[node], self.right[node] = left, left + 1
        for name, empty in (("feature", -1), ("bin", 0), ("left", -1), ("right", -1), ("value", 0.0), ("rows", 0), ("gain", 0.0)):
            getattr(self, name).extend([empty, empty])
        return left, left + 1

    def tree(self) -> Tree:
        return Tree(*(np.array(getattr(self, f)) for f in ("feature", "bin", "left", "right", "value", "rows", "gain")))


@dataclass(frozen=True)
class BaggedForest:
    """Mean of ``trees`` trees, each on rows weighted by Poisson draws from ``keys``.

    ``fit`` takes a table of a vector, a label and the key columns. Every split looks at all
    features. Rows of equal keys (without keys: of equal contents) have equal weights. Rows
    with a null vector, or a label that is null or not finite, are left out. A tree that gets
    no row, and a table without rows, predict the middle of the labels' range (0 without any).
    ``edges`` gives the bins instead of the features' quantiles.
    """

    features: str
    label: str
    keys: tuple[str, ...] = ()
    trees: int = 100
    depth: int = 10
    bins: int = 32
    min_rows: int = 1
    seed: int = 42
    edges: list[np.ndarray] | None = None

    def fit(self, df: DataFrame) -> BoostedModel:
        label = F.col(self.label).cast("double")
        rows = df.where(F.col(self.features).isNotNull() & (F.abs(label) < float("inf"))).select(
            F.col(self.features).alias("features"), label.alias("label"),
            draws(key_text(self.keys, self.features, self.label), self.trees, self.seed).alias("draws"))
        edges = self.edges if self.edges is not None else quantile_edges(rows, "features", self.bins)
        n, low, high = rows.agg(F.count("*"), F.min("label"), F.max("label")).first()
        if not n:
            return BoostedModel(0.0, [], edges, self.features)
        base = low / 2 + high / 2
        span = max(high - base, base - low, 2.0**-60)
        unit = 2.0 ** (min(36, 61 - math.ceil(math.log2(n))) - math.ceil(math.log2(span)))
        count, width, bins = self.trees, len(edges), max(map(len, edges), default=0) + 1

        def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                x = vectors_of(part.column(0), width)
                drawn = np.frombuffer(b"".join(part.column(2).to_pylist()), ">u2").reshape(part.num_rows, -1)[:, :count]
                weights = np.searchsorted(CUTS, drawn, "right").astype(np.uint8)
                whole = np.rint((part.column(1).to_numpy() - base) * unit).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v.tobytes() for v in to_bins(x, edges)], pa.binary()),
                     pa.array([v.tobytes() for v in weights], pa.binary()), pa.array(whole)], ["bins", "weights", "label"])

        spread = in_tasks(rows.select(vector_to_array("features").alias("x"), "label", "draws"), -(-n // TASK_ROWS))
        table = settled(spread.mapInArrow(bin_rows, "bins binary, weights binary, label long"), "bagged").persist()
        try:
            found = self._grow(table, width, bins, unit)
        finally:
            table.unpersist()
        return BoostedModel(base, found, edges, self.features)

    def _grow(self, table: DataFrame, width: int, bins: int, unit: float) -> list[Tree]:
        tasks, min_rows = table.rdd.getNumPartitions(), max(self.min_rows, 1)
        growing = [_Growing() for _ in range(self.trees)]
        scale = 1 / (unit * self.trees)  # a tree's share of the mean
        at_once = max(1, CELLS // (max(width, 1) * bins))
        level = [(t, 0) for t in range(self.trees)] if width else []
        for depth in range(self.depth):
            below = []
            for start in range(0, len(level), at_once):
                nodes = level[start : start + at_once]
                now = {t: growing[t].tree() for t in {t for t, _ in nodes}}
                found = _best(table, width, bins, now, nodes, min_rows, tasks)
                for (t, node), (gain, feature, at, gl, nl, g, n) in zip(nodes, found):
                    tree = growing[t]
                    if not depth:
                        tree.rows[0], tree.value[0] = n, g * scale / max(n, 1)
                    if not gain:
                        continue
                    for child, (g, n) in zip(tree.split(node, feature, at, gain / unit**2), ((gl, nl), (g - gl, n - nl))):
                        tree.rows[child], tree.value[child] = n, g * scale / n
                        if n >= 2 * min_rows:
                            below.append((t, child))
            level = below
            if not level:
                break
        return [g.tree() for g in growing]
