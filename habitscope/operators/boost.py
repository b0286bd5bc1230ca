"""Second-order boosting on binned features, grown level by level or best leaf first.

Columns are binned once by quantiles, one byte a feature, and kept in blocks of rows. A level
of a tree is one scan: every task adds up gradients and rows by (node, feature, bin), these
sums meet by node in other tasks, and the driver gets one line a node, its best split. Scores
are moved on once a round. Gradients are whole numbers (2^-20 of the label's unit), so sums
are exact and a tree does not depend on how rows are dealt out.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from habitscope.sources.scratch import settled

ONE = 1 << 20
#: Rows of a task, tasks whose sums a single task brings together, rounds between written scores.
TASK_ROWS, FEW_TASKS, SETTLE_EVERY = 1 << 15, 4, 25
#: Rows of a block; tasks' sums by node, and a node's best split with its left and whole sums.
BLOCK_ROWS = 10_000
SUMS = "slot int, cell array<int>, g array<long>, n array<long>"
BEST = "slot int, gain double, feature int, bin int, gl long, nl long, g long, n long"
BLOCKS = "bins binary, label binary, score binary"


@dataclass
class Tree:
    """Nodes in arrays: split feature (-1: leaf) and bin (``<=`` goes left), children, the
    step a row takes if it ends here, rows, and the gain of the split."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray
    gain: np.ndarray

    def steps(self) -> tuple[int, np.ndarray, np.ndarray]:
        """Depth, each node's feature (a leaf: 0) and, at 2 * node + goes left, the next node
        (a leaf: itself)."""
        own = np.arange(len(self.feature))
        leaf = self.feature < 0
        after = np.stack([np.where(leaf, own, self.right), np.where(leaf, own, self.left)], 1).ravel()
        depth, level = 0, np.zeros(1, np.int64)
        while len(level := level[~leaf[level]]):
            depth, level = depth + 1, np.concatenate([self.left[level], self.right[level]])
        return depth, np.where(leaf, 0, self.feature), after

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        depth, feature, after = self.steps()
        node = np.zeros(len(bins), np.int64)
        flat, start = bins.reshape(-1), np.arange(len(bins)) * bins.shape[1]
        for _ in range(depth):
            node = after[2 * node + (flat[start + feature[node]] <= self.bin[node])]
        return node


@dataclass(frozen=True)
class Settings:
    """``leaves``: None grows every node of a level, a number splits the best leaf first."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.1
    bins: int = 256
    penalty: float = 1.0
    min_rows: int = 1
    leaves: int | None = None


def quantile_edges(df: DataFrame, features: str, bins: int) -> list[np.ndarray]:
    """For each feature at most ``bins`` - 1 values of it that part its rows evenly; a value
    belongs to the bin of the first edge that is not below it."""
    shares = [i / bins for i in range(1, bins)]
    rows = df.select(F.posexplode(vector_to_array(features)).alias("i", "x")).groupBy("i").agg(
        F.percentile_approx("x", shares, 100_000).alias("edges"), F.max("x").alias("most")).collect()
    out = {r["i"]: np.unique([e for e in r["edges"] if e < r["most"]]).astype(float) for r in rows}
    return [out[i] for i in range(len(out))]


def to_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)], 1).astype(np.uint8) \
        if edges else np.zeros((len(x), 0), np.uint8)


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bins, labels and scores of each block."""
    for part in batches:
        for bins, label, score in zip(*(part.column(i) for i in range(3))):
            yield (np.frombuffer(bins.as_py(), np.uint8).reshape(-1, width),
                   np.frombuffer(label.as_py()), np.frombuffer(score.as_py()))


def _block(x: np.ndarray, label: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([v.tobytes()], pa.binary()) for v in (x, label, score)], ["bins", "label", "score"])


def vectors_of(column: pa.Array, width: int) -> np.ndarray:
    """An Arrow column of lists of ``width`` numbers as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(column), width)


def add_up(total: np.ndarray, slot: np.ndarray, x: np.ndarray, bins: int, values: Sequence[np.ndarray | None]) -> None:
    """Add rows to ``total``, [value, feature, slot * bins + bin]; None counts them. A feature at a time,
    so that the cells in use stay in the processor's cache."""
    values = [v if v is None else v.astype(float) for v in values]
    start = slot * bins
    first = int(start.min()) if len(start) else 0
    start -= first
    for f, own in enumerate(np.ascontiguousarray(x.T)):
        cell = start + own
        for row, value in enumerate(values):
            found = np.bincount(cell, value)
            total[row, f, first : first + len(found)] += found.astype(np.int64)


def by_slot(total: np.ndarray, bins: int) -> np.ndarray:
    """What ``add_up`` has summed, as [value, slot, feature * bins + bin]."""
    values, width, _ = total.shape
    return total.reshape(values, width, -1, bins).swapaxes(1, 2).reshape(values, -1, width * bins)


def sums_batch(total: np.ndarray) -> pa.RecordBatch:
    """The cells with rows of ``total``, [(label, rows), slot, cell], a line a slot."""
    slot, cell = np.nonzero(total[1])
    used, first = np.unique(slot, return_index=True)
    ends = pa.array(np.append(first, len(slot)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (cell.astype(np.int32), *(t[slot, cell] for t in total))]
    return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *lists], ["slot", "cell", "g", "n"])


def best_of_slots(table: DataFrame, add: Callable[[Iterator[pa.RecordBatch]], pa.RecordBatch],
                  best: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
                  slots: int, width: int, bins: int, tasks: int, few_tasks: int) -> list[tuple]:
    """(gain, feature, bin, left sum and rows, whole sum and rows) of the best split of each slot.

    ``add`` gives the ``SUMS`` of one of the table's ``tasks``. Those of some neighbouring slots meet in one task, so what
    reaches the driver does not depend on tasks and bins. ``best`` gives gains, features
    and bins for sums [slot, feature, bin, 2]."""
    several = max(1, slots // 256)

    def split(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        slot = np.concatenate([p.column("slot").to_numpy() for p in parts])
        size = np.concatenate([np.diff(p.column("cell").offsets.to_numpy()) for p in parts])
        used, place = np.unique(slot, return_inverse=True)
        at = np.repeat(place, size) * (width * bins)
        at += np.concatenate([p.column("cell").flatten().to_numpy() for p in parts])
        sums = np.zeros((len(used) * width * bins, 2), np.int64)
        for i, name in enumerate(("g", "n")):
            np.add.at(sums[:, i], at, np.concatenate([p.column(name).flatten().to_numpy() for p in parts]))
        sums = sums.reshape(len(used), width, bins, 2)
        gain, feature, cut = best(sums)
        up = np.cumsum(sums[np.arange(len(used)), feature], 1)
        low, whole = up[np.arange(len(used)), cut], up[:, -1]
        columns = (used, gain, feature, cut, low[:, 0], low[:, 1], whole[:, 0], whole[:, 1])
        types = (pa.int32(), pa.float64(), pa.int32(), pa.int32(), *[pa.int64()] * 4)
        return pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, types)],
                                          ["slot", "gain", "feature", "bin", "gl", "nl", "g", "n"])

    if tasks == 1:
        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = add(batches)
            if own.num_rows:
                yield split([own])

        found = table.mapInArrow(alone, BEST)
    else:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield add(batches)

        def together(group: pa.Table) -> pa.Table:
            return pa.Table.from_batches([split(group.to_batches())])

        several_of = F.expr(f"slot div {several}").alias("some")
        spread = 1 if tasks <= few_tasks else min(table.sparkSession.sparkContext.defaultParallelism, -(-slots // several))
        found = table.mapInArrow(each, SUMS).select(several_of, "*").repartition(spread, "some").groupBy("some").applyInArrow(
            lambda group: together(group.drop_columns(["some"])), BEST)
    out: list[tuple] = [(0.0, 0, 0, 0, 0, 0, 0)] * slots
    for line in found.collect():
        out[line[0]] = tuple(line[1:])
    return out


def _best(table: DataFrame, width: int, bins: int, now: Tree, nodes: list[int], s: Settings, tasks: int) -> list[tuple]:
    """The best splits of the given open nodes on what the scores leave of the labels."""
    place = np.full(len(now.feature), -1, np.int64)
    place[nodes] = np.arange(len(nodes))

    def add(batches: Iterator[pa.RecordBatch]) -> pa.RecordBatch:
        total = np.zeros((2, width, len(nodes) * bins), np.int64)
        for x, label, score in _blocks(batches, width):
            gradient = np.rint((score - label) * ONE)
            at = place[now.leaf_of(x)]
            if (at < 0).any():
                own = at >= 0
                x, gradient, at = x[own], gradient[own], at[own]
            add_up(total, at, x, bins, (gradient, None))
        return sums_batch(by_slot(total, bins))

    def best(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(map(np.array, zip(*(best_split(own, s) for own in sums))))

    return best_of_slots(table, add, best, len(nodes), width, bins, tasks, FEW_TASKS)


def best_split(sums: np.ndarray, s: Settings) -> tuple[float, int, int]:
    """Gain, feature and bin of a node's best split, the first among equals; gain 0 if none."""
    g, n = np.cumsum(sums[..., 0], 1), np.cumsum(sums[..., 1], 1)
    all_g, all_n = g[:, -1:], n[:, -1:]

    def part(g: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (g / ONE) ** 2 / np.maximum(n + s.penalty, 1e-12)

    gain = part(g, n) + part(all_g - g, all_n - n) - part(all_g, all_n)
    gain[(n < max(s.min_rows, 1)) | (all_n - n < max(s.min_rows, 1))] = 0
    at = int(gain.argmax())
    return float(gain.ravel()[at]), *divmod(at, gain.shape[1])


def grow(table: DataFrame, width: int, bins: int, s: Settings, tasks: int) -> Tree:
    """One tree on the gradients that the scores leave. A scan a level; with ``leaves`` the splits
    of greatest gain are then taken, best leaf first, which is what splitting them one by one
    gives, since the best split of a node does not depend on other nodes."""
    tree = Tree(*(np.array([v]) for v in (-1, 0, -1, -1, 0.0, 0, 0.0)))

    def settle(node: int, g: int, n: int) -> None:
        tree.value[node], tree.rows[node] = -s.rate * (g / ONE) / max(n + s.penalty, 1e-12), n

    level = [0]
    for depth in range(max(s.depth, 1)):
        below = []
        for node, (gain, feature, at, gl, nl, g, n) in zip(level, _best(table, width, bins, tree, level, s, tasks)):
            if not depth:
                settle(0, g, n)
            if gain <= 1e-9 or depth == s.depth:
                continue
            left = len(tree.feature)
            for name, extra in (("feature", [-1, -1]), ("bin", [0, 0]), ("left", [-1, -1]), ("right", [-1, -1]),
                                ("value", [0.0, 0.0]), ("rows", [0, 0]), ("gain", [0.0, 0.0])):
                setattr(tree, name, np.concatenate([getattr(tree, name), extra]))
            tree.feature[node], tree.bin[node], tree.gain[node] = feature, at, gain
            tree.left[node], tree.right[node] = left, left + 1
            settle(left, gl, nl)
            settle(left + 1, g - gl, n - nl)
            below += [left, left + 1]
        level = below
        if not level:
            break
    return tree if s.leaves is None else best_first(tree, s.leaves)


def best_first(tree: Tree, leaves: int) -> Tree:
    """The tree of at most ``leaves`` leaves that splits the leaf of greatest gain first."""
    heap, kept = [(-tree.gain[0], 0)] if tree.feature[0] >= 0 else [], {0}
    count = 1
    while heap and count < leaves:
        _, node = heapq.heappop(heap)
        count += 1
        for child in (int(tree.left[node]), int(tree.right[node])):
            kept.add(child)
            if tree.feature[child] >= 0:
                heapq.heappush(heap, (-tree.gain[child], child))
    order = sorted(kept)
    number = {old: new for new, old in enumerate(order)}
    out = Tree(*(getattr(tree, f)[order] for f in ("feature", "bin", "left", "right", "value", "rows", "gain")))
    for new in range(len(order)):
        if out.feature[new] >= 0 and int(out.left[new]) in number:
            out.left[new], out.right[new] = number[int(out.left[new])], number[int(out.right[new])]
        else:
            out.feature[new], out.left[new], out.right[new], out.gain[new] = -1, -1, -1, 0.0
    return out


class _Values:
    def __init__(self, values: np.ndarray):
        self.values = values

    def toArray(self) -> np.ndarray:
        return self.values


@dataclass(frozen=True)
class BoostedModel:
    """Fitted trees. Has the few methods of Spark's own models that scoring uses."""

    base: float
    trees: list[Tree]
    edges: list[np.ndarray]
    features: str = "features"
    prediction: str = "prediction"

    def copy(self) -> BoostedModel:
        return replace(self)

    def setFeaturesCol(self, name: str) -> BoostedModel:
        return replace(self, features=name)

    def setPredictionCol(self, name: str) -> BoostedModel:
        return replace(self, prediction=name)

    @property
    def featureImportances(self) -> _Values:
        """Total gain of each feature's splits, of all splits."""
        total = np.zeros(len(self.edges))
        for t in self.trees:
            np.add.at(total, t.feature[t.feature >= 0], t.gain[t.feature >= 0])
        return _Values(total / total.sum() if total.sum() else total)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = to_bins(x, self.edges)
        return self.base + sum((t.value[t.leaf_of(bins)] for t in self.trees), np.zeros(len(x)))

    def parts(self, x: np.ndarray) -> np.ndarray:
        """Contribution of each feature to each row's score, and last the score's mean over
        the training rows: down a row's path each step in the node's expected value belongs
        to the feature split on. A row's parts add up to its score."""
        bins = to_bins(x, self.edges)
        out = np.zeros((len(x), len(self.edges) + 1))
        out[:, -1] = self.base
        cells, own = out.reshape(-1), np.arange(len(x)) * out.shape[1]
        flat, start = bins.reshape(-1), np.arange(len(x)) * bins.shape[1]
        for t, (mean, depth, feature, after, step) in zip(self.trees, self._paths):
            out[:, -1] += mean
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = feature[node]
                way = 2 * node + (flat[start + at] <= t.bin[node])
                cells[own + at] += step[way]
                node = after[way]
        return out

    @cached_property
    def _paths(self) -> list[tuple]:
        """Of each tree the mean step, ``Tree.steps`` and what each of those adds to it."""
        out = []
        for t in self.trees:
            expected, (depth, feature, after) = expected_values(t), t.steps()
            out.append((expected[0], depth, feature, after, expected[after] - np.repeat(expected, 2)))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        score = self.score

        @F.pandas_udf("double")
        def predicted(values: pd.Series) -> pd.Series:
            return pd.Series(score(np.stack(values.to_numpy())) if len(values) else [], dtype=float)

        return df.withColumn(self.prediction, predicted(vector_to_array(self.features)))


def expected_values(tree: Tree) -> np.ndarray:
    """Of each node, the mean step of the training rows that pass it."""
    out = tree.value.astype(float)
    for node in range(len(tree.feature) - 1, -1, -1):  # children come after their parents
        if tree.feature[node] >= 0:
            a, b = tree.left[node], tree.right[node]
            out[node] = (out[a] * tree.rows[a] + out[b] * tree.rows[b]) / (tree.rows[a] + tree.rows[b])
    return out


@dataclass(frozen=True)
class HistogramBoosting:
    """Squared-error boosting; ``fit`` takes a table of a vector and a label column.

    ``edges`` gives the bins (each feature's upper edges) instead of its quantiles, ``base``
    the score before the first tree instead of the mean label. Rows with a null label or
    vector are left out. A table without rows gives a model without trees.
    """

    features: str
    label: str
    settings: Settings = field(default_factory=Settings)
    edges: list[np.ndarray] | None = None
    base: float | None = None

    def fit(self, df: DataFrame) -> BoostedModel:
        s = self.settings
        rows = df.where(F.col(self.features).isNotNull() & F.col(self.label).isNotNull()).select(
            F.col(self.features).alias("features"), F.col(self.label).cast("double").alias("label"))
        edges = self.edges if self.edges is not None else quantile_edges(rows, "features", s.bins)
        n, mean = rows.agg(F.count("*"), F.avg("label")).first()
        base = self.base if self.base is not None else (mean or 0.0)
        if not n:
            return BoostedModel(base, [], edges, self.features)
        width, bins = len(edges), max(map(len, edges)) + 1

        def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(start, BLOCK_ROWS)
                    x = vectors_of(part.column(0), width)
                    yield _block(to_bins(x, edges), part.column(1).to_numpy(), np.full(part.num_rows, float(base)))

        spread = in_tasks(rows.select(vector_to_array("features").alias("x"), "label"), -(-n // TASK_ROWS))
        table = settled(spread.mapInArrow(bin_rows, BLOCKS), "binned").persist()
        trees: list[Tree] = []
        last, tasks = None, table.rdd.getNumPartitions()
        for turn in range(s.rounds):
            tree = grow(table, width, bins, s, tasks)
            if last is not None:
                last.unpersist()  # the first scan of a round has read it
            if tree.feature[0] < 0 and not tree.value[0]:
                break
            trees.append(tree)
            if turn + 1 < s.rounds:
                last, table = table, _scored(table, width, tree)
                if len(trees) % SETTLE_EVERY == 0:
                    table = settled(table, "scores")
                    tasks = table.rdd.getNumPartitions()
                table = table.persist()
        table.unpersist()
        return BoostedModel(base, trees, edges, self.features)


def in_tasks(df: DataFrame, tasks: int) -> DataFrame:
    """``df`` in so many partitions."""
    now = df.rdd.getNumPartitions()
    return df if tasks == now else df.coalesce(tasks) if tasks < now else df.repartition(tasks)


def _scored(table: DataFrame, width: int, tree: Tree) -> DataFrame:
    """``table`` with the steps of ``tree`` added to the score."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, label, score in _blocks(batches, width):
            yield _block(x, label, score + tree.value[tree.leaf_of(x)])

    return table.mapInArrow(add, BLOCKS)


def tree_contributions(df: DataFrame, model: BoostedModel, names: list[str], keep: list[str]) -> DataFrame:
    """(keep..., feature, value, contribution) of every row and feature, and a row for the
    feature ``(mean)``: a row's contributions add up to its prediction."""
    def parts(values: pd.Series) -> pd.Series:
        return pd.Series(list(model.parts(np.stack(values.to_numpy()))) if len(values) else [], dtype=object)

    own = F.pandas_udf(parts, "array<double>")
    each = F.arrays_zip(F.array(*[F.lit(n) for n in [*names, "(mean)"]]).alias("feature"),
                        F.concat("x", F.array(F.lit(None).cast("double"))).alias("value"), F.col("c").alias("contribution"))
    return df.select(*keep, vector_to_array(model.features).alias("x")).withColumn("c", own("x")).select(
        *keep, F.explode(each).alias("cell")).select(*keep, "cell.*")
