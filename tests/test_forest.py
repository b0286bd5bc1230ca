"""Bagged trees: weights, trees against brute force, any layout, edge tables."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from habitscope.operators import boost, forest

COLS = ["a", "b", "c"]
EDGES = [np.arange(7.0), np.arange(29.0), np.array([])]  # every value is a bin


def rows(n=500, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 8, n), rng.integers(0, 30, n), np.zeros(n)], 1).astype(float)
    return x, np.rint(4 * (x[:, 0] > 3) * x[:, 1] - x[:, 1] ** 2 / 10 + rng.integers(0, 5, n))


@pytest.fixture
def frame(spark):
    def build(x, y, parts=3):
        data = [(i, *map(float, r), None if t is None else float(t)) for i, (r, t) in enumerate(zip(x, y))]
        df = spark.createDataFrame(data, "id int, a double, b double, c double, label double").repartition(parts)
        return VectorAssembler(inputCols=COLS, outputCol="features").transform(df)
    return build


def weights(n, tree, seed=42):
    out = []
    for i in range(n):
        text = hashlib.md5(f"{seed}:{tree // 8}:{i}".encode()).hexdigest()
        draw = int(text[4 * (tree % 8):][:4], 16) / 65536
        out.append(next(k for k in range(9) if draw < sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) - 1 / 65536
                        or k == 8))
    return np.array(out)


def brute(x, y, w, min_rows, depth):
    """Nodes as (rows, mean[, feature, threshold, low, high]), every split of every node tried."""
    def part(at):
        return (w[at] * y[at]).sum() ** 2 / w[at].sum()

    def node(at, left):
        own = (int(w[at].sum()), round(float((w[at] * y[at]).sum() / w[at].sum()), 6))
        best = (1e-7, None, None)
        for f in range(x.shape[1]) if left else ():
            for t in np.unique(x[at, f])[:-1]:
                low, high = at[x[at, f] <= t], at[x[at, f] > t]
                if min(w[low].sum(), w[high].sum()) >= min_rows:
                    gain = part(low) + part(high) - part(at)
                    if gain > best[0] + 1e-7:
                        best = (gain, f, t)
        if best[1] is None:
            return own
        f, t = best[1:]
        return (*own, f, t, node(at[x[at, f] <= t], left - 1), node(at[x[at, f] > t], left - 1))

    return node(np.flatnonzero(w), depth)


def shape(model, which, node=0):
    tree, count = model.trees[which], len(model.trees)
    own = (int(tree.rows[node]), round(model.base + count * float(tree.value[node]), 6))
    f = int(tree.feature[node])
    if f < 0:
        return own
    # An edge that no row of the node reaches is as good as the greatest value below it.
    return (*own, f, float(model.edges[f][tree.bin[node]]),
            shape(model, which, int(tree.left[node])), shape(model, which, int(tree.right[node])))


def same(found, wanted, x, at):
    """Equal up to thresholds that part the node's rows alike."""
    assert found[:2] == wanted[:2] and len(found) == len(wanted)
    if len(found) > 2:
        low, other = at[x[at, found[2]] <= found[3]], at[x[at, wanted[2]] <= wanted[3]]
        assert np.array_equal(low, other)
        same(found[4], wanted[4], x, low)
        same(found[5], wanted[5], x, np.setdiff1d(at, low))


@pytest.mark.parametrize("min_rows", [1, 15])
def test_each_tree_is_the_brute_force_tree(frame, min_rows):
    x, y = rows()
    model = forest.BaggedForest("features", "label", ("id",), 10, 3, min_rows=min_rows, edges=EDGES).fit(frame(x, y))
    for t in (0, 7, 8, 9):
        w = weights(len(x), t)
        assert abs(w.mean() - 1) < 0.15 and w.max() < 8
        same(shape(model, t), brute(x, y, w, min_rows, 3), x, np.flatnonzero(w))


def test_same_forest_in_any_layout(frame, monkeypatch):
    x, y = rows(300)
    monkeypatch.setattr(forest, "TASK_ROWS", 60)
    found = []
    for parts, few, cells, rows_ in ((1, 8, 1 << 21, 8192), (4, 8, 500, 50), (5, 0, 2000, 8192)):
        monkeypatch.setattr(forest, "FEW_TASKS", few)
        monkeypatch.setattr(forest, "CELLS", cells)
        monkeypatch.setattr(forest, "SLICE_ROWS", rows_)
        found.append(forest.BaggedForest("features", "label", ("id",), 5, 4).fit(frame(x, y, parts)))
    for other in found[1:]:
        assert other.base == found[0].base
        for a, b in zip(found[0].trees, other.trees, strict=True):
            assert all(np.array_equal(getattr(a, f), getattr(b, f)) for f in vars(a))


def test_it_learns_and_contributions_add_up(frame):
    x, y = rows()
    data = frame(x, y)
    model = forest.BaggedForest("features", "label", ("id",), 20, 8).fit(data)
    scored = model.copy().setPredictionCol("p").transform(data)
    assert scored.agg(F.sqrt(F.avg((F.col("p") - F.col("label")) ** 2))).first()[0] < 0.2 * y.std()
    sums = boost.tree_contributions(data, model, COLS, ["id"]).groupBy("id").agg(F.sum("contribution").alias("s"))
    assert scored.join(sums, "id").where(F.abs(F.col("s") - F.col("p")) > 1e-9).count() == 0
    assert model.featureImportances.toArray()[2] == 0


def test_edges(frame):
    x, y = rows(40)
    none = forest.BaggedForest("features", "label", ("id",), 3).fit(frame(x[:3], [None, float("nan"), float("inf")]))
    assert not none.trees and none.base == 0.0
    flat = forest.BaggedForest("features", "label", ("id",), 3).fit(frame(x, np.full(40, 7.0)))
    assert flat.transform(frame(x, y)).where("prediction <> 7").count() == 0
    assert all(len(t.feature) == 1 for t in flat.trees)
    huge = forest.BaggedForest("features", "label", ("id",), 3, 2).fit(frame(x, y * 1e12))
    assert abs(shape(huge, 1)[1] / 1e12 - np.average(y, weights=weights(40, 1))) < 1e-6
    assert none.transform(frame(x, y)).count() == 40


def test_rows_of_equal_keys_or_contents_weigh_alike(spark, frame):
    x, y = rows(30)
    data = frame(x, y)
    key = forest.key_text((), "features", "label")
    twice = data.union(data.withColumn("id", F.col("id") + 100)).select("a", "b", "label", forest.draws(key, 9, 1).alias("d"))
    assert twice.groupBy("a", "b", "label").agg(F.count_distinct("d").alias("n")).where("n > 1").count() == 0
    nulls = spark.createDataFrame([(None, 1), (None, 1)], "k string, j int")
    assert nulls.select(forest.draws(forest.key_text(("k", "j"), "k", "k"), 1, 1)).distinct().count() == 1


def test_the_driver_gets_one_line_a_node(frame, monkeypatch):
    seen = []
    whole = forest.best_of_slots

    def spied(table, add, best, slots, *rest):
        out = whole(table, add, best, slots, *rest)
        seen.append((rest[2], slots, len(out), {len(line) for line in out}))
        return out

    monkeypatch.setattr(forest, "best_of_slots", spied)
    monkeypatch.setattr(forest, "TASK_ROWS", 250)
    forest.BaggedForest("features", "label", ("id",), 3, 2, edges=EDGES).fit(frame(*rows()))
    assert seen == [(2, n, n, {7}) for n in (3, 6)]
