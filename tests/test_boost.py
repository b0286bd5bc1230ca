"""Histogram boosting: trees against brute force, any layout, contributions."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from habitscope.operators import boost

COLS = ["a", "b", "c"]


def rows(n=600, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 8, n), rng.integers(0, 30, n), np.zeros(n)], 1).astype(float)
    y = np.rint(4 * (x[:, 0] > 3) * x[:, 1] - x[:, 1] ** 2 / 10 + rng.integers(0, 5, n))
    return x, y


@pytest.fixture
def frame(spark):
    def build(x, y, parts=3):
        data = [(*map(float, r), None if t is None else float(t)) for r, t in zip(x, y)]
        df = spark.createDataFrame(data, "a double, b double, c double, label double").repartition(parts)
        return VectorAssembler(inputCols=COLS, outputCol="features").transform(df)
    return build


def brute_tree(x, g, penalty, min_rows, depth):
    """Nodes as (rows, feature, threshold, gain) by trying every split of every node."""
    def part(v):
        return v.sum() ** 2 / (len(v) + penalty)

    def node(at, left):
        best = (1e-9, None, None)
        for f in range(x.shape[1]) if left else ():
            for t in np.unique(x[at, f])[:-1]:
                low = at[x[at, f] <= t]
                high = at[x[at, f] > t]
                if min(len(low), len(high)) >= min_rows:
                    gain = part(g[low]) + part(g[high]) - part(g[at])
                    if gain > best[0] + 1e-9:
                        best = (gain, f, t)
        if best[1] is None:
            return (len(at),)
        f, t = best[1:]
        return (len(at), f, t, node(at[x[at, f] <= t], left - 1), node(at[x[at, f] > t], left - 1))

    return node(np.arange(len(x)), depth)


def shape(tree, edges, node=0):
    f = int(tree.feature[node])
    if f < 0:
        return (int(tree.rows[node]),)
    return (int(tree.rows[node]), f, float(edges[f][tree.bin[node]]),
            shape(tree, edges, int(tree.left[node])), shape(tree, edges, int(tree.right[node])))


@pytest.mark.parametrize("penalty, min_rows", [(1.0, 1), (0.0, 20)])
def test_tree_is_the_brute_force_tree(frame, penalty, min_rows):
    x, y = rows()
    s = boost.Settings(rounds=1, depth=3, penalty=penalty, min_rows=min_rows)
    model = boost.HistogramBoosting("features", "label", s, base=0.0).fit(frame(x, y))
    assert shape(model.trees[0], model.edges) == brute_tree(x, -y, penalty, min_rows, 3)


def test_best_leaf_first_takes_the_greatest_gains(frame):
    x, y = rows()
    full, few = (boost.HistogramBoosting("features", "label", boost.Settings(
        rounds=1, depth=5, min_rows=5, leaves=n), base=0.0).fit(frame(x, y)).trees[0] for n in (None, 6))
    assert (few.feature < 0).sum() == 6
    taken, open_ = [], [0]  # splitting one by one, best first
    while len(taken) < 5:
        node = max((n for n in open_ if full.feature[n] >= 0), key=lambda n: (full.gain[n], -n))
        taken.append(full.gain[node])
        open_.remove(node)
        open_ += [int(full.left[node]), int(full.right[node])]
    assert np.allclose(sorted(taken), sorted(few.gain[few.feature >= 0]))


def test_same_model_in_any_layout(frame, monkeypatch):
    x, y = rows()
    s = boost.Settings(rounds=4, depth=3, min_rows=5, leaves=5)
    monkeypatch.setattr(boost, "TASK_ROWS", 100)
    monkeypatch.setattr(boost, "SETTLE_EVERY", 2)
    models = []
    for parts, few in ((1, 32), (4, 32), (5, 0)):
        monkeypatch.setattr(boost, "FEW_TASKS", few)
        models.append(boost.HistogramBoosting("features", "label", s, base=1.0).fit(frame(x, y, parts)))
    for other in models[1:]:
        for a, b in zip(models[0].trees, other.trees, strict=True):
            assert all(np.array_equal(getattr(a, f), getattr(b, f)) for f in vars(a))


def test_it_learns_and_contributions_add_up(frame):
    x, y = rows()
    data = frame(x, y)
    model = boost.HistogramBoosting("features", "label", boost.Settings(rounds=30, depth=4, rate=0.3)).fit(data)
    scored = model.copy().setPredictionCol("p").transform(data)
    gap = scored.agg(F.sqrt(F.avg((F.col("p") - F.col("label")) ** 2))).first()[0]
    assert gap < 0.25 * y.std()
    parts = boost.tree_contributions(data, model, COLS, ["a", "b", "label"])
    sums = parts.groupBy("a", "b", "label").agg((F.sum("contribution") / F.count_if(F.col("feature") == "a")).alias("s"))
    odd = scored.join(sums, ["a", "b", "label"]).where(F.abs(F.col("s") - F.col("p")) > 1e-9)
    assert odd.count() == 0
    assert parts.where("feature = 'c' AND contribution <> 0").count() == 0
    mean = parts.where("feature = '(mean)'").first().contribution
    assert abs(mean - scored.agg(F.avg("p")).first()[0]) < 1e-9
    total = model.featureImportances.toArray()
    assert total[2] == 0 and abs(total.sum() - 1) < 1e-12


def test_edges(frame):
    x, y = rows(40)
    none = boost.HistogramBoosting("features", "label").fit(frame(x[:3], [None] * 3))
    assert not none.trees and none.base == 0.0
    flat = boost.HistogramBoosting("features", "label", boost.Settings(rounds=3)).fit(frame(x, np.full(40, 7.0)))
    assert flat.transform(frame(x, y)).where("prediction <> 7").count() == 0
    some = boost.HistogramBoosting("features", "label", boost.Settings(rounds=2)).fit(frame(x, [None, *y[1:]]))
    assert some.trees[0].rows[0] == 39
    assert some.transform(frame(x, y).limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 4])
def test_rows_are_spread_and_a_level_brings_one_line_a_node(frame, monkeypatch, parts):
    seen = []
    whole = boost.best_of_slots

    def spied(table, add, best, slots, width, bins, tasks, few):
        out = whole(table, add, best, slots, width, bins, tasks, few)
        seen.append((tasks, slots, len(out), {len(line) for line in out}))
        return out

    monkeypatch.setattr(boost, "best_of_slots", spied)
    monkeypatch.setattr(boost, "TASK_ROWS", 200)
    boost.HistogramBoosting("features", "label", boost.Settings(rounds=2, depth=2)).fit(frame(*rows(), parts))
    assert seen == [(3, n, n, {7}) for n in (1, 2, 1, 2)]  # 600 rows, however few partitions they came in


def test_leaves_and_contributions_of_a_lopsided_tree():
    tree = boost.Tree(*(np.array(v) for v in (
        [1, -1, 0, -1, -1], [3, 0, 1, 0, 0], [1, -1, 3, -1, -1], [2, -1, 4, -1, -1], [0.0, 1.0, 0.0, 2.0, 4.0],
        [4, 2, 2, 1, 1], [5.0, 0.0, 2.0, 0.0, 0.0])))
    x = np.array([[0, 3], [0, 4], [1, 9], [2, 9]], np.uint8)
    assert tree.leaf_of(x).tolist() == [1, 3, 3, 4]
    assert tree.leaf_of(x[:0]).tolist() == []
    model = boost.BoostedModel(10.0, [tree], [np.arange(5.0), np.arange(10.0)])
    assert model.parts(x.astype(float)).tolist() == [[0, -1, 12], [-1, 1, 12], [-1, 1, 12], [1, 1, 12]]


def test_sums_by_feature_are_those_by_slot():
    rng = np.random.default_rng(3)
    x, slot, g = rng.integers(0, 5, (200, 3)).astype(np.uint8), rng.integers(2, 4, 200), rng.integers(-2**40, 2**40, 200)
    total = np.zeros((2, 3, 6 * 5), np.int64)
    for part in (slice(0, 150), slice(150, 200), slice(0, 0)):
        boost.add_up(total, slot[part], x[part], 5, (g[part], None))
    wanted = np.zeros((2, 6, 15), np.int64)
    for row in range(200):
        for f in range(3):
            wanted[:, slot[row], f * 5 + x[row, f]] += g[row], 1
    assert np.array_equal(boost.by_slot(total, 5), wanted)
