"""Weak supervision and exact top-k search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from check_oracles import compare, duck
from habitscope.llm import queries, rules, topk

SF = "/root/testdata/sf0.001"


def plain_figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if seen[tuple(words[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def check_figures(found, docs):
    want = Counter((i, *plain_figures(t), len(plain_figures(t)) and (
        plain_figures(t)[0] < 50 or 100 * plain_figures(t)[4] > 50 * plain_figures(t)[0])) for i, t in docs)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in found) == want
    assert not any(r.kept and r.base_failed for r in found)


def test_rules_query(spark):
    found = queries.op2_quality_rules(spark, SF).collect()
    check_figures(found, [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])


def test_rules_tell_good_from_bad(spark):
    """Held against labels, which no rule and no estimate has seen."""
    found = queries.op2_quality_rules(spark, "/root/testdata/sf0.01").where("NOT base_failed").select("doc_id", "kept")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.join(labels, "doc_id").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_rules_edges(docs, edges):
    rows = edges + [(20, "a b c a b c a b c " * 20), (21, "x y\n\nx y\n \nx y \nx y"), (22, "aa aa aa aa"), (23, "a b c d a b c")]
    rows += [(30 + k, " ".join(random.Random(k).choices("abcd", k=70))) for k in range(8)]
    check_figures(rules.digest(docs(rows).selectExpr("*", "1 AS words", "2 AS n_words")).collect(), [r[:2] for r in rows])
    assert rules.digest(docs([])).count() == 0


def test_estimation_recovers_the_rules(spark):
    """Votes drawn from known shares; the same steps in numpy give the same estimate."""
    rng = np.random.default_rng(5)
    good = rng.random(4000) < 0.8
    names = [r.name for r in rules.RULES]
    votes = np.array([[rng.choice([1, 0, -1], p=[.8, .18, .02] if g else [.5, .2, .3]) for _ in names] for g in good])
    frame = spark.createDataFrame([tuple(map(int, v)) for v in votes], ", ".join(f"{n} int" for n in names))
    params = rules.estimate(frame)
    assert abs(params["good"] - 0.8) < 0.08
    share, table = rules.PRIOR_GOOD, {n: {y: np.array(rules.PRIOR[y]) for y in (0, 1)} for n in names}
    for _ in range(rules.STEPS):
        odds = np.full(len(votes), math.log(share / (1 - share)))
        for k, n in enumerate(names):
            at = 1 - votes[:, k]
            odds += np.log(table[n][1][at] / table[n][0][at])
        p = 1 / (1 + np.exp(-odds))
        w = rules.PRIOR_WEIGHT * len(votes)
        share = round((p.sum() + w * rules.PRIOR_GOOD) / (len(votes) + w), 6)
        for k, n in enumerate(names):
            for y, q in ((1, p), (0, 1 - p)):
                table[n][y] = np.array([round((q[votes[:, k] == v].sum() + w * rules.PRIOR[y][j]) / (q.sum() + w), 6)
                                        for j, v in enumerate((1, 0, -1))])
    assert abs(params["good"] - share) < 1e-5
    for n in names:
        for y in (0, 1):
            assert np.allclose(params[n][y], table[n][y], atol=1e-5)


def test_rules_use_no_python_on_executors(spark):
    plan = queries.op2_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute(rows, asks, k):
    fine = [(i, v) for i, v in rows if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in fine]
    out = []
    for i, v in {(i, tuple(v)) for i, v in whole if asks(i)}:
        best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, v int")


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e7])
@pytest.mark.parametrize("block", [7, 4096])
def test_top_k_equals_brute_force(spark, scale, block):
    rng = random.Random(int(scale) + block)
    rows = [(i, [scale * rng.choice([rng.gauss(0, .2), 0.25, -0.5]) for _ in range(6)], 0, 1) for i in range(90)]
    rows += [(100 + i, [scale * 0.25] * 6, 0, 1) for i in range(40)]           # ties
    rows += [(200, None, 0, 1), (201, [None] * 6, 0, 1), (202, [float("nan")] * 6, 0, 1), (203, [float("inf")] * 6, 0, 1),
             (None, [scale] * 6, 0, 1), (220, [], 0, 1), (221, [scale, -scale], 0, 1), rows[0], rows[3]]
    from pyspark.sql import functions as F
    found = topk.top_k(vectors(spark, rows), F.col("vec_id") % 3 == 0, k=5, block=block, batch=16)
    assert sorted(map(tuple, found.collect())) == brute([r[:2] for r in rows], lambda i: i % 3 == 0, 5)


def test_top_k_of_few_and_none(spark):
    from pyspark.sql import functions as F
    few = topk.top_k(vectors(spark, [(0, [1.0], 0, 0), (1, [2.0], 0, 0)]), F.col("vec_id") == 0, k=20)
    assert [tuple(r) for r in few.collect()] == [(0, 1, 1, 64 * 128)]
    assert topk.top_k(vectors(spark, []), F.col("vec_id") == 0).count() == 0


def test_scores_beyond_a_long_are_the_nearest(spark):
    from pyspark.sql import functions as F
    rows = [(0, [1e12, 1.0], 0, 0), (1, [1e12, 0.0], 0, 0), (2, [-1e300, 0.0], 0, 0), (3, [0.0, 2.0], 0, 0)]
    found = topk.top_k(vectors(spark, rows), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 2 ** 63 - 1), (0, 2, 3, 64 * 128), (0, 3, 2, -2 ** 63)]


def test_depths_change_no_answer():
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 12, (5, 16))
    x = np.floor(centres[rng.integers(0, 5, 400)] + rng.normal(0, 2, (400, 16))).astype(np.int64)
    ids = np.arange(400)
    full = topk.block_top(x[:30], ids[:30], x, ids, 10, (1.0,))
    for depths in ((0.3, 1.0), (0.1, 0.4, 0.9, 1.0)):
        some = topk.block_top(x[:30], ids[:30], x, ids, 10, depths)
        assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(full, some))


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_equals_sql(spark, key):
    assert [p for p in compare(queries.QUERIES[key](spark, SF), duck(SF), queries.ORACLES[key])] == []
