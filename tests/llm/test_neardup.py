"""Near-duplicates against brute force over full shingle sets."""

import random
import re

import pytest

from habitscope.llm import neardup, queries, rows as R

SF = "/root/testdata/sf0.001"


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= size:
        return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def expected(rows, size, percent=80):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            s, t = sets[a], sets[b]
            if s and t and min(len(s), len(t)) * 100 >= percent * max(len(s), len(t)):
                common = len(s & t)
                if 100 * common >= percent * (len(s) + len(t) - common):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(found, rows, size):
    want = expected(rows, size)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(rows)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(queries.op7_near_duplicates(spark, SF).collect(), rows, 4)


def edited(words, rng, share):
    return [rng.choice("uvwxyz") * 4 if rng.random() < share else w for w in words]


def chain(words, n, step):
    """Each text drops the first ``step`` words of the one before and adds new ones: near to
    its neighbours only."""
    out = [list(words)]
    for k in range(n - 1):
        out.append(out[-1][step:] + [f"n{k}x{j}" for j in range(step)])
    return out


@pytest.mark.parametrize("size", [4, 5])
def test_groups_chains_and_strangers(docs, size):
    rng = random.Random(size)
    texts = []
    for _ in range(6):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 200))]
        texts += [edited(base, rng, s) for s in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1)]
    texts += chain([f"c{i}" for i in range(120)], 12, 8)
    base = [f"h{i}" for i in range(150)]
    texts += [edited(base, rng, 0.025) for _ in range(60)]                     # one large group
    shared = [f"p{i}" for i in range(60)]
    texts += [shared + [f"s{k}x{i}" for i in range(rng.randrange(5, 60))] for k in range(40)]  # a common passage
    rng.shuffle(texts)
    rows = [(i * 3, " ".join(t)) for i, t in enumerate(texts)]
    check(neardup.near_duplicates(docs(rows), size=size).collect(), rows, size)


def test_two_links_through_one_bucket_are_found(docs):
    """Three texts in a row, the ends unlike: whichever is the pivot, all are one group."""
    a, b, c = (" ".join(t) for t in chain([f"c{i}" for i in range(100)], 3, 9))
    for order in ([a, b, c], [c, a, b], [b, c, a]):
        rows = list(enumerate(order))
        check(neardup.near_duplicates(docs(rows), size=4).collect(), rows, 4)


def test_case_space_and_short_texts(docs):
    rows = [(1, "One Two\tthree"), (2, "one\x0btwo three "), (3, "one two"), (4, "ONE"), (5, "one"), (6, ""), (7, None),
            (8, " "), (9, "É é"), (10, "é É")]
    check(neardup.near_duplicates(docs(rows), size=4).collect(), rows, 4)


def test_edges(docs, edges):
    out = neardup.near_duplicates(docs(edges).selectExpr("*", "1 AS id", "2 AS bands"), size=4).collect()
    assert len(out) == len(edges)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert {r.component_id for r in by[7] + by[6]} == {6} and [r.kept for r in by[6]] == [True]
    assert sorted((r.component_id or -1, r.kept) for r in by[None]) == [(-1, True), (6, False)]
    assert by[2][0].component_id == 2 and by[2][0].kept and by[2][0].n_shingles == 0
    assert neardup.near_duplicates(docs([])).count() == 0


def test_rows_of_one_doc_id_have_the_component_of_their_text(docs):
    def words(name, n):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [(1, words("a", 60)), (5, words("a", 62)), (5, words("u", 30)), (5, words("u", 30)),
            (6, words("u", 31)), (1, words("z", 12)), (9, words("z", 13)), (None, words("u", 30))]
    found = neardup.near_duplicates(docs(rows), size=4).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in found) == [
        (0, 27, 5, False), (1, 9, 1, True), (1, 57, 1, True), (5, 27, 5, True), (5, 27, 5, True),
        (5, 59, 1, False), (6, 28, 5, False), (9, 10, 1, False)]


def test_components(spark):
    pairs = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (22, 21)] + [(100 + i, 101 + i) for i in range(40)]
    found = {r.node: r.component for r in neardup.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {n: 1 for n in (1, 2, 3, 7, 8, 9)} | {n: 20 for n in (20, 21, 22)} | {100 + i: 100 for i in range(41)}
    assert found == want
    assert neardup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signature_estimates_similarity():
    import numpy as np
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 100, 100))
    s, t = (neardup.signature(np.concatenate([common, x])) for x in (a, b))
    assert abs((s == t).mean() - 600 / 800) < 0.12


@pytest.mark.parametrize("bits", [1 << 26, 1 << 10])
def test_rows_are_picked_without_moving_the_others(spark, monkeypatch, bits):
    """Exact also where numbers share bits; then only what passed is shuffled."""
    monkeypatch.setattr(R, "BITS", bits)
    table = spark.range(70_000).selectExpr("id AS row_number", "id * 2 AS x")
    chosen = table.where("row_number % 997 IN (0, 5) OR row_number IN (32767, 32768, 65535)").select("row_number")
    out = R.picked(table, chosen.union(chosen), 70_000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange hashpartitioning" in plan or "LeftSemi" in plan) == (bits < 70_000)
    assert sorted(r.row_number for r in out.collect()) == sorted(r.row_number for r in chosen.collect())
    assert out.where("x <> 2 * row_number").count() == 0
    assert R.picked(table, chosen.where("false"), 70_000).count() == 0


def test_texts_of_unlike_rows_are_not_shuffled(spark, docs, tmp_path, monkeypatch):
    """Sets are built from rows that the bit table lets through, and from no others."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(40)] + [(100, "a b c d e f g"), (101, "a b c d e f g")]
    rows += [(102, "a b c d e f g h"), (103, "a b c d e f g h")]
    docs(rows).write.parquet(str(tmp_path / "in"))
    seen = []
    monkeypatch.setattr(neardup, "sets_of", lambda texts, size, real=neardup.sets_of: seen.append(texts) or real(texts, size))
    out = neardup.near_duplicates(spark.read.parquet(str(tmp_path / "in")), size=4)
    check(out.collect(), rows, 4)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" not in plan and "hashpartitioning" not in plan
