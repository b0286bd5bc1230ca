"""One-bit codes, hard negatives and collocations against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracles import compare, duck
from habitscope.llm import codes, negatives, phrases, queries
from habitscope.llm.queries import importable

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, batch string, v int, id int"


@pytest.fixture
def vectors(spark, tmp_path):
    """An embeddings scan from (vec_id, embedding, label) rows, with columns of clashing names."""
    importable(spark)

    def build(rows, parts=3):
        path = str(tmp_path / f"vectors-{random.random()}")
        spark.createDataFrame([(*r, "b", 1, 2) for r in rows], VECTORS).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)
    return build


def some_rows(n=400, width=24, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width)).astype(np.float32)
    x[n // 2:n // 2 + n // 3] = x[7]  # one very common vector
    rows = [(i, x[i].tolist(), int(rng.integers(4))) for i in range(n)]
    return rows + [
        (1000, None, 1), (1050, [1.0, None] + [0.0] * 22, 1), (1100, [float("nan")] * 24, 1), (1150, [0.0] * 24, 2),
        (None, rows[1][1], 1), (1200, rows[2][1], None), (0, rows[0][1], rows[0][2]), (1250, [float("inf")] * 24, 2),
        (1300, [1.0, 2.0], 3), (1350, [], 1)]


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute_nearest(rows, k, every):
    kept = [(i, np.array(v + [0.0] * (24 - len(v)))) for i, v, _ in rows if i is not None and usable(v) and any(v)]
    out = {}
    for i, q in kept:
        if i % every == 0:
            scores = [((q * x).sum() / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum())), j) for j, x in kept if j != i]
            out[i] = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
    return out


def test_codes_against_brute_force(vectors):
    rows = some_rows()
    found = codes.nearest(vectors(rows), F.col("vec_id") % 10 == 0).collect()
    want, got = brute_nearest(rows, 5, 10), defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({j for _, j in want[i]} & {j for j, _ in got[i]}) for i in want)
    assert hits / (5 * len(want)) >= 0.98
    for i in want:
        exact = {j: s for s, j in want[i]}
        assert all(abs(exact[j] - s) < 1e-9 for j, s in got[i] if j in exact)
    common = [i for i in want if 200 <= i < 333]  # ties by hundreds: the least ids win
    assert common and all([j for j, _ in got[i]] == [j for _, j in want[i]] for i in common)


def test_codes_estimate_without_bias():
    rng = np.random.default_rng(11)
    x = codes.scaled(rng.standard_normal((4000, 64)))
    code, factor = codes.encode(x)
    q = rng.standard_normal((20, 64))
    signs = (np.unpackbits(code, axis=1) * 2.0 - 1) / 8
    estimate = codes.turned(q) @ signs.T / factor
    true = (q / codes.lengths(q)[:, None]) @ (x / codes.lengths(x)[:, None]).T
    error = np.sqrt((1 - factor ** 2) / (factor ** 2 * 63))
    assert code.shape == (4000, 8) and abs((estimate - true).mean()) < 2e-3
    assert (np.abs(estimate - true) <= codes.SPREAD * error).mean() > 0.99


def test_codes_edges(vectors):
    assert codes.nearest(vectors([]), F.col("vec_id") % 50 == 0).count() == 0
    few = codes.nearest(vectors([(0, [1e300, 0.0], 1), (1, [1e-300, 0.0], 1), (2, [0.0, 1.0], 1)], 1),
                        F.col("vec_id") == 0)
    # a float column holds neither of the two sizes: one is infinite, the other zero
    assert few.count() == 0
    few = codes.nearest(vectors([(0, [1e30, 0.0], 1), (1, [1e-30, 0.0], 1), (2, [0.0, 1.0], 1)], 1), F.col("vec_id") == 0)
    assert [(r["rank"], r.vec_id, r.score) for r in few.orderBy("rank").collect()] == [(1, 1, 1.0), (2, 2, 0.0)]


def test_codes_query(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    x = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
    found = {}
    for r in queries.op11_one_bit_codes(spark, SF).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for at in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[at]
        score[at] = -2
        want = set(ids[np.lexsort((ids, -score))[:5]].tolist())
        hits, total = hits + len(want & found[ids[at]]), total + len(want)
    assert hits / total >= 0.95


def brute_negatives(rows, every, positives=5, most=3, scale=256):
    kept = [(i, [math.floor(scale * c) for c in v] + [0] * (24 - len(v)), y) for i, v, y in rows
            if i is not None and y is not None and usable(v)]
    out, done = Counter(), set()
    for i, q, y in kept:
        if i % every or (i, tuple(q), y) in done:
            continue
        done.add((i, tuple(q), y))
        scored = sorted(((sum(a * b for a, b in zip(q, x)), j, z) for j, x, z in kept if j != i), key=lambda s: (-s[0], s[1]))
        for rank, (score, j, _) in enumerate([s for s in scored if s[2] == y][:positives], 1):
            near = [s for s in scored if s[2] != y and 50 * score <= 100 * s[0] <= 95 * score][:most]
            for n, (negative, k, _) in enumerate(near, 1):
                out[(i, j, n, k, score, negative, rank)] += 1
    return out


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")


def test_negatives_against_brute_force(vectors):
    rows = some_rows()
    found = negatives.hard_negatives(vectors(rows), F.col("vec_id") % 10 == 0)
    want = brute_negatives(rows, 10)
    assert len(want) > 300 and Counter(tuple(r[c] for c in COLUMNS) for r in found.collect()) == want


def test_negatives_edges(vectors):
    assert negatives.hard_negatives(vectors([]), F.col("vec_id") % 50 == 0).count() == 0
    large = [(i, [3e18 * (1 + i), 1.0], i % 2) for i in range(4)]  # sums beyond a long
    assert negatives.hard_negatives(vectors(large), F.col("vec_id") == 0).count() == 0
    zero = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 3.0], 2), (3, [-1.0, 0.0], 2), (4, [0.0, 0.0], 2)]
    found = negatives.hard_negatives(vectors(zero), F.col("vec_id") == 0).collect()
    assert sorted((r.positive_id, r["rank"], r.negative_id) for r in found) == [(1, 1, 2), (1, 2, 4)]


def test_segment_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.integers(-300, 300, (50, 37))
    for segments in negatives.LEVELS:
        mean, deviation, size = negatives.summaries(x, segments)
        middle, slack = size * (mean @ mean.T), size * (deviation @ deviation.T)
        assert (np.abs(x @ x.T - middle) <= slack + 1e-6).all()


def brute_phrases(rows, least, most):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 6):
                counts.update((lang, tuple(words[i:i + m])) for i in range(len(words) - m + 1))
    frequent = {k: a for k, a in counts.items() if a >= least}
    inner = {(lang, p[i:i + m]) for (lang, p), a in frequent.items() for m in range(2, len(p))
             for i in range(len(p) - m + 1) if frequent[lang, p[i:i + m]] <= a}
    out = defaultdict(list)
    for (lang, p), a in frequent.items():
        if len(p) > 1 and (lang, p) not in inner:
            n = totals[lang]
            score, k = min((1000 * a * n // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
            out[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]], n, k))
    return Counter((lang, rank, p.decode(), -a, left, right, n, -score, k) for lang, found in out.items()
                   for rank, (score, a, p, left, right, n, k) in enumerate(sorted(found)[:most], 1))


PHRASES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")


def phrase_rows():
    rng = random.Random(4)
    words = ["The", "of", "and", "straße", "漢字", "a-b", "x", "😀", "Ünï", "new", "york", "city", "hall", "|"]
    rows = []
    for i in range(120):
        out = []
        for _ in range(60):
            out.append(rng.choice([*words, "new york", "new york city", "a-b x 😀 of", "rare%d" % rng.randrange(30)]))
            out.append(rng.choice([" ", "  ", "\t", ". ", "\n", ",", " "]))
        rows.append(("".join(out), rng.choice(["en", "en", "fr", None])))
    return rows + [(None, "en"), ("", "fr"), (" .\t", None), ("x" * 3000, "en"), rows[0], rows[0],
                   ("word and " * 4000, "de"), ("same " * 50, "de")]


@pytest.mark.parametrize("least, most", [(5, 2000), (5, 12), (3, 1)])
def test_phrases_against_brute_force(docs, least, most, monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT", 1000)  # cuts in every longer text
    monkeypatch.setattr(phrases, "BITS", 14)
    rows = phrase_rows()
    frame = docs([(i, t, lang) for i, (t, lang) in enumerate(rows)]).withColumns({"p": F.lit(1), "a": F.lit("x")})
    found = phrases.collocations(frame, least, most)
    assert Counter(tuple(r[c] for c in PHRASES) for r in found.collect()) == brute_phrases(rows, least, most)


def test_full_bit_tables_only_cost_speed(docs, monkeypatch):
    rows = phrase_rows()[:40]
    frame = docs([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    monkeypatch.setattr(phrases, "bit_table", lambda df, bits=6: np.full(4, ~np.uint64(0)))
    found = phrases.collocations(frame, 4, 30)
    assert Counter(tuple(r[c] for c in PHRASES) for r in found.collect()) == brute_phrases(rows, 4, 30)


def test_phrases_empty(docs):
    assert phrases.collocations(docs([])).count() == 0
    assert phrases.collocations(docs([(1, "a b c"), (2, None)])).count() == 0


@pytest.mark.parametrize("key", ["op12_collocations", "op13_hard_negatives"])
def test_sql_twins(spark, key):
    sf = "/root/testdata/sf0.01"
    assert compare(queries.QUERIES[key](spark, sf), duck(sf), queries.ORACLES[key]) == []
