"""Language network and co-training: gradients, tables, held-out accuracy, edge cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from habitscope.llm import cotrain as C
from habitscope.llm import language as L
from habitscope.llm import queries

SF = "/root/testdata/sf0.01"


def tiny(languages=("a", "b", "c"), seed=0):
    rng = np.random.default_rng(seed)
    return L.Network(list(languages), rng.normal(0, 1, (256, L.EMBEDDED)),
                     [rng.normal(0, .5, (w * L.EMBEDDED, L.FILTERS)) for w in L.WIDTHS],
                     rng.normal(0, .5, L.FILTERS * 3), rng.normal(0, .5, (L.FILTERS * 3, len(languages))),
                     rng.normal(0, .5, len(languages)))


def test_gradients_are_the_slopes_of_the_loss():
    net, rng = tiny(), np.random.default_rng(1)
    x, y = rng.integers(0, 256, (5, L.WINDOW)).astype(np.uint8), rng.integers(0, 3, 5)

    def loss():
        return -L.forward(net, x)[3][np.arange(5), y].mean()
    for weight, slope in zip(net.parameters(), L.gradients(net, x, y)):
        flat = weight.reshape(-1)
        for i in np.argsort(-np.abs(slope.reshape(-1)))[:4]:
            keep, h = flat[i], 1e-6
            flat[i] = keep + h
            up = loss()
            flat[i] = keep - h
            down = loss()
            flat[i] = keep
            assert abs((up - down) / (2 * h) - slope.reshape(-1)[i]) < 1e-4


def test_tables_are_the_network():
    net = tiny()
    x = np.random.default_rng(2).integers(0, 256, (700, L.WINDOW)).astype(np.uint8)
    assert np.allclose(L.Tables(net).log_probabilities(x), L.forward(net, x)[3], atol=1e-3)


def test_windows_cover_every_byte():
    texts = ["", "b" * 256, "c" * 257, "d", None, "é" * 400]
    data, offsets = L.text_bytes(pa.array(texts))
    x, row, size = L.windows(data, offsets)
    for i, t in enumerate(texts):
        assert b"".join(w[:n].tobytes() for w, n in zip(x[row == i], size[row == i])) == (t or "").encode()


def test_language_query(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op3_language(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    own = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert np.mean(own) > 0.95


def test_language_edges(docs, edges):
    rng = random.Random(0)
    rows = edges + [(100 + i, " ".join(rng.choices(w, k=60)), lang) for i in range(40)
                    for lang, w in (("aa", ["aba", "cad"]), ("bb", ["xyx", "zwz"]), (None, ["mmm"]))]
    rows.append((900, "12 !? \n 34", "en"))
    found = L.digest(docs(rows).selectExpr("*", "'q' AS lang_pred", "1 AS score")).collect()
    assert len(found) == len(rows)
    text = {}
    for r in rows:
        text.setdefault(r[0], []).append(r[1])
    for r in found:
        letters = any(c.isalpha() for t in text[r.doc_id] for c in t or "")
        assert (r.lang_pred == "und") == (not letters) or r.doc_id is None
        assert r.doc_id is not None or not r.held_out
    assert L.digest(docs([])).count() == 0
    assert {r.lang_pred for r in L.digest(docs([(1, "abc", None)])).collect()} == {"und"}


def test_quality_query_against_labels_not_fitted(spark, monkeypatch):
    """With a small fitting sample the other labelled rows are held out."""
    monkeypatch.setattr(C, "LABELLED", 200)
    rows = {r.doc_id: r for r in queries.op1_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    good, bad = ([rows[x.doc_id].kept for x in labels if x.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.15


def test_views_teach_each_other():
    """The content view alone is told by few labels; the metadata view's labels help it."""
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 3000)
    content = np.concatenate([(y[:, None] * 2 - 1) * 0.5 + rng.normal(0, 1, (3000, 12)), rng.normal(0, 1, (3000, 40))], 1)
    meta = (y[:, None] * 2 - 1) * 1.5 + rng.normal(0, 1, (3000, 3))
    label = np.full(3000, -1)
    label[:120] = y[:120]

    def right(rounds):
        v = C.cotrained(content.astype(np.float32), meta.astype(np.float32), label, rounds)
        p = v.scores(content[1000:], meta[1000:])
        return [((x >= .5) == y[1000:]).mean() for x in p]
    before, after = right(0), right(4)
    assert after[0] > before[0] and after[2] >= max(after[0], after[1]) - 0.01


def test_quality_edges(spark, docs, edges):
    rng = random.Random(3)
    rows = edges + [(100 + i, "good words here " * rng.randrange(5, 20), "en", "s") for i in range(60)]
    rows += [(200 + i, "### $$$ %%% !!! " * rng.randrange(5, 20), "en", "s") for i in range(60)]
    labels = spark.createDataFrame([(100 + i, 1) for i in range(60)] + [(200 + i, 0) for i in range(60)]
                                   + [(1, None), (None, 1), (5000, 1), (100, 1)], "doc_id long, quality int")
    found = C.digest(docs(rows).selectExpr("*", "1 AS score", "2 AS kept", "3 AS label"), labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.kept == (r.score >= .5) for r in found)
    by = {r.doc_id: r.kept for r in found}
    assert all(by[100 + i] and not by[200 + i] for i in range(60))
    assert C.digest(docs([]), labels).count() == 0
    one = labels.where("quality = 1")
    assert all(r.kept for r in C.digest(docs(rows), one).collect())
    assert all(r.kept for r in C.digest(docs(rows), labels.where("false")).collect())


def test_content_features_do_not_cross_rows():
    texts = ["ab cd\nef", "", None, "ab cd\nef", "x" * 3000]
    together = C.content_features(pa.array(texts))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], C.content_features(pa.array([t], pa.string()))[0])
    assert (together[0] == together[3]).all()


@pytest.mark.parametrize("kind", [0, 1])
def test_calibration_keeps_an_uninformative_view_at_the_prior(kind):
    rng = np.random.default_rng(kind)
    x, y = rng.normal(0, 1, (2000, 5)), (rng.random(2000) < 0.8).astype(float)
    model = C.calibrated(C.logistic(x[:1000], y[:1000]), x[1000:], y[1000:])
    assert abs((1 / (1 + np.exp(-model.log_odds(x)))).mean() - 0.8) < 0.05
