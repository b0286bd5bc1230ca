"""Quality by co-training: one classifier reads the text, one the document's metadata.

Both start from labelled documents. In each round either view labels the unlabelled ones
that it is sure of, and the other view learns them. Each view's scores are calibrated on
labelled documents that no view has learnt from, and a document's score adds what both
calibrated views say beyond the share of good documents.

Fitting takes bounded samples (LABELLED, POOL); every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habitscope.llm.rows import as_scan, file_rows, least_hashed
from habitscope.llm.words import mixed, runs, slices, text_bytes, word_hashes, word_spans
from habitscope.sources.scratch import settled

#: Bounds of the fit: labelled documents, unlabelled ones, rounds, labels given in a round.
LABELLED, POOL, ROUNDS, GIVEN = 5000, 5000, 5, 400
SURE = 0.97
KINDS = 16
SOURCES, LANGUAGES, SIZES = 64, 16, 24
N_CONTENT, N_META = KINDS * KINDS + 5, SOURCES + LANGUAGES + SIZES

#: Kind of each byte: blank, line end, lower, upper, digit, stops, shouts, quotes, symbols,
#: bars, brackets, other ASCII, lead byte, following byte.
KIND = np.full(256, 11, np.int64)
for _k, _chars in enumerate((b" \t", b"\n\r", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".,;:",
                             b"!?", b"\"'`-", b"#*$%&", b"|<>", b"()[]{}")):
    KIND[list(_chars)] = _k
KIND[192:], KIND[128:192] = 12, 13


def content_features(column: pa.Array) -> np.ndarray:
    """For each text: square roots of the shares of byte-kind pairs, then the shares of
    repeated words, three-word windows and lines, the mean word length and log length."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    out = np.zeros((n, N_CONTENT), np.float32)
    if not len(data):
        return out
    kind = KIND[data]
    size = np.diff(offsets)
    row = np.repeat(np.arange(n) * KINDS * KINDS, size)
    pair = row[1:] + kind[:-1] * KINDS + kind[1:]
    same = np.ones(len(data) - 1, bool)
    inner = offsets[1:-1]
    same[inner[(inner > 0) & (inner < len(data))] - 1] = False
    pairs = np.bincount(pair[same], minlength=n * KINDS * KINDS).reshape(n, -1)
    out[:, : KINDS * KINDS] = np.sqrt(pairs / np.maximum(size, 1)[:, None])
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    windows = hashes.copy()
    windows[:-2] = mixed(hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7))
    line_starts, line_ends = runs(data, offsets, np.arange(256) != 10)
    lines, line_first = word_hashes(data, line_starts, line_ends), np.searchsorted(line_starts, offsets)
    for i in range(n):
        a, b = first[i], first[i + 1]
        if b > a:
            out[i, -5] = 1 - len(np.unique(hashes[a:b])) / (b - a)
        if b - a > 2:
            out[i, -4] = 1 - len(np.unique(windows[a:b - 2])) / (b - a - 2)
        c, d = line_first[i], line_first[i + 1]
        if d > c:
            out[i, -3] = 1 - len(np.unique(lines[c:d])) / (d - c)
        out[i, -2] = (ends[a:b] - starts[a:b]).mean() / 10 if b > a else 0
    out[:, -1] = np.log1p(size) / 10
    return out


def _hashed(values: list, slots: int) -> np.ndarray:
    column = pa.array([("" if v is None else "=" + v) for v in values], pa.string())
    data, offsets = text_bytes(column)
    at = np.zeros(len(values), np.int64)
    full = np.flatnonzero(np.diff(offsets))
    at[full] = (word_hashes(data, offsets[full], offsets[full + 1]) % np.uint64(slots - 1)).astype(np.int64) + 1
    return at


def meta_features(part: pa.RecordBatch) -> np.ndarray:
    """One-hot source and language (hashed) and size class; nulls have slots of their own."""
    def column(name: str) -> list:
        return part.column(part.schema.get_field_index(name)).to_pylist()
    n = part.num_rows
    size = np.array([0 if v is None or v < 0 else 1 + min(int(v).bit_length(), SIZES - 2) for v in column("n_chars")], np.int64)
    out = np.zeros((n, N_META), np.float32)
    rows = np.arange(n)
    out[rows, _hashed(column("source"), SOURCES)] = 1
    out[rows, SOURCES + _hashed(column("lang"), LANGUAGES)] = 1
    out[rows, SOURCES + LANGUAGES + size] = 1
    return out


@dataclass
class Logistic:
    """Standardised logistic regression, then a calibration a * z + b of its log odds."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.raw(x) + self.shift, -12, 12)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-2, steps: int = 12) -> Logistic:
    """Newton steps on the penalised likelihood."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], 1).astype(float)
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), decay * len(x))
    penalty[-1] = 1e-6 * len(x)
    for _ in range(steps):
        p = _sigmoid(z @ w)
        h = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(penalty)
        w += np.linalg.solve(h, z.T @ (y - p) - penalty * w)
    return Logistic(mean.astype(np.float32), scale.astype(np.float32), w[:-1].astype(np.float32), float(w[-1]))


def calibrated(model: Logistic, x: np.ndarray, y: np.ndarray) -> Logistic:
    """Platt's two parameters, fitted to smoothed labels of held-back documents."""
    z = model.raw(x)
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(30):
        p = _sigmoid(a * z + b)
        v = p * (1 - p) + 1e-6
        h = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-3]])
        d = np.linalg.solve(h, [(z * (target - p)).sum(), (target - p).sum()])
        a, b = a + np.clip(d[0], -1, 1), b + np.clip(d[1], -1, 1)
    if a <= 0:  # the view says nothing: the share of good documents remains
        share = target.mean()
        a, b = 0.0, np.log(share / (1 - share))
    model.slope, model.shift = float(a), float(b)
    return model


@dataclass
class Views:
    content: Logistic
    meta: Logistic
    prior: float  # log odds of good

    def scores(self, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.content.log_odds(content), self.meta.log_odds(meta)
        return _sigmoid(a), _sigmoid(b), _sigmoid(a + b - self.prior)


def cotrained(content: np.ndarray, meta: np.ndarray, label: np.ndarray, rounds: int = ROUNDS) -> Views | None:
    """Fit both views; ``label`` is 0, 1, or -1 for unlabelled. Of each label two
    of three rows are learnt and one held back; None unless both labels occur in both."""
    known = np.flatnonzero(label >= 0)
    back = np.sort(np.concatenate([np.flatnonzero(label == y)[2::3] for y in (0, 1)]))
    learn = np.setdiff1d(known, back)
    if any(len(set(label[s].tolist())) < 2 for s in (back, learn)):
        return None
    views = (content, meta)
    given = [{int(i): int(label[i]) for i in learn} for _ in views]
    pool = np.flatnonzero(label < 0)
    models: list[Logistic] = []
    for step in range(rounds + 1):
        models = []
        for x, own in zip(views, given):
            rows = np.array(sorted(own))
            models.append(calibrated(logistic(x[rows], np.array([own[i] for i in rows.tolist()], float)), x[back], label[back]))
        if step == rounds:
            break
        share = label[learn].mean()
        for k in (0, 1):
            free = np.array([i for i in pool.tolist() if i not in given[1 - k]], np.int64)
            if not len(free):
                continue
            p = _sigmoid(models[k].log_odds(views[k][free]))
            order = np.argsort(p, kind="stable")
            for i in order[: max(1, int(GIVEN * (1 - share)))].tolist():
                if p[i] <= 1 - SURE:
                    given[1 - k][int(free[i])] = 0
            for i in order[::-1][: max(1, int(GIVEN * share))].tolist():
                if p[i] >= SURE:
                    given[1 - k][int(free[i])] = 1
    share = np.clip(label[known].mean(), 1e-3, 1 - 1e-3)
    return Views(models[0], models[1], float(np.log(share / (1 - share))))


def sample_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Features and label (-1: none) of the bounded fitting sample: LABELLED rows of least
    doc_id hash of ``labels`` and POOL documents of least hash under another seed."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("quality").alias("label"))
    known = least_hashed(known, LABELLED, 1, "doc_id")
    pool = least_hashed(docs.where("doc_id IS NOT NULL").select("doc_id"), POOL, 9, "doc_id")
    ids = pool.select("doc_id", F.lit(-1).alias("label")).unionByName(known).groupBy(F.col("doc_id").alias("__id")).agg(
        F.max("label").alias("__label"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            x = content_features(part.column(part.schema.get_field_index("text")))
            m = meta_features(part)
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc_id")), part.column(part.schema.get_field_index("__label")).cast(pa.int64()),
                 pa.array([v.tobytes() for v in x], pa.binary()), pa.array([v.tobytes() for v in m], pa.binary())],
                ["doc_id", "label", "content", "meta"])

    docs = as_scan(docs)
    # LABELLED + POOL ids at most, and one place for each, however often an id repeats.
    places = settled(
        file_rows(docs.select("doc_id")).join(F.broadcast(ids), F.col("doc_id") == F.col("__id"))
        .groupBy("__id", "__label").agg(F.min(F.struct("__path", "__row")).alias("at"))
        .select("__label", "at.__path", "at.__row"), "quality-sample")
    chosen = file_rows(docs).join(F.broadcast(places), ["__path", "__row"])
    return chosen.select("doc_id", "text", "source", "lang", "n_chars", "__label").mapInArrow(
        features, "doc_id long, label long, content binary, meta binary")


def standard(docs: DataFrame) -> DataFrame:
    """The columns that both views read, in their usual types."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("source").cast("string"),
                       F.col("lang").cast("string"), F.col("n_chars").cast("long"))


def fitted(docs: DataFrame, labels: DataFrame) -> Views | None:
    rows = sorted((r["doc_id"], r["label"], bytes(r["content"]), bytes(r["meta"]))
                  for r in sample_features(standard(docs), labels).collect())
    if not rows:
        return None
    return cotrained(np.stack([np.frombuffer(r[2], np.float32) for r in rows]),
                     np.stack([np.frombuffer(r[3], np.float32) for r in rows]), np.array([r[1] for r in rows]))


ADDED = ("p_content", "p_meta", "score", "kept")


def scored(docs: DataFrame, views: Views | None, least: float = 0.5) -> DataFrame:
    """``docs`` with ``p_content``, ``p_meta``, ``score`` and ``kept`` (score >= ``least``).

    Null texts and metadata have features of their own. Without views (labels missing or
    of one kind) nothing is rejected: all scores are 1. Input columns of these names are
    replaced; repeated rows are scored alike.
    """
    docs = docs.drop(*ADDED)
    names = docs.columns
    schema = docs.withColumns({c: F.lit(0.0) for c in ADDED[:3]} | {"kept": F.lit(True)}).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            if views is None:
                p = [np.ones(part.num_rows)] * 3
            else:
                p = [x.astype(float) for x in views.scores(
                    content_features(part.column(part.schema.get_field_index("text"))), meta_features(part))]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(part.schema.get_field_index(c)) for c in names],
                 *[pa.array(x) for x in p], pa.array(p[2] >= least)], [*names, *ADDED])

    return docs.mapInArrow(score, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(standard(docs), fitted(docs, labels)).select("doc_id", *ADDED)
