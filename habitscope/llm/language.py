"""Language by a byte convolutional network trained in numpy.

Bytes are embedded, filters of widths 2, 3 and 4 run over windows of 256 bytes, each
filter's maximum over the window goes into a softmax. A text is cut into windows from end
to end; the mean of their log-probabilities, weighted by their bytes, decides.

The first layer sees bytes, a finite alphabet, so for prediction embedding and filters are
multiplied out into tables over byte pairs: the same network as lookups and sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habitscope.llm.rows import as_scan, at_places, file_rows
from habitscope.llm.words import slices, text_bytes
from habitscope.sources.scratch import settled

WINDOW = 256
WIDTHS, FILTERS, EMBEDDED = (2, 3, 4), 16, 8
#: Bounds of the training sample: documents of each language, of all, windows of a document.
PER_LANGUAGE, DOCUMENTS, PER_DOCUMENT = 400, 6000, 3
EPOCHS, BATCH, RATE = 8, 64, 0.004
UNKNOWN = "und"
#: The network sees A-Z as a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
CHUNK_WINDOWS = 512


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray            # 256 x EMBEDDED
    filters: list[np.ndarray]        # for each width: width * EMBEDDED x FILTERS
    bias: np.ndarray                 # all filters
    out: np.ndarray                  # filters x languages
    out_bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.out, self.out_bias]


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all rows (the last of a row ends in zeros), each one's row and bytes."""
    length = np.diff(offsets)
    per_row = -(-length // WINDOW)
    row = np.repeat(np.arange(len(length)), per_row)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)) * WINDOW
    size = np.minimum(length[row] - start, WINDOW)
    out = np.zeros((len(row), WINDOW), np.uint8)
    inside = np.arange(WINDOW) < size[:, None]
    out[inside] = FOLD[data]  # rows are contiguous, so the windows' bytes are the data in order
    return out, row, size


def forward(net: Network, x: np.ndarray):
    """Pooled filter values, where each maximum was, and log-probabilities."""
    e = net.embedding[x]
    pooled, places = [], []
    for width, w in zip(WIDTHS, net.filters):
        n = WINDOW - width + 1
        r = sum(e[:, j:j + n] @ w[j * EMBEDDED:(j + 1) * EMBEDDED] for j in range(width))
        at = r.argmax(axis=1)
        places.append(at)
        pooled.append(np.take_along_axis(r, at[:, None], 1)[:, 0])
    hidden = np.maximum(np.concatenate(pooled, 1) + net.bias, 0)
    return e, places, hidden, log_softmax(hidden @ net.out + net.out_bias)


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    e, places, hidden, logp = forward(net, x)
    n = len(x)
    gap = np.exp(logp)
    gap[np.arange(n), y] -= 1
    gap /= n
    back = (gap @ net.out.T) * (hidden > 0)
    embedding, filters = np.zeros_like(net.embedding), []
    for k, (width, w) in enumerate(zip(WIDTHS, net.filters)):
        g = back[:, k * FILTERS:(k + 1) * FILTERS]
        at = places[k][:, :, None] + np.arange(width)
        rows = np.arange(n)[:, None, None]
        seen = e[rows, at].reshape(n, FILTERS, width * EMBEDDED)
        filters.append(np.einsum("nfd,nf->df", seen, g))
        pulled = (g[:, :, None] * w.T[None]).reshape(-1, EMBEDDED)
        np.add.at(embedding, x[rows, at].reshape(-1), pulled)
    return [embedding, *filters, back.sum(axis=0), hidden.T @ gap, gap.sum(axis=0)]


def train(sample: list[tuple[str, bytes]], epochs: int = EPOCHS, seed: int = 3) -> Network | None:
    """The network fitted to (language, window) pairs; None without any."""
    sample = sorted(sample)
    if not sample:
        return None
    languages = sorted({name for name, _ in sample})
    number = {name: i for i, name in enumerate(languages)}
    y = np.array([number[name] for name, _ in sample])
    x = np.zeros((len(sample), WINDOW), np.uint8)
    for i, (_, part) in enumerate(sample):
        x[i, : len(part)] = FOLD[np.frombuffer(part, np.uint8)]
    rng = np.random.default_rng(seed)
    filters = [rng.normal(0, (w * EMBEDDED) ** -0.5, (w * EMBEDDED, FILTERS)).astype(np.float32) for w in WIDTHS]
    net = Network(languages, rng.normal(0, 1, (256, EMBEDDED)).astype(np.float32), filters,
                  np.zeros(FILTERS * len(WIDTHS), np.float32),
                  rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32),
                  np.zeros(len(languages), np.float32))
    if len(languages) == 1:
        return net
    weights, step = net.parameters(), 0
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    batches = -(-len(x) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for b in range(batches):
            step += 1
            some = order[b * BATCH:(b + 1) * BATCH]
            rate = RATE * (1 - step / (epochs * batches + 1))
            for w, g, m, s in zip(weights, gradients(net, x[some], y[some]), mean, square):
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                w -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return net


class Tables:
    """The trained network for prediction."""

    def __init__(self, net: Network):
        self.net = net
        one = [[(net.embedding @ w[j * EMBEDDED:(j + 1) * EMBEDDED]).astype(np.float32) for j in range(width)]
               for width, w in zip(WIDTHS, net.filters)]

        def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return (a[:, None] + b[None]).reshape(1 << 16, FILTERS)
        self.two = pair(*one[0])
        self.three, self.third = pair(*one[1][:2]), one[1][2]
        self.four, self.last = pair(*one[2][:2]), pair(*one[2][2:])

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.net.languages)), np.float32)
        for i in range(0, len(x), CHUNK_WINDOWS):
            w = x[i:i + CHUNK_WINDOWS]
            pairs = w[:, :-1].astype(np.int32) * 256 + w[:, 1:]
            pooled = [self.two.take(pairs, 0).max(axis=1)]
            r = self.three.take(pairs[:, :-1], 0)
            r += self.third.take(w[:, 2:], 0)
            pooled.append(r.max(axis=1))
            r = self.four.take(pairs[:, :-2], 0)
            r += self.last.take(pairs[:, 2:], 0)
            pooled.append(r.max(axis=1))
            hidden = np.maximum(np.concatenate(pooled, 1) + self.net.bias, 0)
            out[i:i + CHUNK_WINDOWS] = log_softmax(hidden @ self.net.out + self.net.out_bias)
        return out


def held_out() -> Column:
    """crc32 of the doc_id as text is divisible by 5 (never for a null doc_id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def training_windows(docs: DataFrame) -> DataFrame:
    """``lang`` and ``window``: up to PER_DOCUMENT windows of up to PER_LANGUAGE documents of
    each language, DOCUMENTS in all, by least hash of doc_id; held-out rows are left out.
    The choice is made on narrow rows, and their texts are fetched by place."""
    docs = as_scan(docs)
    pool = file_rows(docs).where(
        ~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    ).select("lang", F.xxhash64("doc_id").alias("hash"), "__path", "__row")
    order = Window.partitionBy("lang").orderBy("hash", "__path", "__row")
    places = pool.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= PER_LANGUAGE) \
        .orderBy("nth", "lang").limit(DOCUMENTS)
    chosen = at_places(docs, settled(places, "language-sample")).select("lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, offsets = text_bytes(part.column(part.schema.get_field_index("text")))
            names, found = part.column(part.schema.get_field_index("lang")).to_pylist(), []
            for i, name in enumerate(names):
                a, b = int(offsets[i]), int(offsets[i + 1])
                for at in sorted({a + (b - a - WINDOW) * k // max(PER_DOCUMENT - 1, 1) if b - a > WINDOW else a
                                  for k in range(PER_DOCUMENT)}):
                    found.append((name, data[at:min(at + WINDOW, b)].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in found], pa.string()), pa.array([w for _, w in found], pa.binary())],
                ["lang", "window"])

    return chosen.mapInArrow(cut, "lang string, window binary")


def fitted(docs: DataFrame) -> Network | None:
    return train([(r["lang"], bytes(r["window"])) for r in training_windows(docs).collect()])


def predicted(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score`` (the probability given to it).

    A null text, one without a letter, or no network gives ``und`` with score 0. Input
    columns named lang_pred and score are replaced.
    """
    others = [c for c in docs.columns if c not in ("text", "lang_pred", "score", "__letter")]
    tables: list[Tables] = []

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if net is not None and not tables:
            tables.append(Tables(net))
        for part in slices(batches):
            letter = part.column(part.schema.get_field_index("__letter")).to_numpy(zero_copy_only=False).astype(bool)
            names, score = np.full(part.num_rows, UNKNOWN, object), np.zeros(part.num_rows)
            if tables and letter.any():
                data, offsets = text_bytes(part.column(part.schema.get_field_index("text")))
                x, row, size = windows(data, offsets)
                each = tables[0].log_probabilities(x) * size[:, None]
                total = np.stack([np.bincount(row, each[:, k], part.num_rows) for k in range(each.shape[1])], 1)
                p = np.exp(log_softmax(total / np.maximum(np.diff(offsets), 1)[:, None]))
                names[letter] = np.array(net.languages, object)[p.argmax(axis=1)][letter]
                score[letter] = p.max(axis=1)[letter]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(part.schema.get_field_index(c)) for c in others],
                 pa.array(names, pa.string()), pa.array(np.minimum(score, 1.0), pa.float64())],
                [*others, "lang_pred", "score"])

    rows = docs.select(*others, "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letter"))
    schema = docs.select(*others).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return rows.mapInArrow(predict, schema)


def digest(docs: DataFrame) -> DataFrame:
    """Prediction for every document, learnt from those that are not held out."""
    net = fitted(docs.select("doc_id", "text", "lang"))
    return predicted(docs.select("doc_id", "text", held_out().alias("held_out")), net)
