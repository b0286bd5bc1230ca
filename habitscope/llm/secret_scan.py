"""Secrets in text: fixed patterns, and a linear-chain conditional random field.

The field tags tokens O (outside), B (begins a secret) or I (inside one). A token is a run
of letters, digits and ``+ / _ -``; its features are shape, the neighbouring words, the
marks around it and figures of its file. All texts are searched for the patterns first; the
field is trained on token windows of a bounded sample of documents with a match and of
others, tagged by the patterns, by gradient steps on the exact log-likelihood (forward and
backward sums), and decoded by Viterbi over all tokens of all texts.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habitscope.llm.rows import as_scan, at_places, file_rows, least_hashed
from habitscope.llm.words import runs, slices, text_bytes, word_hashes
from habitscope.sources.scratch import settled

LOG = logging.getLogger(__name__)

# The base patterns and the least length of what each must match.
ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
KINDS = ("assign", "access", "hex", "crf")

WINDOW, NEGATIVE_WINDOWS, POSITIVE_WINDOWS = 24, 2, 6
SAMPLE_DOCS = 4000
SEQUENCE = 256
WORDS = 4096
#: Sizes of the feature tables, in the order of ``token_features``.
TABLES = (16, 32, 32, 64, 64, 8, 8, 16, WORDS, WORDS)
BITS = 12


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


LOWER, UPPER = _table(bytes(range(97, 123))), _table(bytes(range(65, 91)))
DIGIT, SYMBOL = _table(b"0123456789"), _table(b"+/_-")
HIGH = _table(bytes(range(128, 256)))
HEX = _table(b"0123456789abcdef")
TOKEN = LOWER | UPPER | DIGIT | SYMBOL | HIGH
COUNTS = sum(t.astype(np.uint64) << np.uint64(BITS * i) for i, t in enumerate((LOWER, UPPER, DIGIT, SYMBOL, HEX)))
CLASS = (LOWER + 2 * UPPER + 3 * DIGIT + 4 * SYMBOL + 5 * HIGH).astype(np.int8)
#: Class of a mark beside a token: blank, =, :, quote, comma or full stop, bracket, other, line end.
MARK = np.full(256, 6, np.int8)
for _chars, _class in ((b" \t\r", 0), (b"=", 1), (b":", 2), (b"\"'`", 3), (b",.;", 4), (b"()[]{}<>", 5), (b"\n", 7)):
    MARK[list(_chars)] = _class


@dataclass
class Tokens:
    """Tokens of a slice: byte spans, row, first token of each row, line starts, features."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    line: np.ndarray
    features: np.ndarray


def _bucket(values: np.ndarray, most: int) -> np.ndarray:
    """1 + floor(log2) of values, 0 for those below one, at most ``most``."""
    return np.clip(np.frexp(values.astype(float))[1], 0, most)


def token_features(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    starts, ends = runs(data, offsets, TOKEN)
    first = np.searchsorted(starts, offsets)
    n, rows = len(starts), len(offsets) - 1
    features = np.zeros((n, len(TABLES)), np.int32)
    line = np.zeros(n, bool)
    if not n:
        return Tokens(starts, ends, first, line, features)
    row = np.repeat(np.arange(rows), np.diff(first))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(COUNTS[data])])
    packed = sums[ends] - sums[starts]
    length = ends - starts
    part = [((packed >> np.uint64(BITS * i)) & np.uint64(2 ** BITS - 1)).astype(np.int64) for i in range(5)]
    for i in np.flatnonzero(length >= 2 ** BITS).tolist():  # beyond the packed counters
        for p, table in zip(part, (LOWER, UPPER, DIGIT, SYMBOL, HEX)):
            p[i] = np.count_nonzero(table[data[starts[i]:ends[i]]])
    lower, upper, digit, symbol, hexed = part
    changes = np.zeros(len(data) + 1, np.int64)
    kind = CLASS[data]
    np.cumsum(kind[1:] != kind[:-1], out=changes[1:len(data)])
    turns = changes[ends - 1] - changes[starts]
    size = _bucket(length, 7)
    high = length - lower - upper - digit - symbol > 0
    features[:, 0] = np.minimum(length, 15)
    features[:, 1] = (lower > 0) + 2 * (upper > 0) + 4 * (digit > 0) + 8 * (symbol > 0) + 16 * high
    features[:, 2] = (hexed == length) * 16 + (digit > 0) * 8 + size
    features[:, 3] = size * 8 + np.minimum(8 * digit // length, 7)
    features[:, 4] = size * 8 + np.minimum(8 * turns // length, 7)
    newline = np.concatenate([[0], np.cumsum(data == 10)])
    begin, end = offsets[row], offsets[row + 1]
    for column, at, ok in ((5, starts - 1, starts > begin), (6, ends, ends < end)):
        features[:, column] = np.where(ok, MARK[data[np.where(ok, at, 0)]], 7)
    before = starts - 2  # a blank beside the token: look one further, for ``= value``
    seen = (features[:, 5] == 0) & (before >= begin)
    features[:, 5] = np.where(seen, np.maximum(features[:, 5], MARK[data[np.where(seen, before, 0)]] % 7), features[:, 5])
    line[0] = True
    line[1:] = newline[starts[1:]] > newline[ends[:-1]]
    line[first[:-1][first[:-1] < n]] = True
    tokens_of = np.maximum(np.diff(first), 1)
    digits_of = np.bincount(row, digit, rows)
    marks = np.concatenate([[0], np.cumsum(data == 61)])
    equal = _bucket(marks[offsets[1:]] - marks[offsets[:-1]], 3)
    share = np.minimum(_bucket(100 * digits_of / np.maximum(np.bincount(row, length, rows), 1), 3), 3)
    features[:, 7] = ((equal + 4 * share) * (tokens_of > 0))[row]
    hashed = (word_hashes(data, starts, ends, fold_case=True) % np.uint64(WORDS - 1) + np.uint64(1)).astype(np.int32)
    features[1:, 8] = np.where(row[1:] == row[:-1], hashed[:-1], 0)
    features[:-1, 9] = np.where(row[1:] == row[:-1], hashed[1:], 0)
    return Tokens(starts, ends, first, line, features)


def base_spans(data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Row -> (start byte, end byte, kind) of the pattern matches, in the row's bytes."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    starts, ends = runs(data, offsets, HEX)
    for i in np.flatnonzero(ends - starts >= LEAST_HEX).tolist():
        row = int(np.searchsorted(offsets, starts[i], "right")) - 1
        found.setdefault(row, []).append((int(starts[i] - offsets[row]), int(ends[i] - offsets[row]), 2))
    marks = np.concatenate([[0], np.cumsum((data == 61) | (data == 58))])
    signs = np.concatenate([[0], np.cumsum(data == 75)])  # K, of AKIA
    for row in np.flatnonzero(np.diff(marks[offsets])).tolist():
        for m in ASSIGN.finditer(data[offsets[row]:offsets[row + 1]].tobytes()):
            if m.end(2) - m.start(2) >= LEAST_ASSIGN:
                found.setdefault(row, []).append((m.start(), m.end(), 0))
    for row in np.flatnonzero(np.diff(signs[offsets])).tolist():
        for m in ACCESS.finditer(data[offsets[row]:offsets[row + 1]].tobytes()):
            if m.end() - m.start() >= LEAST_ACCESS:
                found.setdefault(row, []).append((m.start(), m.end(), 1))
    return found


def base_values(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(row, start, end) of the value of each pattern match, in the bytes of all rows."""
    for row, spans in base_spans(data, offsets).items():
        for a, b, kind in spans:
            if kind == 0:
                m = ASSIGN.match(data[offsets[row] + a:offsets[row] + b].tobytes())
                a += m.start(2) if m else 0
            yield row, int(offsets[row]) + a, int(offsets[row]) + b


def base_tags(data: np.ndarray, offsets: np.ndarray, tokens: Tokens) -> np.ndarray:
    """0, 1, 2 for O, B, I: tokens of which the value of a pattern match is part."""
    tags = np.zeros(len(tokens.starts), np.int8)
    for _, a, b in base_values(data, offsets):
        i = int(np.searchsorted(tokens.ends, a, "right"))
        j = int(np.searchsorted(tokens.starts, b, "left"))
        if i < j and not tags[i:j].any():
            tags[i], tags[i + 1:j] = 1, 2
    return tags


def matches(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``__path``, ``__row`` of every row of the scan ``docs``, and whether a
    pattern match tags a token of it (``matched``)."""
    kept = ["doc_id", "__path", "__row"]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, offsets = text_bytes(part.column(part.schema.get_field_index("text")))
            matched = np.zeros(part.num_rows, bool)
            for row, a, b in base_values(data, offsets):
                matched[row] |= TOKEN[data[a:b]].any()
            yield pa.RecordBatch.from_arrays(
                [*[part.column(part.schema.get_field_index(c)) for c in kept], pa.array(matched)], [*kept, "matched"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return file_rows(docs.select("doc_id", "text")).select(*kept, "text").mapInArrow(
        mark, f"doc_id {kind}, __path string, __row long, matched boolean")


def sample_places(docs: DataFrame, sample: int = SAMPLE_DOCS) -> tuple[DataFrame, int]:
    """Places of ``sample`` documents of the scan ``docs``, and how many of all documents
    match a pattern. Half of the sample match and half do not, each those of least hash;
    where there are fewer of one kind, more of the other."""
    marked = settled(matches(docs), "secret-matches")
    positives = marked.where("matched").count()
    others = marked.count() - positives
    most = max(sample // 2, sample - others)
    key = ("doc_id", "__path", "__row")
    places = least_hashed(marked.where("matched"), most, 1, *key).unionByName(
        least_hashed(marked.where("NOT matched"), sample - min(most, positives), 1, *key))
    return settled(places, "secret-sample"), positives


def training_windows(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Windows of ``WINDOW`` tokens from the rows of the scan ``docs`` at ``places``: up to
    ``POSITIVE_WINDOWS`` of each with a tagged token, ``NEGATIVE_WINDOWS`` at fixed places."""
    chosen = at_places(docs, places)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, offsets = text_bytes(part.column(part.schema.get_field_index("text")))
            tokens = token_features(data, offsets)
            tags = base_tags(data, offsets, tokens)
            rows = []
            for a, b in zip(tokens.first[:-1].tolist(), tokens.first[1:].tolist()):
                positive = (np.flatnonzero(tags[a:b] == 1) + a)[:POSITIVE_WINDOWS].tolist()
                others = [a + (b - a) * k // NEGATIVE_WINDOWS + WINDOW // 2 for k in range(NEGATIVE_WINDOWS)]
                for at in positive + others:
                    i = max(a, min(at - WINDOW // 2, b - WINDOW))
                    if i < b:
                        rows.append((tokens.features[i:min(i + WINDOW, b)].tobytes(), tags[i:min(i + WINDOW, b)].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], ["features", "tags"])

    return chosen.select("text").mapInArrow(cut, "features binary, tags binary")


@dataclass
class Field:
    """Weights: one (values x 3 tags) table per feature, flattened; transitions; first tag.
    ``positives``: documents with a pattern match in the table it was fitted on."""

    emission: np.ndarray
    moves: np.ndarray
    first: np.ndarray
    positives: int = 0


STARTS = np.concatenate([[0], np.cumsum(TABLES)])


def scores(field: Field, features: np.ndarray) -> np.ndarray:
    out = np.zeros((len(features), 3), np.float32)
    for k in range(len(TABLES)):
        out += field.emission[STARTS[k]:STARTS[k + 1]][features[:, k]]
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train(windows: list[tuple[bytes, bytes]], steps: int = 60, rate: float = 0.3, decay: float = 1e-4) -> Field | None:
    """Maximum likelihood by Adam steps over all windows; None without a tagged token."""
    windows = sorted(windows)
    if not any(1 in tags for _, tags in windows):
        return None
    n, width = len(windows), WINDOW
    features, tags = np.zeros((n, width, len(TABLES)), np.int32), np.zeros((n, width), np.int64)
    real = np.zeros((n, width), bool)
    for i, (f, t) in enumerate(windows):
        own = len(t)
        features[i, :own] = np.frombuffer(f, np.int32).reshape(own, -1)
        tags[i, :own], real[i, :own] = np.frombuffer(t, np.int8), True
    flat = features[real] + STARTS[:-1]
    total = int(STARTS[-1])
    forbidden = np.zeros((3, 3))
    forbidden[0, 2] = -1e4
    theta = [np.zeros((total, 3)), np.zeros((3, 3)), np.zeros(3)]
    mean, square = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    gold = np.eye(3)[tags] * real[..., None]
    both = real[:, 1:] & real[:, :-1]
    gold_moves = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:] * both[..., None])
    for step in range(1, steps + 1):
        field = Field(theta[0], theta[1] + forbidden, theta[2] + np.array([0, 0, -1e4]))
        e = np.zeros((n, width, 3))
        e[real] = theta[0][flat].sum(axis=1)
        up, down = np.zeros((n, width, 3)), np.zeros((n, width, 3))
        up[:, 0] = e[:, 0] + field.first
        for t in range(1, width):
            moved = _log_sum(up[:, t - 1, :, None] + field.moves, 1) + e[:, t]
            up[:, t] = np.where(real[:, t, None], moved, up[:, t - 1])
        for t in range(width - 2, -1, -1):
            moved = _log_sum(field.moves + (e[:, t + 1] + down[:, t + 1])[:, None, :], 2)
            down[:, t] = np.where(real[:, t + 1, None], moved, down[:, t + 1])
        z = _log_sum(up[:, -1], 1)
        each = np.exp(up + down - z[:, None, None]) * real[..., None]
        pair = np.exp(up[:, :-1, :, None] + field.moves + (e[:, 1:] + down[:, 1:])[:, :, None, :]
                      - z[:, None, None, None]) * both[..., None, None]
        gap = (gold - each)[real]
        grads = [np.stack([np.bincount(flat.ravel(), np.repeat(gap[:, k], len(TABLES)), total) for k in range(3)], 1),
                 gold_moves - pair.sum(axis=(0, 1)), (gold - each)[:, 0].sum(axis=0)]
        for k, g in enumerate(grads):
            g = g / n - decay * theta[k]
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            theta[k] = theta[k] + rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-6)
    return Field(theta[0].astype(np.float32), (theta[1] + forbidden).astype(np.float32),
                 (theta[2] + np.array([0, 0, -1e4])).astype(np.float32))


@dataclass
class Paths:
    """Best paths of sequences, the longest first: their order, first places, how many are
    at least so long, scores by last tag, and the tag before each tag at each place."""

    order: np.ndarray
    at: np.ndarray
    live: np.ndarray
    best: np.ndarray
    came: list[np.ndarray]


def _forward(field: Field, emitted: np.ndarray, at: np.ndarray, lengths: np.ndarray, entry: np.ndarray) -> Paths:
    """All sequences at a time; ``entry`` has the score of each tag at each one's first place."""
    order = np.argsort(-lengths, kind="stable")
    at, lengths = at[order], lengths[order]
    live = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")
    best = emitted[at] + entry[order]
    came = []
    for t in range(1, len(live)):
        options = best[: live[t], :, None] + field.moves
        back = options.argmax(axis=1).astype(np.int8)
        came.append(back)
        best[: live[t]] = np.take_along_axis(options, back[:, None, :].astype(np.int64), 1)[:, 0] \
            + emitted[at[: live[t]] + t]
    return Paths(order, at, live, best, came)


def _backward(paths: Paths, tag: np.ndarray, chosen: np.ndarray, tags: np.ndarray) -> None:
    """Writes the tags of the ``chosen`` paths that end in ``tag``."""
    tag = tag.copy()
    for t in range(len(paths.live) - 1, -1, -1):
        own = paths.live[t]
        now = tag[:own]
        tags[(paths.at[:own] + t)[chosen[:own]]] = now[chosen[:own]]
        if t:
            tag[:own] = paths.came[t - 1][np.arange(own), now]


def viterbi(field: Field, emitted: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Best tags of sequences that begin at ``begins`` (one more entry than sequences).

    A sequence is gone through in pieces of ``SEQUENCE``, all pieces at a time: those after
    a cut once for each tag before it. Scores carried from piece to piece tell which of
    the three holds, so a cut changes nothing."""
    tags = np.zeros(len(emitted), np.int8)
    sizes = np.diff(begins)
    heads, sizes = begins[:-1][sizes > 0], sizes[sizes > 0]
    if not len(heads):
        return tags
    first = _forward(field, emitted, heads, np.minimum(sizes, SEQUENCE), np.tile(field.first, (len(heads), 1)))
    ends = np.empty_like(first.best)
    ends[first.order] = first.best
    cuts = (sizes - 1) // SEQUENCE
    last = ends.argmax(axis=1)
    if cuts.any():
        base = np.cumsum(cuts) - cuts
        inner = np.arange(cuts.sum()) - np.repeat(base, cuts) + 1
        at = np.repeat(heads, cuts) + inner * SEQUENCE
        lengths = np.minimum(np.repeat(heads + sizes, cuts) - at, SEQUENCE)
        later = _forward(field, emitted, np.repeat(at, 3), np.repeat(lengths, 3), np.tile(field.moves, (len(at), 1)))
        through = np.empty_like(later.best)
        through[later.order] = later.best
        through = through.reshape(-1, 3, 3)
        came = np.zeros((len(at), 3), np.int8)
        for k in range(int(cuts.max())):
            rows = np.flatnonzero(cuts > k)
            options = (ends[rows] - ends[rows].max(axis=1, keepdims=True))[:, :, None] + through[base[rows] + k]
            came[base[rows] + k] = options.argmax(axis=1)
            ends[rows] = options.max(axis=1)
        last = ends.argmax(axis=1)
        ending, entered = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for k in range(int(cuts.max()) - 1, -1, -1):
            rows = np.flatnonzero(cuts > k)
            piece = base[rows] + k
            ending[piece] = last[rows]
            last[rows] = entered[piece] = came[piece, last[rows]]
        _backward(later, np.repeat(ending, 3)[later.order], (later.order % 3) == entered[later.order // 3], tags)
    _backward(first, last[first.order].astype(np.int64), np.ones(len(heads), bool), tags)
    return tags


def field_spans(field: Field, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Row -> (start byte, end byte, 3) of what the field tags, in the row's bytes. A
    sequence is a line."""
    tokens = token_features(data, offsets)
    n = len(tokens.starts)
    if not n:
        return {}
    begins = np.append(np.flatnonzero(tokens.line), n)
    tags = viterbi(field, scores(field, tokens.features), begins)
    opens = np.flatnonzero(tags == 1)
    stops = np.append(np.flatnonzero(tags != 2), n)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for i in opens.tolist():
        j = int(stops[np.searchsorted(stops, i + 1)]) - 1
        a, b = int(tokens.starts[i]), int(tokens.ends[j])
        row = int(np.searchsorted(offsets, a, "right")) - 1
        found.setdefault(row, []).append((a - int(offsets[row]), b - int(offsets[row]), 3))
    return found


def all_spans(field: Field | None, column: pa.Array) -> tuple[np.ndarray, np.ndarray, dict[int, list[tuple[int, int, int]]]]:
    """The bytes and offsets of a column, and each row's spans by start, then kind. What the
    field finds counts unless it lies inside a pattern match."""
    data, offsets = text_bytes(column)
    found = base_spans(data, offsets)
    if field is not None:
        for row, spans in field_spans(field, data, offsets).items():
            base = found.setdefault(row, [])
            base += [s for s in spans if not any(a <= s[0] and s[1] <= b for a, b, _ in base)]
    return data, offsets, {row: sorted(s, key=lambda x: (x[0], x[2], x[1])) for row, s in found.items()}


def _code_points(text: bytes, at: int) -> int:
    return len(text[:at].decode("utf-8", "replace"))


SPANS = "array<struct<kind: string, start: long, end: long>>"


def scanned(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``spans``: kind, start, end in code points.

    A null or empty text has no spans. An input column named ``spans`` is replaced.
    """
    others = [c for c in docs.columns if c not in (text, "spans")]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            data, offsets, found = all_spans(field, part.column(part.schema.get_field_index(text)))
            out: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for row, spans in found.items():
                own = data[offsets[row]:offsets[row + 1]].tobytes()
                out[row] = [{"kind": KINDS[k], "start": _code_points(own, a), "end": _code_points(own, b)}
                            for a, b, k in spans]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(part.schema.get_field_index(c)) for c in others], pa.array(out, kind)],
                [*others, "spans"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.select(*others, text).mapInArrow(scan, f"{fields}{', ' if fields else ''}spans {SPANS}")


def redacted(docs: DataFrame, field: Field | None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark`` (overlapping spans by one)
    and ``n_chars``, where there is such a column, counted anew for changed texts."""
    names = docs.columns

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            at = part.schema.get_field_index("text")
            data, offsets, found = all_spans(field, part.column(at))
            columns = {c: part.column(part.schema.get_field_index(c)) for c in names}
            if found:
                texts = part.column(at).to_pylist()
                for row, spans in found.items():
                    own, out, done = data[offsets[row]:offsets[row + 1]].tobytes(), [], 0
                    for a, b, _ in spans:
                        if a >= done:
                            out += [own[done:a], mark.encode()]
                        done = max(done, b)
                    texts[row] = b"".join([*out, own[done:]]).decode("utf-8", "replace")
                columns["text"] = pa.array(texts, part.column(at).type)
                if "n_chars" in columns:
                    sizes = columns["n_chars"].to_pylist()
                    for row in found:
                        sizes[row] = len(texts[row])
                    columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)

    return docs.mapInArrow(replace, docs.schema)


def fitted(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Field | None:
    """The field trained on a bounded sample of ``docs`` (``doc_id``, ``text``). It is None,
    with a warning, only if no document at all matches a pattern."""
    docs = as_scan(docs)
    places, positives = sample_places(docs, sample)
    if not positives:
        LOG.warning("no document matches a pattern: no random field is fitted, the patterns act alone")
        return None
    field = train([(bytes(r[0]), bytes(r[1])) for r in training_windows(docs, places).collect()])
    if field is not None:
        field.positives = positives
    LOG.info("random field fitted; documents with a pattern match: %d", positives)
    return field


def digest(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """Counts and digests of the spans of each document."""
    docs = docs.select("doc_id", "text")
    label = F.transform("spans", lambda s: F.struct(
        s["kind"].alias("kind"), F.concat_ws(":", s["kind"], s["start"], s["end"]).alias("name")))
    named = scanned(docs, fitted(docs, sample)).withColumn("named", label)
    base = F.filter("named", lambda s: s["kind"] != KINDS[3])

    def count(kind: str) -> Column:
        return F.size(F.filter("named", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column | str) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: s["name"]))

    return named.select(
        "doc_id", *[count(k) for k in KINDS[:3]], F.sha2(joined(base), 256).alias("base_sha256"),
        joined("named").alias("spans"), count(KINDS[3]))
