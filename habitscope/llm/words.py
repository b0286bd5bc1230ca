"""Words and tokens of whole Arrow text columns, as numpy arrays.

A word is a run of bytes outside space, tab, line feed, vertical tab, form feed and
carriage return. Everything here runs inside a Spark task on one slice of an Arrow
batch: the UTF-8 buffer of the column is looked at in place, no text becomes a Python
string unless a word is met for the first time.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Text looked at together. The arrays over its bytes and words take some 60 times as much.
SLICE_BYTES = 1 << 18
SEGMENT = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Row slices of about ``SLICE_BYTES`` of text (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        width = 8 if pa.types.is_large_string(column.type) else 4
        ends = np.frombuffer(column.buffers()[1], f"i{width}")[column.offset:][: len(column) + 1] \
            if len(column) else np.zeros(1, np.int64)
        row = 0
        while row < len(column):
            stop = max(row + 1, int(np.searchsorted(ends, int(ends[row]) + SLICE_BYTES, "right")) - 1)
            yield batch.slice(row, stop - row)
            row = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = 8 if pa.types.is_large_string(column.type) else 4
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, f"i{width}")[column.offset:][: len(column) + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[ends[0]:ends[-1]], ends - ends[0]


def runs(data: np.ndarray, offsets: np.ndarray, belongs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of bytes that ``belongs`` (256 booleans) holds
    for; no run crosses a row."""
    inside = belongs[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each row
    (one more entry than rows)."""
    starts, ends = runs(data, offsets, ~IS_SPACE)
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def series(factor: int) -> np.ndarray:
        out = np.full(size, factor, np.uint64)
        out[0] = 1
        return np.cumprod(out)
    return series(MULTIPLIER), series(pow(MULTIPLIER, -1, 1 << 64))


@lru_cache(maxsize=2)
def byte_codes(fold_case: bool) -> np.ndarray:
    """A random 64-bit code for each byte; with ``fold_case`` A-Z have those of a-z."""
    codes = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold_case:
        codes[65:91] = codes[97:123]
    return codes


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool = False) -> np.ndarray:
    """64-bit hash of each word: a polynomial over its bytes' codes by prefix sums,
    segment by segment, so memory does not follow the length of a text."""
    codes, out, i = byte_codes(fold_case), np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = _powers(SEGMENT if b - a <= SEGMENT else b - a)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(codes[data[a:b]] * up[: b - a], out=sums[1:])
        out[i:j] = (sums[ends[i:j] - a] - sums[starts[i:j] - a]) * down[starts[i:j] - a]
        i = j
    return np.maximum(mixed(out + (ends - starts).astype(np.uint64)), np.uint64(1))


# How the public vocabulary file splits lower-cased text into pieces. The
# ranges hold for characters below U+0250; other words go through the tokenizer whole.
LETTERS, NUMBERS = "a-zªµºß-öø-ɏ", "0-9²³¹¼½¾"
PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+").findall
PLAIN = re.compile("[!-~\xa1-ɏ]+").fullmatch


def _byte_letters() -> dict[int, str]:
    """Byte-level spelling: printable bytes stand for themselves, the rest follow U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _room(array: np.ndarray, size: int) -> np.ndarray:
    """``array``, or a longer copy with room for ``size`` values."""
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


class WordTokens:
    """Token ids of words, remembered in an open-addressed table of numpy arrays.

    White space never joins two words in one token with this vocabulary, so the ids of a
    text are those of its words, one after the other. A word costs a tokenizer call only
    when a worker first meets it. ``slots`` bounds the memory; a table that is half full
    starts anew, which changes no result.
    """

    def __init__(self, path: str, slots: int = 1 << 22):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.spelling, self.slots = self.tokenizer.model, _byte_letters(), slots
        self.clear()

    def clear(self) -> None:
        self.keys, self.value = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.int32)
        self.begin, self.ids, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32), 0
        self.pieces: dict[str, list[int]] = {}

    def _piece(self, piece: str) -> list[int]:
        found = self.pieces.get(piece)
        if found is None:
            spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.spelling)
            found = [t.id for t in self.model.tokenize(spelled)]
            if len(self.pieces) < 100_000:
                self.pieces[piece] = found
        return found

    def word_ids(self, word: str) -> list[int]:
        if PLAIN(word):
            return [i for piece in PIECES(word.lower()) for i in self._piece(piece)]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word in the table, or -1."""
        mask, out = self.slots - 1, np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        at = (hashes & np.uint64(mask)).astype(np.int64)
        while len(left):
            there = self.keys[at]
            hit = there == hashes[left]
            out[left[hit]] = self.value[at[hit]]
            go = ~hit & (there != 0)
            left, at = left[go], (at[go] + 1) & mask
        return out

    def _add(self, data, starts, ends, hashes) -> None:
        keys, mask, counts, flat = self.keys, self.slots - 1, [], []
        for a, b, h in zip(starts.tolist(), ends.tolist(), hashes.tolist()):
            ids = self.word_ids(data[a:b].tobytes().decode("utf-8", "replace"))
            at = h & mask
            while keys[at]:
                at = (at + 1) & mask
            keys[at], self.value[at] = h, self.used + len(counts)
            counts.append(len(ids))
            flat += ids
        end = int(self.begin[self.used])
        self.begin, self.ids = _room(self.begin, self.used + len(counts) + 1), _room(self.ids, end + len(flat))
        self.begin[self.used + 1:self.used + 1 + len(counts)] = end + np.cumsum(counts)
        self.ids[end:end + len(flat)] = flat
        self.used += len(counts)

    def _numbers(self, data, starts, ends) -> np.ndarray:
        hashes = word_hashes(data, starts, ends)
        numbers = self._find(hashes)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            if self.used + len(new) > self.slots // 2:
                self.clear()
                missing = np.arange(len(hashes))
                new, first = np.unique(hashes, return_index=True)
                while self.slots < 2 * len(new):
                    self.slots *= 2
                self.clear()
            at = missing[first]
            self._add(data, starts[at], ends[at], new)
            numbers[missing] = self._find(hashes[missing])
        return numbers

    def counts(self, column: pa.Array) -> np.ndarray:
        """Tokens of each row."""
        data, offsets = text_bytes(column)
        starts, ends, first = word_spans(data, offsets)
        numbers = self._numbers(data, starts, ends)
        sums = np.concatenate([[0], np.cumsum(self.begin[numbers + 1] - self.begin[numbers])])
        return sums[first[1:]] - sums[first[:-1]]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and where each row's begin (one more entry than rows)."""
        data, offsets = text_bytes(column)
        starts, ends, first = word_spans(data, offsets)
        numbers = self._numbers(data, starts, ends)
        begin = self.begin[numbers]
        counts = self.begin[numbers + 1] - begin
        sums = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(begin - sums[:-1], counts) + np.arange(sums[-1])]
        return ids, sums[first]


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One table for each Python worker."""
    return WordTokens(path)


def piece_crc(ids: np.ndarray, tail: bytes = b"") -> int:
    """CRC-32 of little-endian unsigned 32-bit ids, then ``tail``."""
    return zlib.crc32(tail, zlib.crc32(np.ascontiguousarray(ids, "<u4")))
