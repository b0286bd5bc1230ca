"""Tokens, packing and the length histogram against the tokenizer itself."""

import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from habitscope.llm import lengths, pack, queries, words

SF = "/root/testdata/sf0.001"
PATH = queries.vocabulary()


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_ids_of_odd_texts(tokenizer, edges):
    texts = [t for _, t, *_ in edges] + ["a's 'S x'll", "ǅ ŉ ª²¼", "\x00\x01 \x1f\x1e", "Σ ς ΑΣ.", " a　b"]
    ids, begins = words.WordTokens(PATH, slots=16).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[begins[i]:begins[i + 1]].tolist() == ids_of(tokenizer, text)[:-1], repr(text)[:80]


TABLE = words.WordTokens(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=6))
def test_ids_of_any_text(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    ids, begins = TABLE.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[begins[i]:begins[i + 1]].tolist() == TABLE.tokenizer.encode(text, add_special_tokens=False).ids
    assert TABLE.counts(pa.array(texts, pa.string())).tolist() == np.diff(begins).tolist()


def test_word_hashes_tell_words_apart(monkeypatch):
    monkeypatch.setattr(words, "SEGMENT", 64)
    words._powers.cache_clear()
    texts = ["the The THE", "x" * 300 + " the", "the", "", "eht hte"]
    data, offsets = words.text_bytes(pa.array(texts))
    starts, ends, first = words.word_spans(data, offsets)
    seen = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert seen == [w.encode() for t in texts for w in t.split()]
    assert first.tolist() == [0, 3, 5, 6, 6, 8]
    hashes = words.word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(seen))
    folded = words.word_hashes(data, starts, ends, fold_case=True)
    assert len(set(folded.tolist())) == len({w.lower() for w in seen})
    words._powers.cache_clear()


def check_packing(rows, documents, tokenizer, sequence):
    """Each id lies in one piece; sequences have no gaps and fit."""
    ids = defaultdict(list)
    for doc_id, text in documents:
        ids[doc_id].append(ids_of(tokenizer, text))
    want = Counter()
    for doc_id, lists in ids.items():
        for full in lists:
            for start in range(0, len(full), sequence):
                part = full[start:start + sequence]
                want[doc_id, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(full)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= sequence
    return sum(r.length for r in rows) / (sequence * max(len(filled), 1))


def test_query_packs_every_document(spark, tokenizer):
    rows = queries.op6_packing(spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert check_packing(rows, docs, tokenizer, 4096) > 0.9


def test_pack_edges(docs, edges, tokenizer):
    rows = pack.pack(docs(edges).selectExpr("*", "1 AS length", "2 AS offset"), PATH, sequence=64, unit=4,
                     keep_ids=True).collect()
    check_packing(rows, [(i, t) for i, t, *_ in edges], tokenizer, 64)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    assert pack.pack(docs([]), PATH).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_patterns_cover_the_demand(seed):
    rng = np.random.default_rng(seed)
    demand = rng.integers(0, 60, 64) * (rng.random(64) < 0.6)
    used = pack.solve(demand)
    assert (sum(p * n for p, n in used) == demand).all()
    size = np.arange(1, 65)
    assert all((p * size).sum() <= 64 for p, _ in used)
    assert sum(n for _, n in used) <= first_fit_decreasing(demand) + 2


def first_fit_decreasing(demand):
    room = []
    for k in range(len(demand), 0, -1):
        for _ in range(int(demand[k - 1])):
            at = next((i for i, left in enumerate(room) if left >= k), None)
            if at is None:
                room.append(len(demand) - k)
            else:
                room[at] -= k
    return len(room)


def test_histogram_against_brute_force(spark, docs, edges, tokenizer):
    texts = edges + [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(80).collect()]
    counts = [len(ids_of(tokenizer, t)) for _, t, *_ in texts]
    rows = lengths.length_histogram(lengths.encoded_lengths(docs(texts), PATH), width=16).collect()
    assert sorted(r.length for r in rows) == sorted(set(counts))
    for r in rows:
        same, up_to = [c for c in counts if c == r.length], [c for c in counts if c <= r.length]
        cut = sum(min(c, r.length) for c in counts)
        assert (r.n_docs, r.n_tokens) == (len(same), sum(same))
        assert (r.docs_up_to, r.tokens_up_to) == (len(up_to), sum(up_to))
        assert (r.docs_longer, r.tokens_longer) == (len(counts) - len(up_to), sum(counts) - sum(up_to))
        assert (r.truncated_total, r.lost) == (cut, sum(counts) - cut)
        assert r.share_up_to == len(up_to) / len(counts)


def test_histogram_of_nothing(docs):
    assert lengths.length_histogram(lengths.encoded_lengths(docs([]), PATH)).count() == 0


def test_histogram_query(spark):
    rows = queries.op10_token_counts(spark, SF).collect()
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert sum(r.n_docs for r in rows) == n and max(r.docs_up_to for r in rows) == n
