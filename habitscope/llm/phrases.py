"""Phrase collocations by best-first branch-and-bound growth.

A phrase is 2 to 5 words of one piece (text between stops and line ends). Its score is the
least, over the places where it can be cut in two, of ``1000 * a * n / (l * r)``: ``a``
counts the phrase, ``l`` and ``r`` its parts, ``n`` all words of the language.

Counts of prefixes bound what a prefix can grow into: a phrase that begins with a word met
``f`` times scores at most ``1000 * n / f``, since its other part is met at least as often
as the phrase. So the frontier of first words is expanded best bound first. The first batch
gives each language a floor, the score of its last place so far; the next takes the words
whose bound reaches the floor, and the growth ends when no word is left that does. Within a
batch a prefix grows by a word only if all its shorter parts that are counted are frequent,
and a phrase whose last cut alone scores below the floor is not resolved any further.

Words are 64-bit hashes of language and word (two frequent words share one with a chance
of 1e-19 for each pair of words); all counts are exact group-by counts of Spark. Which words
and prefixes matter reaches the tasks as bit tables of fixed size: a wrong yes there costs a
row that the exact count removes, and a full table only costs speed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habitscope.llm.words import byte_codes, mixed, runs, slices, text_bytes, word_hashes
from habitscope.sources.scratch import settled

# What ends a piece, and what parts its words.
STOPS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"

LONGEST = 5
SEGMENT = 1 << 20
#: Bits of a table of words or prefixes that tasks look at (8 MB).
BITS = 26
#: Bytes of phrases, and words, that a task counts together before they go on.
PHRASE_BYTES, TOGETHER = 1 << 24, 1 << 18
#: Share of a language's frequent words in the first batch.
FIRST_SHARE = 0.5

_STOP = np.zeros(256, bool)
_STOP[list(STOPS)] = True
_INSIDE = ~_STOP
_INSIDE[list(BLANKS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``SEGMENT`` bytes that cut no word."""
    at = 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        if end < len(data):
            outside = np.flatnonzero(~_INSIDE[data[at:end]])
            row = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            cut = max(at + int(outside[-1]) + 1 if len(outside) else 0, row)
            if cut <= at:  # a word of more than a segment
                stop = int(offsets[np.searchsorted(offsets, end, "right")])
                outside = np.flatnonzero(~_INSIDE[data[end:stop]])
                cut = end + int(outside[0]) if len(outside) else stop
            end = cut
        yield at, end
        at = end


def spoken(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For each segment: its lower-cased bytes, and of each word the start, end, row, hash,
    and whether it opens a piece. Memory follows the segment, not the text."""
    last_row, broken = -1, True
    for a, b in _segments(data, offsets):
        local = _LOWER[data[a:b]]
        inner = offsets[(offsets > a) & (offsets < b)] - a
        edges = np.concatenate([[0], inner, [b - a]])
        starts, ends = runs(local, edges, _INSIDE)
        if not len(starts):
            broken |= bool(_STOP[local].any())
            continue
        row = np.searchsorted(offsets, starts + a, "right") - 1
        stops = np.concatenate([[0], np.cumsum(_STOP[local])])
        opens = np.ones(len(starts), bool)
        opens[1:] = (stops[starts[1:]] > stops[ends[:-1]]) | (row[1:] != row[:-1])
        opens[0] = broken or row[0] != last_row or stops[starts[0]] > 0
        broken, last_row = bool(stops[-1] > stops[ends[-1]]), int(row[-1])
        yield local, starts, ends, row, word_hashes(local, starts, ends), opens


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at]))


def _language_codes(column: pa.Array) -> np.ndarray:
    """A 64-bit code of each row's language name."""
    data, offsets = text_bytes(column)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
        byte_codes(False)[data] * (np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets)) + 1).astype(np.uint64))])
    return mixed(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64))


def _word_ids(codes: np.ndarray, row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return np.maximum(mixed(hashes + codes[row]), np.uint64(1))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``id``, ``f`` of every word of every language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "word", "id", "f"]
        held: list[tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
            ids, first, back = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
            sums = np.bincount(back, np.concatenate([h[1] for h in held]), len(ids)).astype(np.int64)
            return ids, sums, *[pa.concat_arrays([h[k] for h in held]).take(pa.array(first)) for k in (2, 3)]

        def batch(part: tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]) -> pa.RecordBatch:
            ids, sums, word, lang = part
            return pa.RecordBatch.from_arrays(
                [lang.cast(pa.string()), word.cast(pa.string()), pa.array(ids.view(np.int64)), pa.array(sums)], names)

        for part in slices(batches):
            langs = part.column(part.schema.get_field_index("lang")).cast(pa.large_string())
            codes = _language_codes(langs)
            for local, starts, ends, row, hashes, _ in spoken(*text_bytes(part.column(part.schema.get_field_index("text")))):
                ids, first, times = np.unique(_word_ids(codes, row, hashes), return_index=True, return_counts=True)
                held.append((ids, times, _strings(local, starts[first], ends[first]), langs.take(pa.array(row[first]))))
            if sum(len(h[0]) for h in held) > TOGETHER:
                held = [merged()]
                if len(held[0][0]) > TOGETHER // 2:
                    yield batch(held.pop())
        if held:
            yield batch(merged())

    return texts.select("lang", "text").mapInArrow(count, "lang string, word string, id long, f long").groupBy(
        "lang", "word").agg(F.min("id").alias("id"), F.sum("f").alias("f"))


# -- tables of bits -------------------------------------------------------------------------------


def phrase_hashes(words: list[np.ndarray]) -> np.ndarray:
    """One hash of each phrase, given the ids of its first, second, ... words."""
    out = np.full(len(words[0]), len(words), np.uint64)
    for w in words:
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + w)
    return out


def bit_table(phrases: DataFrame, bits: int | None = None) -> np.ndarray:
    """2^``bits`` bits with one set for the hash of each phrase (``p``: array of ids).

    Its size is fixed (``BITS``), so the driver gets at most 2^(bits - 6) rows of two numbers."""
    bits = bits or BITS

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            column = part.column(0)
            sizes = np.diff(column.offsets.to_numpy())
            begin, flat = column.offsets.to_numpy()[:-1], column.values.to_numpy(zero_copy_only=False).view(np.uint64)
            slot = np.zeros(len(sizes), np.uint64)
            for m in np.unique(sizes[sizes > 0]).tolist():
                own = np.flatnonzero(sizes == m)
                slot[own] = phrase_hashes([flat[begin[own] + i] for i in range(m)]) >> np.uint64(64 - bits)
            at, back = np.unique(slot >> np.uint64(6), return_inverse=True)
            value = np.zeros(len(at), np.uint64)
            np.bitwise_or.at(value, back, np.uint64(1) << (slot & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64)), pa.array(value.view(np.int64))], ["at", "value"])

    rows = phrases.select(F.col("p").cast("array<long>")).mapInArrow(places, "at long, value long").groupBy("at").agg(
        F.bit_or("value").alias("value")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows.column("at").to_numpy()] = rows.column("value").to_numpy().view(np.uint64)
    return out


def inside(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the table has a bit for each hash."""
    slot = hashes >> np.uint64(64 - (len(table).bit_length() + 5))
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


# -- the corpus as word ids -----------------------------------------------------------------------


def encoded(texts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``ids`` of each document with frequent words (more than one): the ids of these in order,
    with a 0 before each run of them (a stop or another word parts runs)."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            codes = _language_codes(part.column(part.schema.get_field_index("lang")))
            rows, values, last = [], [], None
            for _, _, _, row, hashes, opens in spoken(*text_bytes(part.column(part.schema.get_field_index("text")))):
                ids = _word_ids(codes, row, hashes)
                known = inside(frequent, phrase_hashes([ids]))
                new = opens.copy()
                new[1:] |= ~known[:-1]
                new[0] |= last is not True
                last = bool(known[-1])
                row, ids, new = row[known], ids[known], new[known]
                at = np.arange(len(ids)) + np.cumsum(new)
                flat, owner = np.zeros(len(ids) + int(new.sum()), np.uint64), np.zeros(len(ids) + int(new.sum()), np.int64)
                flat[at], owner[at], owner[at[new] - 1] = ids, row, row[new]
                rows.append(owner)
                values.append(flat)
            if not rows:
                continue
            row, flat = np.concatenate(rows), np.concatenate(values)
            full = np.flatnonzero(np.bincount(row, minlength=part.num_rows) > 2)
            kept = np.isin(row, full)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=part.num_rows)[full])])
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat[kept].view(np.int64)))], ["ids"])

    return texts.select("lang", "text").mapInArrow(encode, "ids array<long>")


#: Given the ids of a batch and a phrase length, whether to count the phrase at each place.
Choice = Callable[[np.ndarray, int], np.ndarray]


def counted(corpus: DataFrame, lengths: tuple[int, ...], choice: Choice, beside: bool = False) -> DataFrame:
    """``p`` and its count ``a`` for the phrases of the given lengths that ``choice`` picks;
    with ``beside`` also the least and greatest word id before and after (0: none)."""
    sides = ["low_before", "high_before", "low_after", "high_after"] if beside else []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {m: [] for m in lengths}

        def compact(m: int) -> np.ndarray:
            """One row for each phrase held: hash, words, count, sides."""
            rows = np.concatenate(held[m])
            rows = rows[np.argsort(rows[:, 0], kind="stable")]
            first = np.flatnonzero(np.append(True, np.diff(rows[:, 0]) != 0)) if len(rows) else np.zeros(0, np.int64)
            out = rows[first]
            for k, fold in enumerate((np.add, np.minimum, np.maximum, np.minimum, np.maximum)[: 1 + len(sides)]):
                if len(first):
                    out[:, 1 + m + k] = fold.reduceat(rows[:, 1 + m + k].astype(np.int64), first).astype(np.uint64)
            return out

        def batch(m: int) -> pa.RecordBatch:
            rows = compact(m)
            held[m].clear()
            ends = np.arange(len(rows) + 1, dtype=np.int32) * m
            phrase = pa.ListArray.from_arrays(pa.array(ends), pa.array(rows[:, 1:1 + m].ravel().view(np.int64)))
            columns = [rows[:, 1 + m + k].astype(np.int64) for k in range(1 + len(sides))]
            return pa.RecordBatch.from_arrays([phrase, *[pa.array(c) for c in columns]], ["p", "a", *sides])

        for part in batches:
            column = part.column(0)
            offsets = column.offsets.to_numpy()
            x = np.append(column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].view(np.uint64), np.uint64(0))
            for m in lengths:
                at = np.flatnonzero(choice(x, m))
                words = [x[at + i] for i in range(m)]
                near = [x[at - 1], x[at - 1], x[at + m], x[at + m]] if beside else []
                held[m].append(np.stack([phrase_hashes(words), *words, np.ones(len(at), np.uint64), *near], 1))
            weight = {m: sum(h.nbytes for h in held[m]) for m in lengths}
            while sum(weight.values()) > PHRASE_BYTES:
                m = max(weight, key=weight.get)
                held[m] = [compact(m)]
                weight[m] = held[m][0].nbytes
                if weight[m] > PHRASE_BYTES // (2 * LONGEST):  # mostly different phrases
                    yield batch(m)
                    weight[m] = 0
        for m in lengths:
            if held[m]:
                yield batch(m)

    schema = "p array<long>, a long" + "".join(f", {s} long" for s in sides)
    folds = [F.sum("a").alias("a"), *[(F.min if s.startswith("low") else F.max)(s).alias(s) for s in sides]]
    return corpus.mapInArrow(count, schema).groupBy("p").agg(*folds)


def _whole(x: np.ndarray, m: int) -> np.ndarray:
    """Places of ``m`` words of one run."""
    out, real = np.zeros(len(x), bool), x != 0
    if len(x) >= m:
        out[: len(x) - m + 1] = reduce(np.logical_and, [real[i:len(x) - m + 1 + i] for i in range(m)])
    return out


def _at(x: np.ndarray, places: np.ndarray, shift: int, m: int) -> np.ndarray:
    return phrase_hashes([x[places + shift + i] for i in range(m)])


def growing(firsts: np.ndarray, shorter: dict[int, np.ndarray]) -> Choice:
    """Phrases that begin with a word of ``firsts``, each of whose shorter parts of a counted
    length (``shorter``) that begins with such a word too is among the frequent ones."""
    def choose(x: np.ndarray, m: int) -> np.ndarray:
        out = _whole(x, m)
        at = np.flatnonzero(out)
        opens = inside(firsts, phrase_hashes([x]))
        good = opens[at]
        at = at[good]
        for size, table in sorted(shorter.items()):
            for shift in range(m - size + 1) if size < m else ():
                at = at[~opens[at + shift] | inside(table, _at(x, at, shift, size))]
        out[:] = False
        out[at] = True
        return out
    return choose


def listed(table: np.ndarray) -> Choice:
    """Phrases that the table has."""
    def choose(x: np.ndarray, m: int) -> np.ndarray:
        out = _whole(x, m)
        at = np.flatnonzero(out)
        out[at] = inside(table, _at(x, at, 0, m))
        return out
    return choose


# -- bounds, scores, rounds -------------------------------------------------------------------------


def _score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 * a * n / (left * right)), exact beyond 64 bits."""
    above = f"CAST(1000 AS DECIMAL(4,0)) * CAST({a} AS DECIMAL(17,0)) * CAST({n} AS DECIMAL(15,0))"
    return F.expr(f"CAST({above} div (CAST({left} AS DECIMAL(18,0)) * CAST({right} AS DECIMAL(18,0))) AS LONG)")


def _bound(words: DataFrame) -> DataFrame:
    """``words`` with ``bound``: no phrase that begins with the word scores more."""
    return words.withColumn("bound", F.expr(
        "CAST(CAST(1000 AS DECIMAL(4,0)) * CAST(n AS DECIMAL(18,0)) div CAST(f AS DECIMAL(18,0)) AS LONG)"))


def first_batch(words: DataFrame, share: float = FIRST_SHARE) -> DataFrame:
    """``lang``, ``floor``: the bound that the best words, up to about ``share`` of a
    language's occurrences, reach. Words are put in order by the power of two of their count."""
    classes = words.groupBy("lang", F.floor(F.log2("f")).alias("c")).agg(
        F.sum("f").alias("f"), F.min("bound").alias("floor"))
    up = Window.partitionBy("lang").orderBy("c")
    so_far = F.sum("f").over(up.rowsBetween(Window.unboundedPreceding, -1))
    all_ = F.sum("f").over(Window.partitionBy("lang"))
    return classes.withColumn("taken", F.coalesce(so_far, F.lit(0)) < share * all_).where("taken").groupBy("lang").agg(
        F.min("floor").alias("floor"))


def floors(found: DataFrame, most: int) -> DataFrame:
    """``lang``, ``floor``: the score of the ``most``-th phrase, where there are so many."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"))
    return found.select("lang", "score", F.row_number().over(order).alias("nth")).where(f"nth <= {most}").groupBy(
        "lang").agg(F.max("nth").alias("nth"), F.min("score").alias("floor")).where(f"nth = {most}").drop("nth")


def _cuts(phrases: DataFrame) -> DataFrame:
    """A row for each cut (``k`` words first) of each phrase, with both parts."""
    parts = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda k: F.struct(
        k.alias("k"), F.slice("p", F.lit(1), k).alias("left"), F.slice("p", k + 1, F.size("p") - k).alias("right")))
    return phrases.select("*", F.explode(parts).alias("cut")).select("*", "cut.*").drop("cut")


def _with_counts(cuts: DataFrame, known: DataFrame) -> DataFrame:
    """``l`` and ``r``, the counts of the parts ``left`` and ``right``."""
    left, right = (known.select(F.col("p").alias(side), F.col("f").alias(name))
                   for side, name in (("left", "l"), ("right", "r")))
    return cuts.join(left, "left").join(right, "right")


def collocations(docs: DataFrame, least: int = 100, most: int = 2000) -> DataFrame:
    """The ``most`` best phrases of each language: ``lang``, ``rank`` (from 1), ``phrase``,
    ``a``, ``l``, ``r``, ``n``, ``score``, and ``cut``, the words of the first part.

    Texts are lower-cased (A-Z). Phrases are met ``least`` times or more. The cut of least
    score counts, of equal ones the first. A phrase goes if a phrase longer by words before
    or behind it is met as often. Order: score and ``a`` descending, phrase ascending by its
    bytes; ties beyond that do not occur, since a phrase is one row.

    A null language is ``und``, a null or empty text has no words, and a repeated row counts
    each time. An empty table, or one without a phrase met so often, gives no rows. Texts are
    gone through in segments, so a text of any length takes the memory of its word ids.
    Other columns of ``docs`` are not looked at.
    """
    texts = _texts(docs)
    tally = settled(word_counts(texts), "word-counts")
    totals = tally.groupBy("lang").agg(F.sum("f").alias("n"))
    words = settled(_bound(tally.where(F.col("f") >= least).join(totals, "lang")), "words")
    single = words.select(F.array("id").alias("p"), "f")
    corpus = settled(encoded(texts, bit_table(single)), "word-ids")

    found = None
    limit, waiting = first_batch(words), words
    while True:
        ready = F.col("bound") >= F.coalesce("floor", F.lit(0))
        batch = settled(waiting.join(limit, "lang", "left").where(ready).drop("floor"), "frontier")
        if batch.isEmpty():
            break
        waiting = settled(waiting.join(batch.select("id"), "id", "left_anti"), "waiting")
        grown, known = _grown(corpus, batch, single, least)
        best = Window.partitionBy("lang").orderBy(F.desc("best"))
        hopeful = grown if found is None else _reaching(grown, limit)
        hopeful = settled(hopeful.withColumn("__place", F.row_number().over(best)).where(
            F.col("__place") <= 2 * most).drop("__place"), "hopeful")
        for _ in range(2):  # the best bounds of the batch, then what reaches their floor
            more = _resolved(corpus, hopeful, known)
            found = settled(more if found is None else found.unionByName(more), "phrases")
            limit = settled(floors(found, most), "floors")
            hopeful = settled(_reaching(grown, limit).join(hopeful.select("p"), "p", "left_anti"), "hopeful")
            if hopeful.isEmpty():
                break

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = words.select("lang", F.lit(None).cast("array<long>").alias("p")).limit(0) if found is None else \
        found.withColumn("__place", F.rank().over(order)).where(F.col("__place") <= most).drop("__place")
    return _spelled(first, words, most)


def _reaching(phrases: DataFrame, limit: DataFrame) -> DataFrame:
    """Phrases whose bound ``best`` reaches their language's floor, if it has one."""
    return phrases.join(limit, "lang", "left").where(F.col("best") >= F.coalesce("floor", F.lit(0))).drop("floor")


def _grown(corpus: DataFrame, batch: DataFrame, single: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The frequent phrases that begin with a word of ``batch``, with ``best``, the score of
    their last cut, which no cut's least exceeds; and the counts known so far."""
    firsts = bit_table(batch.select(F.array("id").alias("p")))
    enough = F.col("a") >= least
    levels, shorter = [], {}
    for lengths in ((2,), (3,), tuple(range(4, LONGEST + 1))):
        level = settled(counted(corpus, lengths, growing(firsts, dict(shorter))).where(enough), "counts")
        levels.append(level)
        if lengths != (LONGEST - 1, LONGEST):
            shorter[lengths[0]] = bit_table(level)
    # A first word that only the bit table takes for one of the batch belongs to another batch.
    own = batch.select(F.col("id").alias("__first"), "lang", "n")
    grown = settled(reduce(DataFrame.unionByName, levels).join(own, F.element_at("p", 1) == F.col("__first")).drop("__first"),
                    "grown")
    known = single.unionByName(grown.select("p", F.col("a").alias("f")))
    last = grown.select("p", "a", "n", "lang", F.slice("p", F.lit(1), F.size("p") - 1).alias("left"),
                        F.slice("p", F.size("p"), F.lit(1)).alias("right"))
    bounded = _with_counts(last, known).withColumn("best", _score("a", "n", "l", "r"))
    return settled(bounded.select("p", "a", "n", "lang", "best"), "bounded"), known


def _resolved(corpus: DataFrame, hopeful: DataFrame, known: DataFrame) -> DataFrame:
    """The surviving ones of ``hopeful``, with their scores."""
    ends = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda k: F.slice("p", k, F.size("p") - k + 1))
    wanted = settled(hopeful.select(F.explode(ends).alias("p")).distinct(), "wanted")
    seen = counted(corpus, tuple(range(2, LONGEST + 1)), listed(bit_table(wanted)), beside=True)
    seen = settled(seen.join(wanted, "p", "left_semi"), "seen")

    counts = known.unionByName(seen.select("p", F.col("a").alias("f"))).distinct()
    longer = (F.col("low_before") == F.col("high_before")) & (F.col("low_before") != 0) \
        | (F.col("low_after") == F.col("high_after")) & (F.col("low_after") != 0)
    alive = hopeful.join(seen.where((F.size("p") == LONGEST) | ~longer).select("p"), "p", "left_semi")
    scored = _with_counts(_cuts(alive), counts).withColumn("score", _score("a", "n", "l", "r"))
    return scored.groupBy("p").agg(
        F.min_by(F.struct("lang", "a", "l", "r", "n", "score", "k"), F.struct("score", "k")).alias("x")).select(
        "p", "x.lang", "x.a", "x.l", "x.r", "x.n", "x.score", F.col("x.k").cast("int").alias("cut"))


def _spelled(first: DataFrame, words: DataFrame, most: int) -> DataFrame:
    """Phrases as words, ranked."""
    if "score" not in first.columns:
        first = first.select("p", "lang", *[F.lit(0).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")],
                             F.lit(0).alias("cut"))
    spelled = (
        first.select("p", F.posexplode("p").alias("at", "id")).join(words.select("id", "word"), "id")
        .groupBy("p").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
        .select("p", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return first.join(spelled, "p").withColumn("rank", F.row_number().over(order).cast("long")).where(
        F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")
