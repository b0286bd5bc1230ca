"""Near-duplicate groups by circulant MinHash, banding and exact verification.

Two random permutations of a hashed universe make every signature coordinate: the first
scatters a document's shingles, the second is shifted circularly by k for coordinate k, so
a shingle's K values are K neighbours in one array. Bands of coordinates are bucketed.

Copies with equal shingle sets are one class, named by the number of its first row. In each bucket every class is compared with
a pivot on full sets, and several pivot orders keep a bucket from hanging on one class.
Classes of a bucket that are not yet in one component are then compared exactly: pair by
pair in small buckets; in large ones those outside the largest component go against all,
in blocks of bounded size whose intersections are counted at once, so pairs never become
rows. Components are found by alternating large and small stars. Nothing per document
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habitscope.llm.rows import picked
from habitscope.llm.shard import numbered
from habitscope.llm.words import mixed, slices, text_bytes, word_hashes, word_spans
from habitscope.sources.scratch import settled

UNIVERSE = 1 << 20
BANDS, BAND_ROWS = 32, 5
CHUNK = 8192
#: Buckets of so many classes are compared in blocks of these sizes.
LARGE, STRAY_BLOCK, BLOCK = 16, 512, 2048
#: Masks that order the classes of a bucket in different ways; the least of an order is a pivot.
ORDERS = [0, 0x155A3C6E9B1F2D47, 0x2AA5C3916470E2B8, 0x7F0F5A3387C1D96E]


@lru_cache(maxsize=1)
def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and the windows of the shifted one."""
    rng = np.random.default_rng(20210909)
    scatter = rng.permutation(UNIVERSE).astype(np.int32)
    shifted = rng.permutation(UNIVERSE).astype(np.uint32)
    width = BANDS * BAND_ROWS
    shifted = np.concatenate([shifted, shifted[:width]])
    return scatter, np.lib.stride_tricks.sliding_window_view(shifted, width)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text: ``size`` words, A-Z lower-cased;
    a shorter text is one shingle of all its words, one without words has none."""
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends, fold_case=True)
    odd = mixed(np.arange(1, size + 2, dtype=np.uint64)) | np.uint64(1)
    windows = np.zeros(len(hashes), np.uint64)
    for i in range(size):
        windows[: max(len(hashes) - i, 0)] += hashes[i:] * odd[i]
    windows = mixed(windows)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(windows[a:b - size + 1])
        elif b > a:
            yield mixed((hashes[a:b] * odd[: b - a]).sum(keepdims=True) + odd[size:] * np.uint64(b - a))
        else:
            yield windows[:0]


def signature(shingles: np.ndarray) -> np.ndarray:
    """All coordinates of a set: minima over its shingles' windows."""
    scatter, windows = permutations()
    at = scatter[(shingles >> np.uint64(44)).astype(np.int64)]
    out = windows[at[:CHUNK]].min(axis=0)
    for i in range(CHUNK, len(at), CHUNK):
        out = np.minimum(out, windows[at[i:i + CHUNK]].min(axis=0))
    return out


def band_keys(sign: np.ndarray) -> np.ndarray:
    rows = sign.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    weights = mixed(np.arange(1, BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    return mixed((rows * weights).sum(axis=1) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``row_number``, ``text_hash``, ``n_shingles``, a 128-bit set digest ``hi``,
    ``lo``, ``bands``."""
    given = ("doc_id", "row_number", "text_hash")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            n, digests, bands = [], [], []
            for s in shingle_sets(part.column(part.schema.get_field_index("text")), size):
                n.append(len(s))
                digests.append((mixed(s).sum(), mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum()) if len(s) else (0, 0))
                bands.append(band_keys(signature(s)) if len(s) else np.zeros(0, np.uint64))
            both = np.array(digests, np.uint64).view(np.int64).reshape(-1, 2)
            ends = np.concatenate([[0], np.cumsum([len(b) for b in bands])]).astype(np.int32)
            keys = pa.array(np.concatenate(bands).view(np.int64) if bands else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(part.schema.get_field_index(c)) for c in given], pa.array(n, pa.int64()),
                 pa.array(both[:, 0]), pa.array(both[:, 1]), pa.ListArray.from_arrays(pa.array(ends), keys)],
                [*given, "n_shingles", "hi", "lo", "bands"])

    return docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        sketch, "doc_id long, row_number long, text_hash long, n_shingles long, hi long, lo long, bands array<long>")


def sets_of(docs: DataFrame, size: int) -> DataFrame:
    """``id`` and full ``shingles`` of each row of ``docs`` (``id``, ``text``)."""
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = [s.view(np.int64) for s in shingle_sets(part.column(part.schema.get_field_index("text")), size)]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("id")),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["id", "shingles"])

    return docs.mapInArrow(collect, "id long, shingles array<long>")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) of every node of ``edges`` (a, b),
    by alternating large and small stars over written tables."""
    now = settled(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("low"))
        large = both.join(low, "x").where("y > x").select(F.col("y").alias("u"), F.col("low").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        now = settled(
            large.join(least, "u")
            .select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("u"),
                    F.col("low").alias("v")).distinct(), "edges")
        seen = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if seen == mark:
            break
        mark = seen
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _enough(common: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * common >= percent * (n + m - common)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    first = sets.select(F.col("id").alias("a"), F.col("shingles").alias("s"))
    second = sets.select(F.col("id").alias("b"), F.col("shingles").alias("t"))
    common = F.size(F.array_intersect("s", "t"))
    return pairs.join(first, "a").join(second, "b").where(
        _enough(common, F.size("s"), F.size("t"), percent)).select("a", "b")


def _open(members: DataFrame) -> DataFrame:
    """Members of the buckets that still hold more than one component."""
    split = members.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q")
    return members.join(split.select("key"), "key", "left_semi")


def _shared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``id``, ``shared``: how many of its shingles another of the ``members`` has too. No
    intersection can be larger, which bounds similarity before any pair is formed."""
    here = sets.join(members.select("id").distinct(), "id", "left_semi")
    alone = (
        here.select("id", F.explode("shingles").alias("shingle"))
        .groupBy("shingle").agg(F.min("id").alias("id"), F.count("*").alias("times")).where("times = 1")
        .groupBy("id").agg(F.count("*").alias("alone"))
    )
    return here.select("id", F.size("shingles").cast("long").alias("size")).join(alone, "id", "left").select(
        "id", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("shared"))


def _links_in_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components inside the buckets ``key``: every class outside a
    bucket's largest component against every class of another component. Blocks are
    numbered by a hash of the id; how many a bucket has follows its size."""
    parts = members.groupBy("key", "part").agg(F.count("*").alias("n"))
    shape = parts.groupBy("key").agg(
        F.max(F.struct("n", "part")).alias("most"), F.sum("n").alias("n")).select(
        "key", F.col("most.part").alias("major"),
        F.ceil((F.col("n") - F.col("most.n")) / STRAY_BLOCK).cast("int").alias("stray_blocks"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(shape, "key")

    def block(count: str, salt: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    strays = placed.where("part <> major").withColumn("x", block("stray_blocks", 1)).withColumn("y", each("blocks"))
    every = placed.withColumn("y", block("blocks", 2)).withColumn("x", each("stray_blocks"))
    columns = ("id", "key", "x", "y", "part", "shingles")
    strays, every = (  # renamed apart: both sides of the cogroup come from one table
        f.select("key", "x", "y", "id", "part").join(sets, "id").select(*columns).toDF(*columns) for f in (strays, every))

    def compare(some: pd.DataFrame, all_: pd.DataFrame) -> pd.DataFrame:
        found: list[np.ndarray] = []
        if len(some) and len(all_):
            sizes = all_.shingles.map(len).to_numpy()
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            values, codes = np.unique(np.concatenate(all_.shingles.to_list()), return_inverse=True)
            ids, part = all_.id.to_numpy(), all_.part.to_numpy()
            for row in some.itertuples():
                at = np.minimum(np.searchsorted(values, row.shingles), len(values) - 1)
                own = np.zeros(len(values), np.int64)
                own[at[values[at] == row.shingles]] = 1
                common = np.add.reduceat(own[codes], starts)
                near = (100 * common >= percent * (len(row.shingles) + sizes - common)) & (part != row.part)
                found.append(np.stack([np.full(near.sum(), row.id), ids[near]], 1))
        both = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        return pd.DataFrame({"a": both.min(axis=1), "b": both.max(axis=1)}) if len(both) else \
            pd.DataFrame({"a": both[:, 0], "b": both[:, 1]})

    keys = ["key", "x", "y"]
    return strays.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInPandas(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``text_hash`` (xxhash64) and
    ``row_number`` for each row of ``docs`` (``doc_id``, ``text``).

    Documents are linked if their sets of ``size``-word shingles have a Jaccard similarity
    of ``percent`` / 100 or more. ``component_id`` is the least doc_id reachable, ``kept``
    says that it is the row's own. A null, empty or blank text is linked with nothing.
    Texts are linked, not ids: of rows with one doc_id each has the component of its own text,
    so one of them can be kept where another is a duplicate. A row without doc_id belongs to
    the component of its set's other rows and is not kept; a set of such rows alone is linked
    with nothing, its component_id is null and it is kept. An empty table gives no rows.
    Missing a link takes 32 failed bands of 5: a chance of 3e-6 at exactly 0.8, less above.
    """
    docs, n_rows = numbered(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    rows = settled(sketches(docs, size), "sketches")
    classes = settled(
        rows.where("n_shingles > 0").groupBy("hi", "lo").agg(
            F.min("doc_id").alias("least"), F.min("row_number").alias("id"),
            F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    buckets = classes.where("least IS NOT NULL").select("id", "n", F.posexplode("bands").alias("band", "key"))
    mask = F.element_at(F.array(*[F.lit(m).cast("long") for m in ORDERS]), F.col("band") % len(ORDERS) + 1)
    pivots = buckets.groupBy("band", "key").agg(
        F.min(F.col("id").bitwiseXOR(mask)).alias("least"), F.count("*").alias("members")).where("members > 1") \
        .select("key", F.col("least").bitwiseXOR(mask).alias("pivot"))
    members = settled(buckets.drop("band").join(pivots, "key"), "members")
    tested = settled(members.where("id <> pivot").select(
        F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct(), "tested")
    texts = picked(docs, members.select(F.col("id").alias("row_number")), n_rows)
    sets = settled(sets_of(texts.select(F.col("row_number").alias("id"), "text"), size), "sets")
    links = settled(_confirmed(tested, sets, percent), "links")

    found = components(links)
    part = members.join(found, F.col("id") == F.col("node"), "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("part"))
    open_ = settled(_open(part), "open")
    shared = _shared(open_, sets)
    able = settled(_open(open_.join(shared, "id").where(_enough(F.col("shared"), F.col("n"), F.col("shared"), percent))),
                   "able")
    size_of = able.groupBy("key").agg(F.count("*").alias("members"))
    able = settled(able.join(size_of, "key"), "sized")
    left, right = (able.where(f"members < {LARGE}").select("key", *[F.col(c).alias(f"{c}_{s}") for c in (
        "id", "n", "part", "shared")]) for s in "ab")
    rest = left.join(right, "key").where(
        (F.col("part_a") != F.col("part_b")) & (F.col("id_a") < F.col("id_b"))
        & _enough(F.least("shared_a", "shared_b"), F.col("n_a"), F.col("n_b"), percent)
    ).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")
    blocks = _links_in_blocks(able.where(f"members >= {LARGE}").select("key", "id", "part"), sets, percent)
    more = settled(_confirmed(rest, sets, percent).unionByName(blocks), "links")
    if not more.isEmpty():
        found = components(links.unionByName(more))

    labelled = classes.join(found, F.col("id") == F.col("node"), "left").select(
        "hi", "lo", "least", F.coalesce("component", "id").alias("part"))
    least = labelled.groupBy("part").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "part").select("hi", "lo", "component_id", F.lit(True).alias("known"))
    return rows.drop("bands").join(named, ["hi", "lo"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("doc_id").eqNullSafe(F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))).alias("kept"),
        "text_hash", "row_number")
