"""Sharding and mixing against brute force."""

import math
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from habitscope.llm import mix, queries, shard

SF = "/root/testdata/sf0.001"


def check_shards(rows, k):
    per = defaultdict(list)
    for r in rows:
        per[r.shard].append(r.slot)
    sizes = [len(per[i]) for i in range(k)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in per.values())


def test_query_shards_every_document(spark):
    out = queries.op9_sharding(spark, SF).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(out) == len(docs)
    for r in out:
        data = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    check_shards(out, 24)


def permutation(n, seed, rounds=6):
    """The same permutation in plain Python."""
    side, keys, out = max(1, math.isqrt(max(n - 1, 0)) + 1), shard.round_keys(seed, rounds), []
    for x in range(n):
        while True:
            left, right = divmod(x, side)
            for k in keys:
                v = (right * shard.FACTOR + k) % shard.PRIME
                left, right = right, (left + (v * v + k) % shard.PRIME % side) % side
            x = left * side + right
            if x < n:
                break
        out.append(x)
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 999])
def test_places_are_the_permutation(spark, n):
    out = shard.sharded(spark.range(n), 7, seed=3).collect()
    expected = permutation(n, 3)
    assert sorted(expected) == list(range(n))
    assert all(r.shard + 7 * r.slot == expected[r.row_number] for r in out)
    assert sorted(r.row_number for r in out) == list(range(n))
    check_shards(out, 7) if n >= 7 else None


def test_shard_edges(docs, edges):
    out = shard.sharded(docs(edges).selectExpr("*", "1 AS slot", "2 AS extra"), 4).collect()
    assert len(out) == len(edges) and "extra" in out[0].asDict()
    check_shards(out, 4)
    assert shard.sharded(docs([]), 4).count() == 0


def test_shard_plan_has_no_python_and_no_shuffle_of_rows(spark):
    plan = queries.op9_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def check_mix(rows, weights, block):
    """Positions are gapless; every queue is less than a block off its share while it lasts."""
    assert sorted(r.position for r in rows) == list(range(len(rows)))
    by_slot = {}
    for r in rows:
        assert by_slot.setdefault(r.slot, r.queue) == r.queue
    sizes = Counter(r.queue for r in rows)
    blocks = {q: -(-n // block) for q, n in sizes.items()}
    last = {q: max(s for s, o in by_slot.items() if o == q) for q in blocks}
    given = Counter()
    for slot in range(max(by_slot) + 1):
        if slot in by_slot:
            given[by_slot[slot]] += 1
        for q in blocks:
            if slot <= last[q]:
                assert abs(given[q] - weights[q] * (slot + 1)) < 1
    assert given == blocks
    order = sorted(rows, key=lambda r: r.position)
    assert [r.slot for r in order] == sorted(r.slot for r in order)


def test_mix_of_the_test_table(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mix.mixed(table, block=2).collect()
    sizes = Counter(r.queue for r in rows)
    slots = mix.whole_slots([sizes[q] ** 0.5 for q in sorted(sizes)], 1024)
    check_mix(rows, {q: s / 1024 for q, s in enumerate(slots)}, 2)


@pytest.mark.parametrize("weights", [{"a": 0.7, "b": 0.2, None: 0.1}, {"a": 1, "b": 1, None: 5}])
def test_mix_with_given_weights(docs, weights):
    table = docs([(i, f"t{i}", "en", ["a", "b", "a", None, "a"][i % 5]) for i in range(300)])
    rows = mix.mixed(table, weights=weights, block=3, period=64).collect()
    queue = {r.source: r.queue for r in rows}
    slots = mix.whole_slots([weights[s] for s in sorted(queue, key=queue.get)], 64)
    check_mix(rows, {q: s / 64 for q, s in enumerate(slots)}, 3)


@pytest.mark.parametrize("weights", [
    [0.9, 0.04, 0.03, 0.03], [1] * 20, [0.97] + [0.03 / 49] * 49, [0.9] + [0.1 / 255] * 255, [2 ** 0.5, 3 ** 0.5, 1e-4]])
def test_lag_is_below_one_block_of_the_weights_asked_for(weights):
    """Over several periods of 1024 slots, against the exact target weights."""
    slots, total = 5 * 1024, sum(Fraction(str(w)) for w in weights)
    share = [Fraction(str(w)) / total for w in weights]
    given = [0] * len(weights)
    for q, k, slot in mix.turns([slots] * len(weights), mix.exact_shares(weights)):
        if slot == slots:
            break
        assert k == given[q] and math.floor(k / share[q]) <= slot < math.ceil((k + 1) / share[q])
        given[q] += 1
    assert sum(given) == slots
    assert all(abs(n - w * slots) < 1 for n, w in zip(given, share))


def test_mix_keeps_the_weights_asked_for_over_periods(docs):
    table = docs([(i, f"t{i}", "en", "abcd"[0 if i < 4600 else i % 4]) for i in range(5000)])
    rows = mix.mixed(table, weights={"a": 0.9, "b": 0.04, "c": 0.03, "d": 0.03}, block=1).collect()
    queue = {r.source: r.queue for r in rows}
    check_mix(rows, {queue["a"]: 0.9, queue["b"]: 0.04, queue["c"]: 0.03, queue["d"]: 0.03}, 1)


def test_sources_without_a_weight_come_last(docs, monkeypatch):
    monkeypatch.setattr(mix, "PIECE", 7)
    table = docs([(i, f"t{i}", "en", "abcd"[i % 4]) for i in range(80)])
    rows = sorted(mix.mixed(table, weights={"a": 3, "c": 1, "d": 0}, block=2).collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(80))
    assert {r.source for r in rows[:40]} == {"a", "c"} and {r.source for r in rows[40:]} == {"b", "d"}


def test_mix_edges(docs, edges):
    out = mix.mixed(docs(edges).selectExpr("*", "0 AS position", "1 AS extra"), block=2)
    assert sorted(r.position for r in out.collect()) == list(range(len(edges)))
    assert mix.mixed(docs([])).count() == 0
    assert mix.in_mixed_order(docs([])).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_more_sources_than_queues(docs, monkeypatch):
    monkeypatch.setattr(mix, "MAX_QUEUES", 4)
    out = mix.mixed(docs([(i, "t", "en", f"s{i % 9}") for i in range(90)]), block=1).collect()
    assert sorted(r.position for r in out) == list(range(90)) and {r.queue for r in out} == {0, 1, 2, 3}


@pytest.mark.parametrize("given", [False, True])
def test_every_one_of_many_sources_has_its_own_turns(docs, given):
    """More sources than the 256 queues there once were, each below one block off."""
    table = docs([(i, f"t{i}", "en", f"s{i % 300 if i < 1500 else i % 7}") for i in range(2200)])
    weights = {f"s{i}": 0.7 if i == 299 else 0.001 * (1 + i % 3) for i in range(300)} if given else None
    rows = mix.mixed(table, weights=weights, block=1).collect()
    name = {r.queue: r.source for r in rows}
    sizes = Counter(r.queue for r in rows)
    assert len(name) == len({r.source for r in rows}) == 300
    wanted = {q: weights[name[q]] if given else n ** 0.5 for q, n in sizes.items()}
    total = sum(wanted.values())
    share = {q: w / total for q, w in wanted.items()}
    for r in rows:
        assert math.floor(r.block / share[r.queue] - 1e-6) <= r.slot < math.ceil((r.block + 1) / share[r.queue] + 1e-6)
    assert sorted(r.position for r in rows) == list(range(2200))
    assert len({r.slot for r in rows}) == 2200


def test_mixed_order_is_the_row_order(spark, docs, tmp_path):
    table = docs([(i, f"t{i}", "en", "ab"[i % 3 == 0]) for i in range(500)])
    position = {r.doc_id: r.position for r in mix.mixed(table, block=4).collect()}
    mix.in_mixed_order(table, block=4).write.parquet(str(tmp_path / "m"))
    files = sorted(p for p in (tmp_path / "m").iterdir() if p.name.startswith("part"))
    ids = [r.doc_id for f in files for r in spark.read.parquet(str(f)).collect()]
    assert [position[i] for i in ids] == list(range(500))


@pytest.mark.parametrize("broadcast", [0, 1 << 18])
def test_mixed_order_moves_texts_once(spark, docs, tmp_path, monkeypatch, broadcast):
    """Rows that differ only beside id and text, null sources and ids: all stay, in order, over several files."""
    monkeypatch.setattr(mix, "BROADCAST_LIMITS", broadcast)
    monkeypatch.setattr(mix, "FILE_BYTES", 300)
    rows = [(i if i % 50 else None, f"text {i}", "en", (None, "a", "b", "c", "c")[i % 5]) for i in range(400)]
    rows += [(7, "same", f"l{i % 3}", "a") for i in range(60)] + [(8, None, "en", "b")] * 5
    docs(rows).repartition(3).write.parquet(str(tmp_path / "in"))
    table = spark.read.parquet(str(tmp_path / "in"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        out = mix.in_mixed_order(table, block=4)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert plan.count("Exchange shufflepartitionidpassthrough") == 1 and "rangepartitioning" not in plan
    assert ("Exchange hashpartitioning" not in plan) == bool(broadcast)
    out.write.parquet(str(tmp_path / "m"))
    names = sorted(p for p in (tmp_path / "m").iterdir() if p.name.startswith("part"))
    assert len(names) > 5
    found = [r for f in names for r in spark.read.parquet(str(f)).collect()]
    wanted = [r for r in sorted(mix.mixed(table, block=4).collect(), key=lambda r: r.position)]
    assert [tuple(r) for r in found] == [tuple(r)[:5] for r in wanted]
