"""The pipeline stage by stage, each against what its input makes it do."""

import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as P
from habitscope.llm import cotrain, queries
from tests.llm.test_neardup import expected
from tests.llm.test_secrets import base

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The frames before and after each stage, written and read as the pipeline does."""
    queries.importable(spark)
    root, frames = tmp_path_factory.mktemp("stages"), [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in P.STAGES:
        stage(spark, frames[-1], SF).write.parquet(str(root / name))
        frames.append(spark.read.parquet(str(root / name)))
    return frames


def test_stages_have_the_columns_of_documents(stages):
    assert [f.columns for f in stages[:-1]] == [COLUMNS] * 5
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "secrets", "mixing", "packing"]


def test_quality_drops_what_the_views_reject(spark, stages):
    views = cotrain.fitted(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in cotrain.scored(stages[0], views).where("kept").collect()}
    assert {r.doc_id for r in stages[1].collect()} == kept and 0 < len(kept) < stages[0].count()
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    here = {r.doc_id for r in stages[0].collect()}
    assert len(good & here - kept) <= 0.03 * len(good & here)


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = {i for i, (_, c) in expected(rows, 5).items() if i == c}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(want)


def test_secrets_are_gone_and_the_rest_stays(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    after = {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not base(r.text) and r.n_chars == len(r.text)
        if not base(before[i].text) and "[SECRET]" not in r.text:
            assert r == before[i]
        for part in r.text.split("[SECRET]"):
            assert part in before[i].text


def test_mixing_keeps_all_rows(stages):
    assert Counter(stages[3].collect()) == Counter(stages[4].collect())


def test_packing_holds_every_token(stages):
    out = stages[5].collect()
    per = defaultdict(int)
    for r in out:
        per[r.doc_id] += r.length
    assert all(per[r.doc_id] == r.doc_tokens for r in out)
    assert {r.doc_id for r in stages[4].collect()} == set(per)
    filled = defaultdict(int)
    for r in out:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 4096


def test_run_gives_the_last_stage(spark, stages):
    assert P.run(spark, SF).count() == stages[5].count()


def test_pipeline_edges(spark, docs, edges, tmp_path):
    """Nulls, repeated rows and empty texts pass every stage; equal texts leave one."""
    rng = random.Random(1)
    rows = edges + [(None, "same words here and there again now"), (None, "same words here and there again now")]
    rows += [(100 + i, f"plain text number {i} with its own words {rng.random()} {rng.random()}") for i in range(30)]
    table = docs(rows).selectExpr("*", "1 AS label", "2 AS kept", "3 AS position")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    scored = P.quality(spark, read, str(tmp_path))
    assert scored.count() == len(rows)
    one = P.near_duplicates(spark, read, str(tmp_path)).collect()
    texts = Counter(re.sub(r"\s+", " ", (r.text or "").strip()) for r in one)
    assert all(n == 1 for t, n in texts.items() if t)
    assert {t for t in texts if t} == {re.sub(r"\s+", " ", (t or "").strip()) for _, t, *_ in rows} - {""}
    assert P.run(spark, str(tmp_path)).count() > 0


def test_pipeline_of_nothing(spark, docs, tmp_path):
    docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
