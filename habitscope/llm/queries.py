"""The queries over the test tables, one for each operator, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from habitscope.llm import (
    codes, cotrain, language, lengths, mix, neardup, negatives, pack, phrases, rules, rules_sql, secret_scan, shard, topk)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Rows of an Arrow batch. Ten thousand documents in a batch, going and coming, take hundreds
#: of MB beside the heap.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers of a local session import this package from its source tree; a
    cluster gets it by ``--py-files`` or an installation. Texts go to them in small batches."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    if int(spark.conf.get(ARROW_ROWS, "10000")) == 10000:  # Spark's default
        spark.conf.set(ARROW_ROWS, "512")
    return spark


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    table = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    return table.select(*columns) if columns else table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-trained quality score of every document."""
    return cotrain.digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weak-supervision verdict on every document."""
    return rules.digest(documents(spark, sf_dir, "doc_id", "text"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the byte network."""
    return language.digest(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector with all others."""
    table = importable(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(table, F.col("vec_id") % 20 == 0)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern and random-field spans of secrets in every text."""
    return secret_scan.digest(documents(spark, sf_dir, "doc_id", "text"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cutting-stock packing of all documents into sequences of 4096 tokens."""
    return pack.pack(documents(spark, sf_dir, "doc_id", "text"), vocabulary())


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 4-word shingles are similar by 0.8 or more."""
    return neardup.near_duplicates(documents(spark, sf_dir, "doc_id", "text"), size=4).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the mix of sources, weights tempered by a square root."""
    return mix.mixed(documents(spark, sf_dir)).select(
        "doc_id", "source", "queue", "block", "slot", "position")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard (of 24) and slot."""
    return shard.digest(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length histogram of all documents with answers for every context limit."""
    return lengths.length_histogram(
        lengths.encoded_lengths(documents(spark, sf_dir, "doc_id", "text"), vocabulary()))


def op11_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors by cosine of every 50th vector."""
    table = importable(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    return codes.nearest(table, F.col("vec_id") % 50 == 0)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language."""
    return phrases.collocations(documents(spark, sf_dir, "text", "lang"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every 50th vector."""
    table = importable(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table.withColumn("label", label), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality, op2_quality_rules, op3_language, op4_top_k, op5_secrets, op6_packing,
        op7_near_duplicates, op8_mixing, op9_sharding, op10_token_counts, op11_one_bit_codes, op12_collocations,
        op13_hard_negatives)
}
ORACLES: dict[str, str] = {
    "op2_quality_rules": rules_sql.oracle(),
    "op4_top_k": """
WITH w AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM w q JOIN w c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op7_near_duplicates": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4
      THEN list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM w
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), e AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2
  ) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * common >= 80 * (na.n + nb.n - common)
), r AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT e.b, r.root FROM r JOIN e ON e.a = r.node
), c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c ON c.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
""",
    "op12_collocations": r"""
WITH p AS MATERIALIZED (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents)
), g AS (
  SELECT lang, m, list_slice(w, i, i + m - 1) AS p FROM (
    SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS m)
  )
), f AS MATERIALIZED (SELECT lang, m, p, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100
), n AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang
), c AS (SELECT lang, p, f AS a, m, unnest(range(1, m)) AS k FROM f WHERE m > 1
), s AS (
  SELECT c.lang, c.p, c.a, c.m, c.k, x.f AS l, y.f AS r, n.n,
    (1000::HUGEINT * c.a * n.n) // (x.f::HUGEINT * y.f) AS score
  FROM c JOIN n ON n.lang = c.lang
    JOIN f x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, c.k)
    JOIN f y ON y.lang = c.lang AND y.p = list_slice(c.p, c.k + 1, c.m)
), b AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inner_ AS (
  SELECT DISTINCT lang, f AS longer, list_slice(p, i, i + z - 1) AS p FROM (
    SELECT lang, p, f, m, z, unnest(range(1, m - z + 2)) AS i FROM f, (SELECT unnest([2, 3, 4]) AS z) WHERE z < m
  )
), alive AS (
  SELECT b.* FROM b WHERE NOT EXISTS (
    SELECT 1 FROM inner_ i WHERE i.lang = b.lang AND i.p = b.p AND 100 * i.longer >= 100 * b.a)
), r AS (
  SELECT *, array_to_string(p, ' ') AS phrase FROM alive
), o AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM r
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score, CAST(k AS INT) AS cut
FROM o WHERE rank <= 2000
""",
    "op13_hard_negatives": """
WITH w AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM w a JOIN w b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS positive_rank
  FROM s WHERE same QUALIFY positive_rank <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score,
  CAST(positive_rank AS INT) AS positive_rank
FROM n WHERE rank <= 3
""",
}
