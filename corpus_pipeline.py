"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of documents.

1. quality: co-trained scores; documents below one half go.
2. near_duplicates: of each group of similar documents the one with the least doc_id stays.
3. secrets: spans of secrets are replaced in the text by a mark.
4. mixing: the rows in the order of the Pfair mix of sources, which is the order of the
   files and of the rows in them.
5. packing: pieces of at most 4096 tokens, ranked in that order, placed in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from habitscope.llm import cotrain, mix, neardup, pack, secret_scan, shard
from habitscope.llm.queries import importable, vocabulary
from habitscope.llm.rows import as_scan, file_rows, picked
from habitscope.sources.scratch import settled

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers keep. Without labels of both kinds all
    stay; rows with null text or metadata are scored like others."""
    labels = importable(spark).read.parquet(f"{sf_dir}/labels.parquet")
    docs = docs.select(*COLUMNS)
    views = cotrain.fitted(docs, labels)
    return cotrain.scored(docs, views).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, 0.8). Documents without words
    are in no group. A row without doc_id stands for itself and stays only if no row with
    one is in its group; of rows equal in doc_id and text one stays."""
    importable(spark)
    docs = as_scan(docs.select(*COLUMNS))
    unnamed = F.shiftrightunsigned(F.xxhash64("__path", "__row"), 2) + F.lit(1 << 62)
    named = file_rows(docs).select(F.coalesce("doc_id", unnamed).alias("doc_id"), "text")
    found = neardup.near_duplicates(named).where("kept").select(F.col("doc_id").alias("__id"), "text_hash", "row_number")
    table, rows = shard.numbered(docs)
    once = F.row_number().over(Window.partitionBy("__id", "text_hash").orderBy("n_chars", "source", "lang", "row_number"))
    first = found.join(table.select("row_number", "n_chars", "source", "lang"), "row_number").withColumn(
        "__nth", once).where("__nth = 1")
    return picked(table, first.select("row_number"), rows).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced; null texts stay null."""
    importable(spark)
    docs = docs.select(*COLUMNS)
    return secret_scan.redacted(docs, secret_scan.fitted(docs.select("doc_id", "text")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in the order of the mix; a null source is a source."""
    return mix.in_mixed_order(docs.select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with sequence and offset; see ``pack.pack``."""
    importable(spark)
    return pack.pack(shard.in_row_order(docs.select("doc_id", "text")), vocabulary())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

#: Training, MinHash and tokens are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs
