import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from habitscope.llm.queries import importable

DOCS = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])


@pytest.fixture
def docs(spark):
    """A documents frame from (doc_id, text[, lang[, source]]) rows."""
    importable(spark)

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
                 None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return build


@pytest.fixture
def table(spark, docs, tmp_path):
    """The same, written as ``documents`` of a folder that a query can read."""
    def build(rows, parts=3):
        docs(rows).repartition(parts).write.parquet(str(tmp_path / "documents.parquet"))
        return str(tmp_path)
    return build


#: Nulls in any column, empty and blank texts, ties and repeated rows, no words, long texts.
EDGES = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two three"), (6, "a b c d e f"),
    (7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, None), (8, "x" * 5000, None, None),
    (9, "Ünïcode ßtraße 漢字 😀 ﬁ ΑΣ İ", "fr", None), (10, "word " * 6000, "de", "src1"),
    (11, "'s don't <|endoftext|> \x85 a b", "en", "src2"), (12, "é x y \x1c z", "en", ""),
]


@pytest.fixture
def edges():
    return list(EDGES)
