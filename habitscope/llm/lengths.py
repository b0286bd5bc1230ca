"""Exact histogram of encoded lengths, answering every context limit by suffix sums."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from habitscope.llm.words import slices, word_tokens
from habitscope.sources.scratch import settled


def encoded_lengths(docs: DataFrame, vocabulary: str, text: str = "text", end_tokens: int = 1) -> DataFrame:
    """``docs`` without its text, with ``tokens``: ids of the whole text plus ``end_tokens``.

    A null or empty text has ``end_tokens``. ``vocabulary`` is a file every executor has.
    """
    others = [c for c in docs.columns if c not in (text, "tokens")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_tokens(vocabulary)
        for part in slices(batches, text):
            lengths = pa.array(table.counts(part.column(part.schema.get_field_index(text))) + end_tokens, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[part.column(part.schema.get_field_index(c)) for c in others], lengths], [*others, "tokens"])

    schema = docs.select(*others).withColumn("tokens", F.lit(0).cast("long")).schema
    return docs.select(*others, text).mapInArrow(count, schema)


def length_histogram(lengths: DataFrame, tokens: str = "tokens", width: int = 256) -> DataFrame:
    """One row for each length that occurs.

    ``n_docs`` and ``n_tokens`` have that length; ``docs_longer`` and ``tokens_longer`` are
    longer; ``docs_up_to``, ``tokens_up_to`` are not; ``share_up_to`` is the quantile the
    length stands for. With the length as context limit, ``truncated_total`` tokens are
    kept if longer documents are cut there, and ``lost`` are cut off.

    Sums run inside ranges of ``width`` lengths and then over the ranges, so no task sorts
    the whole histogram. The counts are settled, because both read them: texts are encoded
    once. An empty table gives no rows; rows with a null length count nowhere.
    """
    counts = settled(
        lengths.where(F.col(tokens).isNotNull()).groupBy(F.col(tokens).cast("long").alias("length"))
        .agg(F.count("*").alias("n_docs")), "length-counts")
    counts = counts.withColumn("n_tokens", F.col("length") * F.col("n_docs")) \
        .withColumn("__range", F.expr(f"length div {width}"))
    later = Window.orderBy(F.desc("__range")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = (
        counts.groupBy("__range").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
        .select("__range", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"__{c}") for c in "dt"],
                *[F.sum(c).over(every).alias(f"__all_{c}") for c in "dt"])
    )
    inside = Window.partitionBy("__range").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    longer = {c: F.coalesce(F.sum(f"n_{c}").over(inside), F.lit(0)) for c in ("docs", "tokens")}
    return (
        counts.select("*", longer["docs"].alias("__docs"), longer["tokens"].alias("__tokens"))
        .join(ranges, "__range")
        .withColumn("docs_longer", F.col("__docs") + F.col("__d"))
        .withColumn("tokens_longer", F.col("__tokens") + F.col("__t"))
        .select(
            "length", "n_docs", "n_tokens", "docs_longer", "tokens_longer",
            (F.col("__all_d") - F.col("docs_longer")).alias("docs_up_to"),
            (F.col("__all_t") - F.col("tokens_longer")).alias("tokens_up_to"),
            ((F.col("__all_d") - F.col("docs_longer")) / F.col("__all_d")).alias("share_up_to"),
            (F.col("__all_t") - F.col("tokens_longer") + F.col("length") * F.col("docs_longer")).alias("truncated_total"),
            (F.col("tokens_longer") - F.col("length") * F.col("docs_longer")).alias("lost"),
        )
    )
