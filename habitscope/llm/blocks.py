"""Stated queries against all rows, in blocks: helpers of the vector operators.

Rows are dealt into blocks and queries into batches by hashes of their place, so no group
is larger than its expected size, and each pair of batch and block is one task's work. A
block sends on only the best few rows of each query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habitscope.llm.rows import file_rows

#: Least rows of a block and queries of a batch, and bytes of vectors that either may hold.
LEAST_BLOCK, LEAST_BATCH, MOST_BYTES = 4096, 1024, 1 << 25


def finite(vector: str) -> Column:
    """The components as doubles; null for a vector that is null or holds a null or
    non-finite component."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    return F.when(F.forall(parts, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), parts)


def placed(table: DataFrame, *columns: Column) -> DataFrame:
    """The columns of each row of ``table``, and ``place``, a hash of the row's place in its
    file: rows that are alike in all columns still go to different blocks."""
    rows = file_rows(table)
    return rows.select(*columns, F.xxhash64("__path", "__row").alias("place"))


def dealt(rows: DataFrame, questions: DataFrame, width: int, n_rows: int, n_questions: int) -> tuple[DataFrame, DataFrame]:
    """``questions`` and ``rows`` (both with ``place``) with ``batch`` and ``block``: each
    question meets each row in one pair. Sizes follow the table between fixed limits."""
    most = MOST_BYTES // (8 * max(width, 1))
    block = max(LEAST_BLOCK, min(n_rows >> 8, most))
    batch = max(LEAST_BATCH, min(n_questions >> 6, most))
    blocks, batches = max(1, -(-n_rows // block)), max(1, -(-n_questions // batch))

    def side(df: DataFrame, own: str, own_count: int, other: str, other_count: int, salt: int) -> DataFrame:
        number = F.pmod(F.xxhash64(F.lit(salt), "place"), F.lit(own_count)).cast("int")
        out = df.withColumn(own, number).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_count - 1))))
        return out.toDF(*out.columns)  # renamed apart: both sides come from one table

    return side(questions, "batch", batches, "block", blocks, 1), side(rows, "block", blocks, "batch", batches, 2)


def matrix(column: pa.ChunkedArray, width: int, kind: type = np.float64) -> np.ndarray:
    """The lists of a column as rows of ``width``; shorter ones end in zeros."""
    out = np.zeros((len(column), width), kind)
    at = 0
    for chunk in column.chunks:
        offsets = chunk.offsets.to_numpy()
        flat = chunk.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
        sizes = np.diff(offsets)
        row = np.repeat(np.arange(len(chunk)), sizes)
        out[at + row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
        at += len(chunk)
    return out


def longs(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()
