"""CSV and Parquet tables, temp views, scoped caching, and job observations."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header. With a schema there is no inference pass over the data, and
    the header must name the same columns in the same order (the read fails if it
    does not); without one the types are inferred, which is one extra full read."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string; types are cast later."""
    return spark.read.option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Directory of part files with headers, replacing what was there."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make the table available to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return df


@contextmanager
def kept_in_memory(df: DataFrame) -> Iterator[DataFrame]:
    """Persist for the duration of a block (spilling to disk) and release after it."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
