"""Session settings that suit wide-table jobs. The caller builds the session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# A 60-80 column projection fused into one generated method passes the size up to
# which the JVM compiles methods (8,000 bytes) and then runs interpreted, several
# times slower. With the limit at that size Spark splits such stages instead.
WIDE_TABLE_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def suit_wide_tables(spark: SparkSession) -> SparkSession:
    """Apply the settings to the running session where it has Spark's defaults."""
    defaults = {"spark.sql.codegen.hugeMethodLimit": "65535"}
    for key, value in WIDE_TABLE_SETTINGS.items():
        if spark.conf.get(key, defaults[key]) == defaults[key]:
            spark.conf.set(key, value)
    return spark


def importable_by_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers of a local session import this package from its source tree; a
    cluster gets it by ``--py-files`` or an installation."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark
