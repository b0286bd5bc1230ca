"""Where intermediate tables may be written.

The shared folder is the one the session names in ``spark.checkpoint.dir``. Only
when that is unset *and* the master is local (tests, a laptop) is a temporary
folder of this machine used; on a cluster other executors could not see it.
A job that wraps its work in ``cleared`` leaves no table behind.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get(CONF, None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="habitscope-")
    raise RuntimeError(f"set {CONF} to a folder every executor can reach")


_OPEN: list[list[str]] = []


def new_scratch_path(spark: SparkSession, label: str) -> str:
    """A path no other job uses."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for paths in _OPEN:
        paths.append(path)
    return path


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables of a block when it ends, so it must have written its
    outputs by then."""
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield
    finally:
        _OPEN.remove(paths)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def settled(df: DataFrame, label: str) -> DataFrame:
    """The table written once to the shared folder and read back.

    What follows starts from a plain file scan: nothing upstream is computed twice,
    a lost executor costs only its own files' rows, and the many small jobs of an
    iterative fit do not ship a long plan with every task.
    """
    path = new_scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def use_checkpoints(spark: SparkSession) -> None:
    """Point iterative fits at the shared folder, unless the session already did."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
