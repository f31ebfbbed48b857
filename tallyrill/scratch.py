"""Written intermediate tables in the shared folder the cluster names.

A table written here is read back as plain Parquet: its lineage is cut, it survives the loss of
any executor, later passes read only the columns they need, and its size on storage is known to
the optimizer, so join strategies rest on measured sizes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_fallback: str | None = None
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only for unset local sessions."""
    global _local_fallback
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_fallback is None:
        _local_fallback = tempfile.mkdtemp(prefix="tallyrill-")
    return _local_fallback


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/tallyrill/{label}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Run the plan of ``df`` one time and return a scan of the written result."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    scope = _written.get()
    if scope is not None:
        scope.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove the tables written inside, and only those; no frame that reads them may be used afterwards.

    Runs side by side in threads of one driver each have their own scope.
    """
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in paths:
            target = hadoop.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each statement as it ends, not when the driver collects garbage.

    What is written inside is read from storage afterwards, never from the shuffle before it. A session that has
    the setting keeps it.
    """
    if spark.conf.get(_CLEAN, None) is not None:
        yield
        return
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEAN)
