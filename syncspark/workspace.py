"""Staged tables in the shared folder of the cluster.

A staged table cuts lineage the way a checkpoint does, but is columnar: later
steps read only the columns they need, and a lost executor loses nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# Folders of the open scratch blocks, the innermost last.
_scratch: ContextVar[tuple[str, ...]] = ContextVar("scratch", default=())


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Without the setting it is the session's checkpoint folder. Only a local
    session without either gets a folder below the warehouse; on a cluster a
    missing setting is an error, since nothing else is known to be shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark)}/syncspark/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    The table stays until its folder is deleted, or until the end of the
    surrounding :func:`scratch` block; with ``keep`` it outlives the innermost
    block, as the result of the job that the block holds.
    """
    spark = df.sparkSession
    open_blocks = _scratch.get()
    roots = open_blocks[:-1] if keep else open_blocks
    path = f"{roots[-1]}/{label}-{uuid.uuid4().hex}" if roots else new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """:func:`stage`, with the number of rows, counted while they are written."""
    counted = Observation()
    staged = stage(df.observe(counted, F.count(F.lit(1)).alias("n")), label)
    return staged, counted.get["n"]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when it ends.

    For the body of a micro-batch or a finished job: frames that read staged
    tables must be used up, staged with ``keep`` or written elsewhere, before
    the block ends.
    """
    root = new_path(spark, "scratch")
    token = _scratch.set((*_scratch.get(), root))
    try:
        yield
    finally:
        _scratch.reset(token)
        delete(spark, root)


def _path(spark: SparkSession, path: str):
    """A path and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all its contents, if it is there."""
    found, files = _path(spark, path)
    files.delete(found, True)


def matching(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Paths that match a pattern, with the time of their last change."""
    found, files = _path(spark, pattern)
    return [(s.getPath().toString(), s.getModificationTime()) for s in files.globStatus(found) or ()]


def mark(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    found, files = _path(spark, path)
    files.create(found, True).close()
