"""Streams with durable progress, and what their micro-batches write.

Appending streams go to Spark's own file sink, whose log says which files count.
A batch that has to be handled by a function of its own replaces its partition,
so a replayed batch ends with its rows once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from syncspark.schemas import TRIGGER_INTERVAL
from syncspark.workspace import delete, matching

BATCH = "batch_id"
_DONE = "_SUCCESS"


def _numbers(spark: SparkSession, path: str, file: str = "") -> list[int]:
    found = matching(spark, f"{path}/{BATCH}=*{file}")
    return [int(p.rsplit(f"{BATCH}=", 1)[1].split("/")[0]) for p, _ in found]


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch as its partition, in place of what an earlier attempt left there."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches, with the number of the batch as last column."""
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType(), True)])
    if not matching(spark, f"{path}/{BATCH}=*"):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def read_batch(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """One finished batch, without listing the folders of the others."""
    if not is_finished(spark, path, batch_id):
        raise ValueError(f"no finished batch {batch_id} in {path}")
    return spark.read.schema(schema).parquet(f"{path}/{BATCH}={batch_id}")


def is_finished(spark: SparkSession, path: str, batch_id: int) -> bool:
    return bool(matching(spark, f"{path}/{BATCH}={batch_id}/{_DONE}"))


def last_batch(spark: SparkSession, path: str) -> int | None:
    """Number of the last finished batch."""
    return max(_numbers(spark, path, f"/{_DONE}"), default=None)


def forget_batches(spark: SparkSession, path: str, before: int) -> None:
    """Delete the batches before a number."""
    for number in _numbers(spark, path):
        if number < before:
            delete(spark, f"{path}/{BATCH}={number}")


def write_values(spark: SparkSession, path: str, batch_id: int, **values: object) -> None:
    """One row of plain values, as the state a batch leaves behind."""
    row = spark.range(0, 1, 1, 1).select(*(F.lit(value).alias(name) for name, value in values.items()))
    write_batch(row, path, batch_id)


def _started(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = TRIGGER_INTERVAL,
    output_mode: str = "append",
) -> StreamingQuery:
    """Run ``handle`` per micro-batch with durable progress.

    Without an interval the stream takes what is there now and stops.
    """
    return _started(stream.writeStream.foreachBatch(handle).outputMode(output_mode), checkpoint, interval)


def append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    interval: str | None = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Append a stream to a folder through Spark's file sink.

    The sink notes the files of each finished batch and compacts its notes, so
    readers see every batch once and whole, also after a batch that was killed.
    """
    writer = stream.writeStream.format("parquet").option("path", path).outputMode("append")
    return _started(writer.partitionBy(*partition_by) if partition_by else writer, checkpoint, interval)


def appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What :func:`append` has finished; empty before its first batch."""
    if not matching(spark, f"{path}/_spark_metadata/*"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
