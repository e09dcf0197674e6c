"""Running counts per key, kept as stream state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from syncspark.schemas import TRIGGER_INTERVAL


def count_by_key(
    stream: DataFrame, keys: Sequence[str], checkpoint: str, interval: str | None = TRIGGER_INTERVAL
) -> StreamingQuery:
    """Count the rows of every key of a stream.

    The count is a built-in streaming aggregate: rows of a hot key are summed
    per task before the shuffle, and state holds one row per key. Nothing else
    is written: :func:`current_counts` reads the state itself.
    """
    counts = stream.groupBy(*keys).agg(F.count("*").alias("n"))
    writer = counts.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def current_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Keys and counts as of the last finished batch, read in parallel from the partitions of the state."""
    state = spark.read.format("statestore").load(checkpoint)
    count = state.schema["value"].dataType.names[0]
    return state.select("key.*", F.col(f"value.{count}").alias("n"))
