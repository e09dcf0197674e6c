"""Change log to topic: number, publish, compare by number, resend.

Progress through the log is the stream's own checkpoint. The last number used
is kept per batch, so numbering goes on across restarts, and travels inside
each message, so sender and receiver cannot drift apart.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from syncspark.functions.messages import encode
from syncspark.operators.sequence import SEQ, assign_sequence, missing_by_number
from syncspark.schemas import TRIGGER_INTERVAL
from syncspark.sources.readers import read_topic
from syncspark.streaming.batches import (
    forget_batches,
    last_batch,
    read_batch,
    read_batches,
    start,
    write_batch,
    write_values,
)
from syncspark.workspace import scratch, stage

TOPIC = T.StructType([T.StructField("value", T.StringType(), True)])
PROGRESS = T.StructType([T.StructField("last_seq", T.LongType(), True)])
_NUMBER = T.StructType([T.StructField(SEQ, T.LongType(), True)])

Publish = Callable[[DataFrame, int], None]


class Topic(Protocol):
    """Where messages go: frames with a column ``value``, batch by batch."""

    def publish(self, messages: DataFrame, batch_id: int) -> None:
        """First send of a batch; a replayed batch sends the same messages again."""

    def publish_again(self, messages: DataFrame, batch_id: int) -> None:
        """Messages of a batch that did not arrive."""

    def arrived(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Column ``value`` of what the first send of a batch left in the topic."""


_OFFSETS = T.StructType([T.StructField("offsets", T.StringType(), True)])


def offsets_after(records: DataFrame, known: str | None = None) -> str:
    """Position behind the records of a topic, as the queue's ``startingOffsets``; partitions without records keep the known one.

    One row per partition of the topic goes to the driver.
    """
    out = json.loads(known) if known else {}
    ends = records.groupBy("topic", "partition").agg(F.max("offset").alias("last"))
    for row in ends.toLocalIterator():
        out.setdefault(row["topic"], {})[str(row["partition"])] = row["last"] + 1
    return json.dumps(out, sort_keys=True)


class SourceTopic:
    """A topic behind one of Spark's own formats, such as a message queue.

    Messages carry their batch as ``key``, resent ones with a suffix, so the
    records of one batch are found among others. ``read`` are the options of a
    bounded read. With ``positions``, a folder, each batch notes where the topic
    ended for it, and the next one reads from there instead of from the beginning;
    a replayed batch reads from where its first attempt did.
    """

    def __init__(self, source: str, write: Mapping[str, str], read: Mapping[str, str], positions: str | None = None):
        self.source, self.write, self.read, self.positions = source, dict(write), dict(read), positions

    def _send(self, messages: DataFrame, key: str) -> None:
        keyed = messages.select(F.lit(key).alias("key"), "value")
        keyed.write.format(self.source).options(**self.write).mode("append").save()

    def publish(self, messages: DataFrame, batch_id: int) -> None:
        self._send(messages, str(batch_id))

    def publish_again(self, messages: DataFrame, batch_id: int) -> None:
        self._send(messages, f"{batch_id}-again")

    def _begin(self, spark: SparkSession, batch_id: int) -> str | None:
        """Where the last finished batch before this one ended."""
        last = last_batch(spark, self.positions) if self.positions else None
        if last is not None and last >= batch_id:
            last = batch_id - 1
        if last is None or last < 0:
            return None
        return read_batch(spark, self.positions, last, _OFFSETS).first()["offsets"]

    def arrived(self, spark: SparkSession, batch_id: int) -> DataFrame:
        begin = self._begin(spark, batch_id)
        options = {**self.read, **({"startingOffsets": begin} if begin else {})}
        records = read_topic(spark, options, self.source)
        if self.positions:
            write_values(spark, self.positions, batch_id, offsets=offsets_after(records, begin))
            # A replay needs the position of the batch before.
            forget_batches(spark, self.positions, batch_id - 1)
        return records.filter(F.col("key").cast("string") == str(batch_id)).select(F.col("value").cast("string").alias("value"))


class FileTopic:
    """A folder used as a topic, with one partition per batch; for tests and small installations."""

    def __init__(self, path: str):
        self.sent = f"{path}/sent"
        self.resent = f"{path}/resent"

    def publish(self, messages: DataFrame, batch_id: int) -> None:
        write_batch(messages.select("value"), self.sent, batch_id)

    def publish_again(self, messages: DataFrame, batch_id: int) -> None:
        write_batch(messages.select("value"), self.resent, batch_id)

    def arrived(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What the first send of one batch left in the topic.

        Resent messages are not counted: a replayed batch writes them anew.
        """
        return read_batch(spark, self.sent, batch_id, TOPIC)

    def read(self, spark: SparkSession) -> DataFrame:
        return read_batches(spark, self.sent, TOPIC).union(read_batches(spark, self.resent, TOPIC)).select("value")


def numbers_of(topic: DataFrame) -> DataFrame:
    """Sequence numbers found in the messages of a topic."""
    return topic.select(F.from_json("value", _NUMBER).alias("data")).select(f"data.{SEQ}").filter(
        F.col(SEQ).isNotNull()
    )


def resend_missing(sent: DataFrame, received: DataFrame) -> DataFrame:
    """Messages of the sent records whose number did not arrive."""
    return encode(missing_by_number(sent, received))


def send_and_resend(numbered: DataFrame, batch_id: int, topic: Topic, publish: Publish | None = None) -> None:
    """Publish numbered records and resend what did not arrive.

    ``numbered`` is read for the send and for the resend: a staged table, whose
    rows are the same each time.
    """
    (publish or topic.publish)(encode(numbered), batch_id)
    arrived = numbers_of(topic.arrived(numbered.sparkSession, batch_id))
    topic.publish_again(resend_missing(numbered, arrived), batch_id)


def last_number(numbered: DataFrame, done: int) -> int:
    """The greatest number of staged records, ``done`` if there are none."""
    return numbered.agg(F.coalesce(F.max(SEQ), F.lit(done))).first()[0]


def _last_number(spark: SparkSession, progress_path: str, batch_id: int) -> int:
    """Last number of the batch before; read from its own folder only."""
    if batch_id == 0:
        return 0
    return read_batch(spark, progress_path, batch_id - 1, PROGRESS).first()["last_seq"]


def capture(
    log: DataFrame,
    topic: Topic,
    progress_path: str,
    checkpoint: str,
    order: Sequence[str],
    publish: Publish | None = None,
    interval: str | None = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Publish a change-log stream and resend what does not arrive.

    ``publish`` replaces the first send. Progress of earlier batches than the
    last two is deleted. The batch is staged first, so its source is read once.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = _last_number(spark, progress_path, batch_id)
        with scratch(spark):
            numbered = stage(assign_sequence(stage(batch, "batch"), order, start=done), "numbered")
            send_and_resend(numbered, batch_id, topic, publish)
            last = last_number(numbered, done)
        write_values(spark, progress_path, batch_id, last_seq=F.lit(last).cast("long"))
        forget_batches(spark, progress_path, batch_id - 1)

    return start(log, handle, checkpoint, interval)
