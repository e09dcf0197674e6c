"""Message stream to a table of accepted and a table of refused messages."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from syncspark.functions.messages import accepted, decode
from syncspark.operators.reconcile import compare, missing
from syncspark.operators.project import tag
from syncspark.schemas import MESSAGE, MESSAGE_REQUIRED, TRIGGER_INTERVAL
from syncspark.sources.sinks import Sink
from syncspark.streaming.batches import append, appended, start
from syncspark.workspace import delete, mark, matching, scratch, stage

ACCEPTED = "accepted"


def _with_refused(decoded: DataFrame) -> DataFrame:
    """One frame for one write: fields, and text and reason where refused."""
    refused = F.col("reason").isNotNull()
    return decoded.select(
        "data.*", F.when(refused, F.col("value")).alias("value"), "reason", (~refused).alias(ACCEPTED)
    )


def sync_messages(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    schema: T.StructType = MESSAGE,
    required: Sequence[str] = MESSAGE_REQUIRED,
    lenient: bool = False,
    interval: str | None = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Parse a message stream and append it to a folder.

    Each message is parsed once; accepted and refused ones go to different
    partitions of the same write, so readers of either skip the other's files.
    """
    decoded = decode(raw, schema, required, lenient=lenient)
    return append(_with_refused(decoded), path, checkpoint, (ACCEPTED,), interval)


def _kept(schema: T.StructType) -> T.StructType:
    extra = T.StructType(
        [
            T.StructField("value", T.StringType()),
            T.StructField("reason", T.StringType()),
            T.StructField(ACCEPTED, T.BooleanType()),
        ]
    )
    return T.StructType([*schema.fields, *extra.fields])


def synced(spark: SparkSession, path: str, schema: T.StructType = MESSAGE) -> DataFrame:
    return appended(spark, path, _kept(schema)).filter(ACCEPTED).select(*schema.names)


def refused(spark: SparkSession, path: str, schema: T.StructType = MESSAGE) -> DataFrame:
    return appended(spark, path, _kept(schema)).filter(~F.col(ACCEPTED)).select("value", "reason")


def deliver_once(marked: DataFrame, sink: Sink, run_id: str, ledger: str | None = None) -> None:
    """Append the marked rows of a run to a sink without transactions.

    Only what the sink does not yet hold of this run is appended, so a replay
    after a half-finished write completes it instead of repeating it. With a
    ``ledger`` folder, which notes what was begun and finished, the sink is read
    back only for a run that was begun and not finished.
    """
    spark = marked.sparkSession
    entry = None if ledger is None else f"{ledger}/{quote(run_id, safe='')}/{quote(sink.name, safe='')}"
    noted = set() if entry is None else {path.rsplit(".", 1)[1] for path, _ in matching(spark, f"{entry}.*")}
    if "finished" in noted:
        return
    if entry is not None and not noted:
        mark(spark, f"{entry}.begun")
        todo = marked
    else:
        held = sink.read_run(spark, run_id)
        todo = marked if held.isEmpty() else missing(compare(marked, held))
    sink.write(todo.select(*marked.columns), "append")
    if entry is not None:
        mark(spark, f"{entry}.finished")


def sync_messages_to(
    raw: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    stream_name: str,
    schema: T.StructType = MESSAGE,
    required: Sequence[str] = MESSAGE_REQUIRED,
    interval: str | None = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Parse a message stream once and append accepted rows to every sink.

    The ledger of deliveries lies beside the checkpoint; entries of batches
    before the last one are deleted, as only the last can be replayed.
    """
    ledger = f"{checkpoint.rstrip('/')}-delivered"

    def handle(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{stream_name}-{batch_id}"
        with scratch(batch.sparkSession):
            marked = stage(tag(accepted(decode(batch, schema, required)), run_id), "batch")
            for sink in sinks:
                deliver_once(marked, sink, run_id, ledger)
        if batch_id > 0:
            delete(batch.sparkSession, f"{ledger}/{quote(f'{stream_name}-{batch_id - 1}', safe='')}")

    return start(raw, handle, checkpoint, interval)
