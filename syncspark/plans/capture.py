"""Rounds over a change log that can only be read as a table.

For logs in a database, which have no stream of their own. A round first writes
down its numbered rows, then publishes them, then notes that it is done: a
round that is run again after a failure sends the same rows under the same
numbers, however the log has grown meanwhile.
"""

from __future__ import annotations

import time as clock
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from syncspark.operators.incremental import LOG_TIME, Cursor, is_after, next_cursor, rows_after
from syncspark.operators.reconcile import compare, missing
from syncspark.operators.sequence import SEQ, assign_sequence
from syncspark.streaming.batches import (
    forget_batches,
    is_finished,
    last_batch,
    read_batch,
    write_batch,
    write_values,
)
from syncspark.streaming.capture import Publish, Topic, last_number, send_and_resend
from syncspark.workspace import matching, scratch, stage

STATE = T.StructType(
    [
        T.StructField("cursor", T.StringType()),
        T.StructField("cursor_key", T.LongType()),
        T.StructField("last_seq", T.LongType()),
    ]
)
PAUSE_SECONDS = 1.0


def state_after(spark: SparkSession, state_path: str) -> tuple[int, Cursor, int]:
    """Last finished round, its cursor and its last number; -1 before the first."""
    done = last_batch(spark, f"{state_path}/done")
    if done is None:
        return -1, Cursor(), 0
    row = read_batch(spark, f"{state_path}/done", done, STATE).first()
    return done, Cursor(row["cursor"] or None, row["cursor_key"]), row["last_seq"]


def _pulled(log: DataFrame, cursor: Cursor, key: str, time: str, overlap: str | None) -> DataFrame:
    """Rows past the cursor, or late within ``overlap`` of it, and rows without a time, in one scan.

    Both conditions are on the stored column, so files and row groups without
    such rows are skipped.
    """
    return log.filter(is_after(log, cursor, time, key, overlap) | F.col(time).isNull())


def _not_published(timed: DataFrame, state_path: str, done: int, overlap: str | None) -> DataFrame:
    """Rows that the rounds before have not published, whole rows compared and copies counted."""
    if overlap is None or done < 0:
        return timed
    seen = read_batch(timed.sparkSession, f"{state_path}/seen", done, timed.schema)
    return missing(compare(timed, seen)).select(*timed.columns)


def _set_aside_null_times(nulls: DataFrame, time: str, folder: str | None) -> None:
    """Raise for rows without a time, or keep those not yet kept in ``folder``, copies counted."""
    if nulls.isEmpty():
        return
    if folder is None:
        raise ValueError(f"the log has rows without {time}; name a folder for them")
    spark = nulls.sparkSession
    held = spark.read.schema(nulls.schema).parquet(folder) if matching(spark, f"{folder}/*") else spark.createDataFrame([], nulls.schema)
    absent = stage(missing(compare(nulls, held)).select(*nulls.columns), "null-times")
    if not absent.isEmpty():
        absent.write.mode("append").parquet(folder)


def capture_round(
    log: DataFrame,
    topic: Topic,
    state_path: str,
    key: str,
    time: str = LOG_TIME,
    publish: Publish | None = None,
    overlap: str | None = None,
    null_times: str | None = None,
) -> Cursor:
    """One round: publish what was not published yet, resend what is lost, keep the position.

    The job finds the last finished round itself, in ``state_path``. Rows that
    commit with a time of up to ``overlap`` (an interval such as ``10 minutes``)
    before the cursor are still published; without it they are lost, so set it
    to the longest time a transaction takes. Rows are told apart by all their
    columns, copies counted, so several changes of one key at one time are all
    published. Rows without a time have no place in the log: they fail the round, or
    are kept in the folder ``null_times``, as often as the log holds them.
    Errors of the source are raised, so no round passes for an empty one.
    """
    spark = log.sparkSession
    done, cursor, last = state_after(spark, state_path)
    number, rows_path = done + 1, f"{state_path}/rows"
    numbered_schema = T.StructType([*log.schema.fields, T.StructField(SEQ, T.LongType())])
    with scratch(spark):
        if not is_finished(spark, rows_path, number):
            pulled = stage(_pulled(log, cursor, key, time, overlap), "pulled")
            _set_aside_null_times(pulled.filter(F.col(time).isNull()), time, null_times)
            timed = pulled.filter(F.col(time).isNotNull())
            if overlap is not None and done >= 0:
                timed = stage(_not_published(timed, state_path, done, overlap), "unpublished")
            write_batch(assign_sequence(timed, [time, key], start=last), rows_path, number)
        numbered = read_batch(spark, rows_path, number, numbered_schema)
        send_and_resend(numbered, number, topic, publish)
        position = next_cursor(numbered, cursor, time, key).first()
        after = Cursor(position["cursor"], position["cursor_key"])
        # A late row alone must not move the cursor back.
        if cursor.time and after.time < cursor.time:
            after = cursor
        if overlap is not None:
            _remember(spark, state_path, numbered, done, number, after, key, time, overlap)
        kinds = {f.name: f.dataType for f in STATE.fields}
        state = dict(zip(STATE.names, (after.time, after.key, last_number(numbered, last))))
        write_values(spark, f"{state_path}/done", number, **{n: F.lit(v).cast(kinds[n]) for n, v in state.items()})
    for folder in ("rows", "seen", "done"):
        forget_batches(spark, f"{state_path}/{folder}", number)
    return after


def _remember(
    spark: SparkSession, state_path: str, numbered: DataFrame, done: int, number: int, after: Cursor, key: str, time: str, overlap: str
) -> None:
    """Rows published within ``overlap`` before the cursor."""
    sent = numbered.drop(SEQ)
    if done >= 0:
        sent = sent.unionByName(read_batch(spark, f"{state_path}/seen", done, sent.schema))
    write_batch(rows_after(sent, after, time, key, overlap), f"{state_path}/seen", number)


def capture_loop(
    read_log: Callable[[SparkSession], DataFrame],
    spark: SparkSession,
    topic: Topic,
    state_path: str,
    key: str,
    pause: float = PAUSE_SECONDS,
    go_on: Callable[[Cursor], bool] = lambda cursor: True,
    **settings: object,
) -> Cursor:
    """Rounds with a pause between them while ``go_on`` says so; the last cursor.

    A loop that is started again goes on after the last finished round.
    """
    while True:
        cursor = capture_round(read_log(spark), topic, state_path, key, **settings)
        if not go_on(cursor):
            return cursor
        clock.sleep(pause)
