"""Pulls of a change log past a cursor."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from syncspark.functions.scalars import format_micros, is_blank

LOG_TIME = "log_timestamp"


class Cursor(NamedTuple):
    """Position in a change log: time, and the key of the last row at that time.

    Without a key the position is after every row of that time, so rows that
    commit later with the same time are skipped.
    """

    time: str | None = None
    key: int | None = None


def is_after(
    log: DataFrame,
    cursor: Cursor,
    time: str = LOG_TIME,
    key: str | None = None,
    overlap: str | None = None,
) -> Column:
    """Whether a row is past the cursor; always, for a blank one.

    The stored column itself is compared, so the filter reaches the scan.
    ``overlap``, an interval such as ``10 minutes``, moves the start back to
    catch rows that committed late.
    """
    if is_blank(cursor.time):
        return F.lit(True)
    kind = log.schema[time].dataType
    last = F.lit(str(cursor.time).strip()).cast(kind)
    if overlap is not None:
        return F.col(time) >= (last - F.expr(f"INTERVAL {overlap}")).cast(kind)
    if key is None or cursor.key is None:
        return F.col(time) > last
    return (F.col(time) >= last) & ((F.col(time) > last) | (F.col(key) > F.lit(cursor.key)))


def rows_after(
    log: DataFrame,
    cursor: Cursor,
    time: str = LOG_TIME,
    key: str | None = None,
    overlap: str | None = None,
) -> DataFrame:
    """Rows past the cursor; a blank cursor gives the whole log.

    :func:`not_yet_seen` removes what an ``overlap`` repeats.
    """
    return log if is_blank(cursor.time) else log.filter(is_after(log, cursor, time, key, overlap))


def not_yet_seen(pulled: DataFrame, seen: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Pulled rows whose identity is not among the rows handled before."""
    return pulled.join(seen.select(*identity), list(identity), "left_anti").select(*pulled.columns)


def last_position(pulled: DataFrame, time: str = LOG_TIME, key: str | None = None) -> DataFrame:
    """One row: the greatest position, null-skipping; nulls when there is none."""
    if key is None:
        return pulled.agg(format_micros(F.max(time)).alias("cursor"))
    top = F.max(F.when(F.col(time).isNotNull(), F.struct(F.col(time).alias("t"), F.col(key).alias("k"))))
    return pulled.agg(top.alias("top")).select(
        format_micros(F.col("top.t")).alias("cursor"), F.col("top.k").alias("cursor_key")
    )


def next_cursor(
    pulled: DataFrame, previous: Cursor, time: str = LOG_TIME, key: str | None = None
) -> DataFrame:
    """Position after this pull; the previous one when nothing was pulled."""
    top = last_position(pulled, time, key)
    fallback: Column = F.lit("" if previous.time is None else previous.time)
    columns = [F.coalesce(F.col("cursor"), fallback).alias("cursor")]
    if key is not None:
        kept = F.lit(previous.key).cast(top.schema["cursor_key"].dataType)
        columns.append(F.when(F.col("cursor").isNull(), kept).otherwise(F.col("cursor_key")).alias("cursor_key"))
    return top.select(*columns)
