"""Batch and stream scans. Every scan has a declared or a stored schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from syncspark.schemas import RAW_EVENT

# Options of the message-queue source.
TOPIC_OPTIONS = {"startingOffsets": "earliest"}


class Split(NamedTuple):
    """Column and bounds that divide a database read into parallel queries."""

    column: str
    lower: object
    upper: object
    parts: int


CORRUPT = "_corrupt_record"


def read_events(
    spark: SparkSession, path: str, schema: T.StructType = RAW_EVENT, keep_malformed: bool = False
) -> DataFrame:
    """JSON lines; fields outside the schema are skipped by the parser.

    A line that is no object of the schema fails the read, or with
    ``keep_malformed`` becomes a row with the line in :data:`CORRUPT`. Such a
    frame has to be staged before it is filtered by that column.
    """
    if not keep_malformed:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return spark.read.schema(full).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def stream_events(
    spark: SparkSession, path: str, schema: T.StructType = RAW_EVENT, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).json(path)


def split_options(split: Split | None) -> dict[str, str]:
    if split is None:
        return {}
    return {
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.parts),
    }


def table_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    split: Split | None = None,
    extra: Mapping[str, object] | None = None,
) -> dict[str, str]:
    """Options of a database scan.

    With a split the table is read by parallel range queries; without one the
    database sends everything to one task. Filters on the frame are pushed down.
    """
    options = {"url": url, "dbtable": table, "pushDownPredicate": "true"}
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    return options | split_options(split) | {k: str(v) for k, v in (extra or {}).items()}


def read_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def _literal(value: object) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    return f"DATE '{value}'" if isinstance(value, date) else str(value)


def even_ranges(keys: DataFrame, column: str, parts: int, accuracy: int = 0) -> list[str]:
    """Conditions that divide a read into ranges of about equally many rows.

    The bounds come from a quantile sketch of a numeric, date or time column:
    one narrow scan, of a sketch per task. ``accuracy`` bounds its size and is a
    hundred times the parts by default, so a range is off by some hundredths of
    its rows. Every row meets exactly one condition, rows without a key the
    first. A value is never divided: one that holds more than a range's share
    leaves fewer ranges than ``parts``.
    """
    shares = [i / parts for i in range(1, parts)]
    found = keys.agg(F.percentile_approx(column, shares, accuracy or 100 * parts)).first()[0] if shares else None
    bounds = [_literal(b) for b in dict.fromkeys(found or ())]
    if not bounds:
        return ["1 = 1"]
    between = [f"{column} > {low} AND {column} <= {high}" for low, high in zip(bounds, bounds[1:])]
    return [f"{column} <= {bounds[0]} OR {column} IS NULL", *between, f"{column} > {bounds[-1]}"]


def read_table_ranges(spark: SparkSession, options: Mapping[str, str], ranges: Sequence[str]) -> DataFrame:
    """A database table read by one query for each of :func:`even_ranges`."""
    others = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=list(ranges), properties=others)


def read_collection(
    spark: SparkSession,
    source: str,
    options: Mapping[str, str],
    schema: T.StructType | None = None,
    match: str | None = None,
) -> DataFrame:
    """A document collection in any batch format.

    ``match`` is handed to a document store as its own pipeline stage; file
    formats get the same effect from a filter on the frame.
    """
    reader = spark.read.format(source).options(**options)
    if match is not None:
        reader = reader.option("pipeline", match)
    return (reader if schema is None else reader.schema(schema)).load()


def topic_options(
    servers: str, topic: str, extra: Mapping[str, object] | None = None, go_on_after_loss: bool = False
) -> dict[str, str]:
    """Options of a message-queue source.

    Records that expired before they were read fail the stream; with
    ``go_on_after_loss`` it skips them, so its result is incomplete.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **TOPIC_OPTIONS}
    options["failOnDataLoss"] = str(not go_on_after_loss).lower()
    return options | {k: str(v) for k, v in (extra or {}).items()}


def read_topic(spark: SparkSession, options: Mapping[str, str], source: str = "kafka") -> DataFrame:
    """Bounded read of all records that the topic holds now."""
    return spark.read.format(source).options(**options).load()


def stream_topic(
    spark: SparkSession,
    options: Mapping[str, str],
    source: str = "kafka",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Endless read of a topic, or of a folder of files written as one."""
    reader = spark.readStream.format(source).options(**options)
    return (reader if schema is None else reader.schema(schema)).load()
