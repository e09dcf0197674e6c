"""Message text: cleaning, parsing, refusal and encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from syncspark.functions.messages import accepted, decode, encode, open_map, quarantined
from syncspark.functions.scalars import clean_text, format_micros, to_millis
from syncspark.queries.inputs import MESSAGES_SQL, messages, table
from syncspark.queries.registry import query

_CLEAN = r"""regexp_replace(regexp_replace({0}, '\\', '', 'g'), '^"|"$', '', 'g')"""

FIELDS = ("user_id", "login", "gravatar_id", "avatar_url", "url", "state", "log_timestamp")

# The message after undoing double encoding, and why it would be refused.
DECODED_SQL = rf"""{MESSAGES_SQL},
opened AS (
    SELECT event_id, value,
           CASE WHEN value LIKE '"%' THEN json_extract_string(value, '$') ELSE value END AS body
    FROM messages),
decoded AS (
    SELECT event_id, value, body,
           CASE WHEN value IS NULL OR trim(value) = '' THEN 'empty'
                WHEN NOT json_valid(body) THEN 'not one json value'
                WHEN json_type(body) <> 'OBJECT' THEN 'not a json object'
                WHEN json_type(body, '$.user_id') NOT IN ('BIGINT', 'UBIGINT', 'NULL') THEN 'wrong field type'
                WHEN json_extract_string(body, '$.user_id') IS NULL
                     OR json_extract_string(body, '$.login') IS NULL THEN 'missing required key'
           END AS reason
    FROM opened)"""

ACCEPTED_SQL = f"""WITH {DECODED_SQL}
    SELECT event_id, CAST(json_extract_string(body, '$.user_id') AS BIGINT) AS user_id,
           {', '.join(f"json_extract_string(body, '$.{f}') AS {f}" for f in FIELDS[1:])}
    FROM decoded WHERE reason IS NULL"""


@query(f"WITH {MESSAGES_SQL} SELECT event_id, {_CLEAN.format('value')} AS cleaned FROM messages")
def clean_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).select("event_id", clean_text(F.col("value")).alias("cleaned"))


@query(f"SELECT page_id, {_CLEAN.format('html')} AS cleaned FROM pages")
def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", clean_text(F.col("html")).alias("cleaned"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(1 AS BIGINT) AS n_fields FROM events")
def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "events").select("event_id", open_map(F.col("props")).alias("fields"))
    return parsed.filter(F.col("fields").isNotNull()).select(
        "event_id", F.col("fields")["k"].alias("k"), F.size("fields").cast("long").alias("n_fields")
    )


@query(ACCEPTED_SQL)
def parse_messages_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(decode(messages(spark, sf_dir)), keep=["event_id"])


# Without backslashes the escaped quotes break their message, double encoding
# disappears, and text after the object is not noticed.
@query(
    rf"""WITH {MESSAGES_SQL},
    cleaned AS (SELECT event_id, replace({_CLEAN.format('value')}, '}} trailing', '}}') AS body FROM messages),
    readable AS (
        SELECT event_id, CASE WHEN json_valid(body) AND json_type(body) = 'OBJECT' THEN body END AS body
        FROM cleaned WHERE body IS NOT NULL AND trim(body) <> '')
    SELECT event_id, TRY_CAST(json_extract_string(body, '$.user_id') AS BIGINT) AS user_id,
           {', '.join(f"json_extract_string(body, '$.{f}') AS {f}" for f in FIELDS[1:])}
    FROM readable"""
)
def parse_messages_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(decode(messages(spark, sf_dir), lenient=True), keep=["event_id"])


QUARANTINE_SQL = f"WITH {DECODED_SQL} SELECT event_id, value, reason FROM decoded WHERE reason IS NOT NULL"


@query(QUARANTINE_SQL)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined(decode(messages(spark, sf_dir)), keep=["event_id"])


@query(
    f"""WITH {DECODED_SQL}
    SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM decoded GROUP BY 1"""
)
def message_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary values, as a queue delivers them, counted by outcome."""
    binary = messages(spark, sf_dir).withColumn("value", F.col("value").cast("binary"))
    outcome = F.coalesce(F.col("reason"), F.lit("accepted")).alias("reason")
    return decode(binary).groupBy(outcome).agg(F.count("*").alias("n"))


@query(
    """SELECT conv_id, turn, role, text,
           strftime(TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(conv_id % 60 * 1000000 + turn + 1),
                    '%Y-%m-%d %H:%M:%S.%f') AS said_at
    FROM conversations"""
)
def encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts and times to JSON and back, quotes, line breaks and microseconds included."""
    second = F.expr("CAST(conv_id % 60 + (turn + 1) / 1000000 AS DECIMAL(18, 6))")
    said_at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=second)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", said_at.alias("said_at"))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in turns.schema.fields])
    back = accepted(decode(encode(turns), schema, required=("conv_id", "turn", "said_at")))
    return back.withColumn("said_at", format_micros(F.col("said_at")))


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS micros,
           strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f') AS millis
    FROM events"""
)
def format_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        format_micros(ts).alias("micros"),
        format_micros(to_millis(ts)).alias("millis"),
    )
