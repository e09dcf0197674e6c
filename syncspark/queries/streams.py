"""Streams that run until their input is used up, read back as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from syncspark.functions.messages import encode
from syncspark.functions.scalars import format_micros
from syncspark.operators.project import MARKER, users_of
from syncspark.operators.sequence import assign_sequence
from syncspark.plans.capture import capture_round
from syncspark.queries.inputs import (
    CHANGE_LOG_SQL,
    EVENT_USERS_SQL,
    as_messages,
    change_log,
    raw_events,
    table,
)
from syncspark.queries.messages import ACCEPTED_SQL, FIELDS, QUARANTINE_SQL
from syncspark.queries.registry import query
from syncspark.schemas import MESSAGE, USERS
from syncspark.sources.readers import stream_events, stream_topic
from syncspark.sources.sinks import file_sink
from syncspark.streaming.batches import append, appended
from syncspark.streaming.capture import FileTopic, capture
from syncspark.streaming.counters import count_by_key, current_counts
from syncspark.streaming.messages import refused, sync_messages, sync_messages_to, synced
from syncspark.streaming.receiver import lost_ranges, range_state, received_once
from syncspark.workspace import new_path, stage


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    options = {"pathGlobFilter": "events.parquet", "path": sf_dir}
    return stream_topic(spark, options, "parquet", schema)


def _log_files(spark: SparkSession, sf_dir: str, path: str, **condition: str) -> None:
    """Append the change log of a time range as several files, one per day range."""
    log = change_log(spark, sf_dir)
    for kind, bound in condition.items():
        at = F.lit(bound).cast("timestamp_ntz")
        log = log.filter(F.col("log_timestamp") < at if kind == "until" else F.col("log_timestamp") >= at)
    log.repartitionByRange(3, "log_timestamp").write.mode("append").parquet(path)


def _log_stream(spark: SparkSession, sf_dir: str, path: str, max_files: int = 1) -> DataFrame:
    options = {"path": path, "maxFilesPerTrigger": str(max_files)}
    return stream_topic(spark, options, "parquet", change_log(spark, sf_dir).schema)


_ACCEPTED_FIELDS = f"SELECT {', '.join(FIELDS)} FROM ({ACCEPTED_SQL})"


@query(_ACCEPTED_FIELDS)
def stream_parse_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_path(spark, "synced")
    raw = as_messages(_event_stream(spark, sf_dir)).select(F.col("value").cast("binary").alias("value"))
    sync_messages(raw, out, new_path(spark, "checkpoint"), interval=None).awaitTermination()
    return synced(spark, out)


@query(f"SELECT value, reason FROM ({QUARANTINE_SQL})")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_path(spark, "synced")
    raw = as_messages(_event_stream(spark, sf_dir))
    sync_messages(raw, out, new_path(spark, "checkpoint"), interval=None).awaitTermination()
    return refused(spark, out).select("value", "reason")


@query(f"SELECT *, 'table' AS sink FROM ({_ACCEPTED_FIELDS}) UNION ALL SELECT *, 'documents' FROM ({_ACCEPTED_FIELDS})")
def stream_to_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    sinks = [
        file_sink("table", new_path(spark, "stream-table"), MESSAGE),
        file_sink("documents", new_path(spark, "stream-documents"), MESSAGE, "json"),
    ]
    for sink in sinks:
        sink.prepare(spark)
    raw = as_messages(_event_stream(spark, sf_dir))
    sync_messages_to(raw, sinks, new_path(spark, "checkpoint"), "users", interval=None).awaitTermination()
    first, second = (sink.read(spark).drop(MARKER).withColumn("sink", F.lit(sink.name)) for sink in sinks)
    return first.union(second)


@query(
    f"""WITH {CHANGE_LOG_SQL}
    SELECT event_id, state, strftime(log_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS log_timestamp,
           CASE WHEN log_timestamp < TIMESTAMP '2024-01-16 00:00:00' THEN 1 ELSE 2 END AS run
    FROM change_log"""
)
def stream_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a growing log with one checkpoint: each row is read once."""
    path, out, checkpoint = (new_path(spark, label) for label in ("log", "pulled", "checkpoint"))

    def run(number: int) -> None:
        stream = _log_stream(spark, sf_dir, path).withColumn("run", F.lit(number))
        append(stream, out, checkpoint, interval=None).awaitTermination()

    _log_files(spark, sf_dir, path, until="2024-01-16 00:00:00")
    run(1)
    _log_files(spark, sf_dir, path, since="2024-01-16 00:00:00")
    run(2)
    schema = T.StructType([*change_log(spark, sf_dir).schema.fields, T.StructField("run", T.IntegerType())])
    pulled = appended(spark, out, schema)
    return pulled.select("event_id", "state", format_micros(F.col("log_timestamp")).alias("log_timestamp"), "run")


def _captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic after a capture whose first send loses every error."""
    path = new_path(spark, "log")
    topic = FileTopic(new_path(spark, "topic"))
    _log_files(spark, sf_dir, path)

    def lossy(messages: DataFrame, batch_id: int) -> None:
        topic.publish(messages.filter(F.get_json_object("value", "$.state") != "error"), batch_id)

    capture(
        _log_stream(spark, sf_dir, path),
        topic,
        new_path(spark, "progress"),
        new_path(spark, "checkpoint"),
        ["log_timestamp", "event_id"],
        publish=lossy,
        interval=None,
    ).awaitTermination()
    kinds = "event_id bigint, user_id bigint, state string, log_timestamp string, payload string, seq bigint"
    return topic.read(spark).select(F.from_json("value", kinds).alias("m")).select("m.*")


_LOGGED = "strftime(log_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS log_timestamp"


@query(f"WITH {CHANGE_LOG_SQL} SELECT event_id, user_id, state, {_LOGGED}, payload FROM change_log")
def stream_resend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change is in the topic once, the lost ones through the resend."""
    return _captured(spark, sf_dir).drop("seq")


@query(
    """SELECT count(*) AS n, CAST(1 AS BIGINT) AS first_seq, count(*) AS last_seq, count(*) AS n_numbers
    FROM events"""
)
def stream_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers go on from batch to batch without gap or repeat."""
    return _captured(spark, sf_dir).agg(
        F.count("*").alias("n"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.count_distinct("seq").alias("n_numbers"),
    )


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = new_path(spark, "log"), new_path(spark, "checkpoint")
    _log_files(spark, sf_dir, path)
    stream = _log_stream(spark, sf_dir, path, max_files=2)
    count_by_key(stream, ["user_id"], checkpoint, interval=None).awaitTermination()
    return current_counts(spark, checkpoint)


def _published(topic: FileTopic, spark: SparkSession) -> DataFrame:
    kinds = "event_id bigint, state string, log_timestamp string, seq bigint"
    return topic.read(spark).select(F.from_json("value", kinds).alias("m")).select("m.*")


def _until(log: DataFrame, bound: str) -> DataFrame:
    return log.filter(F.col("log_timestamp") < F.lit(bound).cast("timestamp_ntz"))


_MIDDLE = "2024-01-16 00:00:00"
_IN_ORDER = f"""WITH {CHANGE_LOG_SQL}
    SELECT event_id, state, {_LOGGED}, row_number() OVER (ORDER BY change_log.log_timestamp, event_id) AS seq
    FROM change_log"""


@query(_IN_ORDER)
def capture_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds over a log table that grows in between; clicks get lost at first."""
    topic, state = FileTopic(new_path(spark, "topic")), new_path(spark, "state")
    log = change_log(spark, sf_dir)

    def lossy(messages: DataFrame, batch_id: int) -> None:
        topic.publish(messages.filter(F.get_json_object("value", "$.state") != "click"), batch_id)

    capture_round(_until(log, _MIDDLE), topic, state, key="event_id", publish=lossy)
    capture_round(log, topic, state, key="event_id", publish=lossy)
    return _published(topic, spark)


@query(
    f"""WITH {CHANGE_LOG_SQL},
    rounds AS (SELECT *, CASE WHEN log_timestamp < TIMESTAMP '{_MIDDLE}'
                                AND NOT (state = 'signup' AND log_timestamp >= TIMESTAMP '2024-01-15 12:00:00')
                              THEN 0 ELSE 1 END AS round FROM change_log)
    SELECT event_id, state, {_LOGGED},
           row_number() OVER (ORDER BY round, rounds.log_timestamp, event_id) AS seq
    FROM rounds"""
)
def capture_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups of half a day commit after the round that went past their time."""
    topic, state = FileTopic(new_path(spark, "topic")), new_path(spark, "state")
    log = change_log(spark, sf_dir)
    late = (F.col("state") == "signup") & (F.col("log_timestamp") >= F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    capture_round(_until(log, _MIDDLE).filter(~late), topic, state, key="event_id", overlap="1 day")
    capture_round(log, topic, state, key="event_id", overlap="1 day")
    return _published(topic, spark)


@query(
    f"""WITH {CHANGE_LOG_SQL},
    rounds AS (SELECT *, CASE WHEN log_timestamp < TIMESTAMP '{_MIDDLE}' THEN 0 ELSE 1 END AS round FROM change_log)
    SELECT event_id, state, {_LOGGED},
           row_number() OVER (ORDER BY round, rounds.log_timestamp, event_id) AS seq
    FROM rounds"""
)
def capture_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A round that fails after its send is run again over a grown log, with the same numbers."""
    topic, state = FileTopic(new_path(spark, "topic")), new_path(spark, "state")
    log = change_log(spark, sf_dir)

    def failing(messages: DataFrame, batch_id: int) -> None:
        topic.publish(messages, batch_id)
        raise ConnectionError("lost after the send")

    try:
        capture_round(_until(log, _MIDDLE), topic, state, key="event_id", publish=failing)
    except ConnectionError:
        capture_round(log, topic, state, key="event_id")
    capture_round(log, topic, state, key="event_id")
    return _published(topic, spark)


@query(
    f"""WITH {CHANGE_LOG_SQL}
    SELECT event_id, state, CASE WHEN state <> 'error' THEN strftime(log_timestamp, '%Y-%m-%d %H:%M:%S.%f') END AS log_timestamp,
           CASE WHEN state = 'error' THEN -1
                ELSE row_number() OVER (PARTITION BY state = 'error' ORDER BY change_log.log_timestamp, event_id) END AS seq
    FROM change_log"""
)
def capture_null_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors have no time: two rounds keep each of them once beside the published rows."""
    topic, state, aside = FileTopic(new_path(spark, "topic")), new_path(spark, "state"), new_path(spark, "null-times")
    log = change_log(spark, sf_dir)
    log = log.withColumn("log_timestamp", F.when(F.col("state") != "error", F.col("log_timestamp")))
    for _ in range(2):
        capture_round(log, topic, state, key="event_id", null_times=aside)
    kept = spark.read.schema(log.schema).parquet(aside)
    kept = kept.select("event_id", "state", format_micros(F.col("log_timestamp")).alias("log_timestamp"), F.lit(-1).cast("long").alias("seq"))
    return _published(topic, spark).union(kept)


# The log as it is published: no number of its own, and times so coarse that users change
# several times at one time; errors have none, and those of every third user no key either.
_BY_USER_SQL = f"""WITH {CHANGE_LOG_SQL},
    by_user AS (SELECT CASE WHEN state = 'error' AND user_id % 3 = 0 THEN NULL ELSE user_id END AS user_id, state,
                       CASE WHEN state <> 'error' THEN date_trunc('hour', log_timestamp) END AS hour
                FROM change_log)
    SELECT user_id, state, strftime(hour, '%Y-%m-%d %H:%M:%S.%f') AS log_timestamp, count(*) AS n FROM by_user GROUP BY 1, 2, 3"""


@query(_BY_USER_SQL)
def capture_same_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds over a log without row numbers: changes at one time, copies and rows without a time all come once."""
    topic, state, aside = FileTopic(new_path(spark, "topic")), new_path(spark, "state"), new_path(spark, "null-times")
    events = change_log(spark, sf_dir)
    error = F.col("state") == "error"
    user = F.when(~(error & (F.col("user_id") % 3 == 0)), F.col("user_id"))
    at = F.when(~error, F.date_trunc("hour", "log_timestamp").cast("timestamp_ntz"))
    whole = events.select(user.alias("user_id"), "state", at.alias("log_timestamp"), "event_id")
    log = whole.drop("event_id")
    # What the first round finds: the first half, less the rows that commit later.
    middle = F.lit(_MIDDLE).cast("timestamp_ntz")
    early = F.coalesce(F.col("log_timestamp") < middle, F.lit(True)) & (F.col("event_id") % 7 != 0)
    capture_round(whole.filter(early).drop("event_id"), topic, state, key="user_id", overlap="40 days", null_times=aside)
    for _ in range(2):
        capture_round(log, topic, state, key="user_id", overlap="40 days", null_times=aside)
    kinds = "user_id bigint, state string, log_timestamp string"
    sent = topic.read(spark).select(F.from_json("value", kinds).alias("m")).select("m.*")
    kept = spark.read.schema(log.schema).parquet(aside).withColumn("log_timestamp", format_micros(F.col("log_timestamp")))
    return sent.union(kept).groupBy("user_id", "state", "log_timestamp").agg(F.count("*").alias("n"))


@query(f"WITH {EVENT_USERS_SQL} SELECT * FROM event_users")
def stream_json_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON scan as a stream: same schema, same projection."""
    path, out = new_path(spark, "events-json"), new_path(spark, "users")
    raw_events(spark, sf_dir).repartition(3, "repo.id").write.json(path)
    users = users_of(stream_events(spark, path, max_files=1))
    append(users, out, new_path(spark, "checkpoint"), interval=None).awaitTermination()
    return appended(spark, out, USERS)


# Numbers of four senders, in four deliveries. Errors get lost. Signups of the last half day of a
# delivery come with the next one, clicks come twice, and a last record moves the time on.
_BOUNDS = ("2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00")
_SENDERS_SQL = f"""WITH {CHANGE_LOG_SQL},
    numbered AS (SELECT user_id % 4 AS sender, state, log_timestamp,
                        row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) AS seq FROM change_log),
    greatest AS (SELECT sender, max(seq) AS top FROM numbered WHERE state <> 'error' GROUP BY sender)"""


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with the number that its sender gives each record: all are numbered by sender, and each sender's begin at 1."""
    log = change_log(spark, sf_dir).select((F.col("user_id") % 4).alias("sender"), "state", "log_timestamp", "event_id")
    placed = assign_sequence(log, ["sender", "event_id"], name="_place")
    before = placed.groupBy(F.col("sender").alias("_sender")).agg((F.min("_place") - 1).alias("_before"))
    numbered = placed.join(F.broadcast(before), F.col("sender").eqNullSafe(F.col("_sender")))
    return stage(numbered.select("sender", "state", "log_timestamp", (F.col("_place") - F.col("_before")).alias("seq")), "numbered")


def _sender_files(log: DataFrame, path: str, delivery: int) -> None:
    """Append a delivery as one file, so that it comes as one batch."""
    at = F.col("log_timestamp")
    bounds = [F.lit(b).cast("timestamp_ntz") for b in _BOUNDS]
    part, late = F.lit(0), F.lit(False)
    for i, bound in enumerate(bounds):
        part = F.when(at >= bound, i + 1).otherwise(part)
        late = late | ((at < bound) & (at >= bound - F.expr("INTERVAL 12 HOURS")))
    part = part + F.when(late & (F.col("state") == "signup"), 1).otherwise(0)
    twice = F.when(F.col("state") == "click", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = log.filter((F.col("state") != "error") & (part == delivery)).select("sender", "seq", at.cast("timestamp").alias("log_timestamp"), F.explode(twice).alias("_copy"))
    rows.drop("_copy").repartition(1).write.mode("append").parquet(path)


@query(
    f"""{_SENDERS_SQL}
    SELECT sender, seq FROM numbered JOIN greatest USING (sender) WHERE state = 'error' AND seq < top"""
)
def stream_lost_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lost numbers only, over four deliveries and a restart; late and repeated ones are none."""
    path, out, checkpoint = (new_path(spark, label) for label in ("deliveries", "lost", "checkpoint"))
    kinds = T.StructType([T.StructField("sender", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("log_timestamp", T.TimestampType())])

    def run() -> None:
        records = stream_topic(spark, {"path": path, "maxFilesPerTrigger": "1"}, "parquet", kinds)
        with range_state(spark):
            append(lost_ranges(records, "sender", "seq", "log_timestamp", "1 day"), out, checkpoint, interval=None).awaitTermination()

    log = _numbered(spark, sf_dir)
    for delivery in range(4):
        _sender_files(log, path, delivery)
        if delivery == 1:
            run()
    spark.sql("SELECT -1L AS sender, 1L AS seq, TIMESTAMP '2100-01-01 00:00:00' AS log_timestamp").coalesce(1).write.mode("append").parquet(path)
    run()
    ranges = appended(spark, out, T.StructType([kinds["sender"], *(T.StructField(n, T.LongType()) for n in ("first", "last"))]))
    return ranges.select("sender", F.explode(F.sequence("first", "last")).alias("seq"))


@query(
    f"""WITH {CHANGE_LOG_SQL}
    SELECT row_number() OVER (ORDER BY change_log.log_timestamp, event_id) AS seq, event_id, state,
           {_LOGGED} FROM change_log"""
)
def stream_received_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic whose first batch was sent again after a failure, and whose clicks were all resent."""
    path, out = new_path(spark, "topic"), new_path(spark, "received")
    sent = stage(assign_sequence(change_log(spark, sf_dir), ["log_timestamp", "event_id"]), "sent")
    first = encode(sent.filter(F.col("log_timestamp") < F.lit(_MIDDLE).cast("timestamp_ntz")))
    rest = encode(sent.filter(F.col("log_timestamp") >= F.lit(_MIDDLE).cast("timestamp_ntz")))
    again = encode(sent.filter(F.col("state") == "click"))
    kinds = T.StructType.fromDDL("seq bigint, event_id bigint, state string, log_timestamp timestamp")
    checkpoint = new_path(spark, "checkpoint")
    # Each sending is one batch, of as many files as it has tasks: a single file would be parsed by one task.
    for messages in (first, first, rest, again):
        messages.write.mode("append").parquet(path)
        raw = stream_topic(spark, {"path": path}, "parquet", T.StructType.fromDDL("value string"))
        with range_state(spark):
            append(received_once(raw, kinds, "log_timestamp", "40 days"), out, checkpoint, interval=None).awaitTermination()
    return appended(spark, out, kinds).withColumn("log_timestamp", format_micros(F.col("log_timestamp")))
