import json
import random
from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import Row, functions as F, types as T

from syncspark.functions import accepted, decode, encode, quarantined
from syncspark.operators.incremental import Cursor
from syncspark.operators.project import MARKER, tag
from syncspark.plans.capture import _pulled, capture_loop, capture_round, state_after
from syncspark.schemas import MESSAGE
from syncspark.sources.readers import read_topic, stream_topic
from syncspark.sources.sinks import file_sink, publish
from syncspark.streaming.batches import append, appended, read_batch, read_batches, start, write_batch
from syncspark.streaming.capture import FileTopic, SourceTopic, capture, numbers_of, resend_missing
from syncspark.streaming.counters import count_by_key, current_counts
from syncspark.streaming.messages import deliver_once, refused, sync_messages, sync_messages_to, synced
from syncspark.streaming.receiver import _gaps_processor, lost_ranges, range_state, received_once
from syncspark.workspace import mark, new_path

TEXTS = [
    '{"user_id":1,"login":"a","state":"INSERT"}',
    '"{\\"user_id\\":2,\\"login\\":\\"b\\"}"',
    "{bad",
    "",
    '{"user_id":3,"login":"q\\"q"}',
]
VALUE = T.StructType([T.StructField("value", T.StringType())])


def _texts(spark, path, texts=TEXTS):
    spark.createDataFrame([(t,) for t in texts], VALUE).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path, schema=VALUE):
    return stream_topic(spark, {"path": path, "maxFilesPerTrigger": "1"}, "parquet", schema)


@pytest.fixture
def dirs(tmp_path):
    return lambda name: str(tmp_path / name)


def test_stream_equals_batch_and_restarts_without_loss_or_repeat(spark, rows, dirs):
    _texts(spark, dirs("topic"))
    for extra in ([], ['{"user_id":9,"login":"late"}', "late bad"]):
        if extra:
            _texts(spark, dirs("topic"), extra)
        query = sync_messages(_stream(spark, dirs("topic")), dirs("out"), dirs("check"), interval=None)
        query.awaitTermination()
        batch = decode(read_topic(spark, {"path": dirs("topic")}, "parquet"))
        assert rows(synced(spark, dirs("out"))) == rows(accepted(batch))
        assert rows(refused(spark, dirs("out"))) == rows(quarantined(batch))


def test_stream_to_sinks(spark, rows, dirs):
    sinks = [file_sink("a", dirs("a"), MESSAGE), file_sink("b", dirs("b"), MESSAGE, "json")]
    for sink in sinks:
        sink.prepare(spark)
    _texts(spark, dirs("topic"))
    sync_messages_to(_stream(spark, dirs("topic")), sinks, dirs("check"), "s", interval=None).awaitTermination()
    batch = decode(spark.read.parquet(dirs("topic")))
    for sink in sinks:
        assert rows(sink.read(spark).drop(MARKER)) == rows(accepted(batch))


def test_replay_after_half_written_sink_completes_it(spark, rows, dirs):
    sink = file_sink("a", dirs("a"), MESSAGE)
    messages = accepted(decode(spark.createDataFrame([(t,) for t in TEXTS * 2], VALUE)))
    sink.prepare(spark)
    sink.write(tag(messages.filter("user_id = 1").limit(1), "s-0"))
    for _ in range(2):
        deliver_once(tag(messages, "s-0"), sink, "s-0")
        assert rows(sink.read(spark).drop(MARKER)) == rows(messages)


def test_replayed_batch_overwrites_its_own_folder(spark, dirs):
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert read_batches(spark, dirs("out"), schema).count() == 0
    for batch_id, n in ((0, 3), (1, 5), (1, 4)):
        write_batch(spark.range(n), dirs("out"), batch_id)
    counts = {r.batch_id: r["count"] for r in read_batches(spark, dirs("out"), schema).groupBy("batch_id").count().collect()}
    assert counts == {0: 3, 1: 4}
    assert read_batch(spark, dirs("out"), 0, schema).count() == 3


LOG = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("log_timestamp", T.TimestampType()),
])


def _log(spark, path, first, last):
    spark.range(first, last).select(
        "id",
        F.when(F.col("id") % 5 == 0, "DELETE").otherwise("UPDATE").alias("state"),
        F.timestamp_seconds(F.col("id")).alias("log_timestamp"),
    ).coalesce(1).write.mode("append").parquet(path)


def test_capture_numbers_on_and_resends_across_restarts(spark, dirs):
    topic = FileTopic(dirs("topic"))

    def lossy(messages, batch_id):
        topic.publish(messages.filter(F.get_json_object("value", "$.state") != "DELETE"), batch_id)

    for first, last in ((0, 30), (30, 47)):
        _log(spark, dirs("log"), first, last)
        capture(
            _stream(spark, dirs("log"), LOG), topic, dirs("progress"), dirs("check"),
            ["log_timestamp", "id"], publish=lossy, interval=None,
        ).awaitTermination()
    found = topic.read(spark).select(F.from_json("value", "id long, seq long").alias("m")).select("m.*")
    assert sorted((r.id, r.seq) for r in found.collect()) == [(i, i + 1) for i in range(47)]
    assert spark.read.parquet(f"{topic.resent}").count() == 10


def test_failed_batch_is_replayed_with_the_same_numbers(spark, dirs):
    topic = FileTopic(dirs("topic"))
    attempts = []

    def failing_once(messages, batch_id):
        attempts.append(batch_id)
        topic.publish(messages, batch_id)
        if len(attempts) == 2:
            raise RuntimeError("lost connection")

    _log(spark, dirs("log"), 0, 10)
    _log(spark, dirs("log"), 10, 20)
    for _ in range(2):
        query = capture(
            _stream(spark, dirs("log"), LOG), topic, dirs("progress"), dirs("check"),
            ["log_timestamp", "id"], publish=failing_once, interval=None,
        )
        try:
            query.awaitTermination()
        except Exception as error:
            assert "lost connection" in str(error)
    assert attempts == [0, 1, 1]
    seqs = sorted(r.seq for r in numbers_of(topic.read(spark)).collect())
    assert seqs == list(range(1, 21))


def _numbers(spark, topic):
    found = topic.read(spark).select(F.from_json("value", "id long, seq long").alias("m")).select("m.*")
    return sorted((r.id, r.seq) for r in found.collect())


def test_rounds_over_a_log_table(spark, dirs):
    topic = FileTopic(dirs("topic"))

    def lossy(messages, batch_id):
        topic.publish(messages.filter(F.get_json_object("value", "$.state") != "DELETE"), batch_id)

    def run():
        return capture_round(spark.read.parquet(dirs("log")), topic, dirs("state"), "id", publish=lossy)

    _log(spark, dirs("log"), 0, 12)
    run()
    assert _numbers(spark, topic) == [(i, i + 1) for i in range(12)]
    _log(spark, dirs("log"), 12, 20)
    # A further round finds nothing.
    for _ in range(2):
        cursor = run()
        assert _numbers(spark, topic) == [(i, i + 1) for i in range(20)]
        assert cursor == Cursor("1970-01-01 00:00:19.000000", 19)
    assert state_after(spark, dirs("state")) == (2, cursor, 20)


def test_failed_round_keeps_its_rows_and_numbers(spark, dirs):
    topic = FileTopic(dirs("topic"))

    def failing(messages, batch_id):
        topic.publish(messages, batch_id)
        raise RuntimeError("lost")

    log = lambda: spark.read.parquet(dirs("log"))
    _log(spark, dirs("log"), 5, 9)
    with pytest.raises(RuntimeError, match="lost"):
        capture_round(log(), topic, dirs("state"), "id", publish=failing)
    _log(spark, dirs("log"), 0, 5)
    _log(spark, dirs("log"), 9, 12)
    capture_round(log(), topic, dirs("state"), "id", overlap="1 hour")
    assert _numbers(spark, topic) == [(5, 1), (6, 2), (7, 3), (8, 4)]
    capture_round(log(), topic, dirs("state"), "id", overlap="1 hour")
    found = _numbers(spark, topic)
    assert [i for i, _ in found] == list(range(12)) and sorted(s for _, s in found) == list(range(1, 13))


def test_late_rows_within_the_overlap(spark, dirs):
    topic = FileTopic(dirs("topic"))
    for first, last in ((100, 200), (90, 100), (200, 210), (150, 150)):
        if first < last:
            _log(spark, dirs("log"), first, last)
        cursor = capture_round(spark.read.parquet(dirs("log")), topic, dirs("state"), "id", overlap="2 minutes")
    assert [i for i, _ in _numbers(spark, topic)] == list(range(90, 210))
    assert cursor.key == 209


def test_rows_without_a_time_fail_the_round_or_are_kept(spark, dirs):
    topic = FileTopic(dirs("topic"))
    log = spark.range(10).select("id", F.lit("UPDATE").alias("state"), F.when(F.col("id") % 3 > 0, F.timestamp_seconds("id")).alias("log_timestamp"))
    with pytest.raises(ValueError, match="log_timestamp"):
        capture_round(log, topic, dirs("state"), "id")
    for _ in range(2):
        capture_round(log, topic, dirs("state"), "id", null_times=dirs("aside"))
    assert sorted(r.id for r in spark.read.parquet(dirs("aside")).collect()) == [0, 3, 6, 9]
    assert len(_numbers(spark, topic)) == 6


def test_loop_goes_on_after_a_restart(spark, dirs):
    topic, seen = FileTopic(dirs("topic")), []

    def read_log(spark):
        _log(spark, dirs("log"), 4 * len(seen), 4 * len(seen) + 4)
        return spark.read.parquet(dirs("log"))

    for rounds in (2, 1):
        start_at = len(seen)
        capture_loop(read_log, spark, topic, dirs("state"), "id", pause=0, go_on=lambda c: seen.append(c) or len(seen) < start_at + rounds)
    assert _numbers(spark, topic) == [(i, i + 1) for i in range(12)]


def test_a_topic_behind_a_format_of_spark(spark, dirs):
    """The same capture with a topic that is no folder of batches."""
    topic = SourceTopic("json", {"path": dirs("topic")}, {"path": dirs("topic")})
    sent = []

    def lossy(messages, batch_id):
        sent.append(batch_id)
        topic.publish(messages.filter(F.get_json_object("value", "$.state") != "DELETE"), batch_id)

    _log(spark, dirs("log"), 0, 20)
    capture(
        _stream(spark, dirs("log"), LOG), topic, dirs("progress"), dirs("check"),
        ["log_timestamp", "id"], publish=lossy, interval=None,
    ).awaitTermination()
    records = spark.read.json(dirs("topic"))
    assert {r.key: r["count"] for r in records.groupBy("key").count().collect()} == {"0": 16, "0-again": 4}
    found = records.select(F.from_json("value", "id long, seq long").alias("m")).select("m.*")
    assert sorted(map(tuple, found.collect())) == [(i, i + 1) for i in range(20)]


def test_a_killed_batch_is_neither_lost_nor_doubled(spark, rows, dirs):
    """Files of a batch that was not finished do not count, and its replay brings its rows once."""
    schema = T.StructType([T.StructField("id", T.LongType())])
    run = lambda: append(_stream(spark, dirs("in"), schema), dirs("out"), dirs("check"), interval=None).awaitTermination()
    assert appended(spark, dirs("out"), schema).count() == 0
    for n in (3, 4):
        spark.range(n).coalesce(1).write.mode("append").parquet(dirs("in"))
    run()
    expected = sorted([(i,) for i in range(3)] + [(i,) for i in range(4)])
    assert rows(appended(spark, dirs("out"), schema)) == expected
    # Killed after the files of the last batch were written, and after the sink had noted them.
    for notes in (("check/commits/1",), ("check/commits/1", "out/_spark_metadata/1")):
        for note in notes:
            folder, name = dirs(note).rsplit("/", 1)
            for file in (f"{folder}/{name}", f"{folder}/.{name}.crc"):
                Path(file).unlink(missing_ok=True)
        run()
        assert rows(appended(spark, dirs("out"), schema)) == expected


def test_a_replayed_batch_that_fails_is_written_by_the_next_replay(spark, dirs):
    schema = T.StructType([T.StructField("id", T.LongType())])
    write_batch(spark.range(3), dirs("out"), 0)
    failing = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_batch(failing, dirs("out"), 0)
    with pytest.raises(ValueError, match="no finished batch 0"):
        read_batch(spark, dirs("out"), 0, schema)
    write_batch(spark.range(2), dirs("out"), 0)
    assert read_batches(spark, dirs("out"), schema).count() == 2


def _records(spark, path, rows):
    kinds = "key string, value string, topic string, partition int, offset long"
    spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").json(path)


def test_a_batch_reads_its_own_range_of_a_topic(spark, dirs, monkeypatch):
    """Each batch asks for the records behind those of the batch before, a replay for the same again."""
    topic = SourceTopic("json", {}, {"path": dirs("topic"), "subscribe": "t"}, dirs("positions"))
    asked = []

    def read(spark, options, source):
        asked.append(options.get("startingOffsets"))
        begin = json.loads(options.get("startingOffsets", "{}")).get("t", {})
        records = spark.read.schema("key string, value string, topic string, partition int, offset long").json(options["path"])
        for partition, offset in begin.items():
            records = records.filter((F.col("partition") != int(partition)) | (F.col("offset") >= offset))
        return records

    monkeypatch.setattr("syncspark.streaming.capture.read_topic", read)
    _records(spark, dirs("topic"), [("0", "a", "t", 0, 5), ("0", "b", "t", 1, 8)])
    assert sorted(r.value for r in topic.arrived(spark, 0).collect()) == ["a", "b"]
    _records(spark, dirs("topic"), [("0-again", "c", "t", 0, 6), ("1", "d", "t", 0, 7)])
    for _ in range(2):
        assert [r.value for r in topic.arrived(spark, 1).collect()] == ["d"]
    assert topic.arrived(spark, 2).collect() == []
    ends = ['{"t": {"0": 6, "1": 9}}', '{"t": {"0": 8, "1": 9}}']
    assert asked == [None, ends[0], ends[0], ends[1]]


def test_same_times_and_copies_are_published_once_each(spark, rows, dirs):
    """The log has no key of its own: late changes of one user at one time, copies, and rows without time or key."""
    kinds = "user_id long, state string, log_timestamp timestamp"
    time = datetime(2024, 1, 1, 12)
    first = [(1, "a", time), (1, "a", time), (1, None, None), (None, "x", None)]
    later = [(1, "b", time), (1, "a", time), (1, "y", None), (None, "x", None), (2, "c", time)]
    topic = FileTopic(dirs("topic"))
    for held in (first, first + later, first + later):
        log = spark.createDataFrame(held, kinds).coalesce(1)
        capture_round(log, topic, dirs("state"), "user_id", overlap="1 hour", null_times=dirs("aside"))
    found = topic.read(spark).select(F.from_json("value", "user_id long, state string, seq long").alias("m")).select("m.*")
    assert rows(found.drop("seq")) == sorted([(i, s) for i, s, t in first + later if t], key=repr)
    assert sorted(r.seq for r in found.collect()) == [1, 2, 3, 4, 5]
    assert rows(spark.read.parquet(dirs("aside"))) == sorted([r for r in first + later if not r[2]], key=repr)


def test_rows_without_a_time_are_looked_for_by_the_scan_itself(spark, dirs):
    log = spark.range(50).select("id", F.timestamp_seconds("id").alias("log_timestamp"))
    log.write.parquet(dirs("log"))
    pulled = _pulled(spark.read.parquet(dirs("log")), Cursor("1970-01-01 00:00:40", 40), "id", "log_timestamp", None)
    plan = pulled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PushedFilters: [Or(And(GreaterThanOrEqual(log_timestamp" in plan


def test_only_begun_deliveries_are_read_back(spark, rows, dirs, monkeypatch):
    sink = file_sink("a", dirs("a"), MESSAGE)
    sink.prepare(spark)
    marked = tag(accepted(decode(spark.createDataFrame([(t,) for t in TEXTS], VALUE))), "s-0")
    reads = []
    monkeypatch.setattr(type(sink), "read_run", lambda self, spark, run, real=type(sink).read_run: reads.append(run) or real(self, spark, run))
    deliver_once(marked, sink, "s-0", dirs("ledger"))
    deliver_once(marked, sink, "s-0", dirs("ledger"))
    assert reads == [] and rows(sink.read(spark)) == rows(marked)
    mark(spark, f"{dirs('ledger')}/s-1/a.begun")
    sink.write(marked.withColumn("run_id", F.lit("s-1")).limit(1))
    deliver_once(marked.withColumn("run_id", F.lit("s-1")), sink, "s-1", dirs("ledger"))
    assert reads == ["s-1"] and sink.read(spark).count() == 2 * marked.count()


def test_resend_keeps_whole_records(spark, rows):
    sent = spark.createDataFrame([(1, "a", None), (2, 'b"', "x")], "seq long, login string, url string")
    received = numbers_of(encode(sent.filter("seq = 1")).union(spark.createDataFrame([("bad",)], VALUE)))
    again = resend_missing(sent, received)
    assert [r.value for r in again.collect()] == ['{"seq":2,"login":"b\\"","url":"x"}']
    assert resend_missing(sent, numbers_of(encode(sent))).isEmpty()


def test_counts_are_kept_across_restarts(spark, rows, dirs):
    schema = T.StructType([T.StructField("k", T.LongType())])
    expected = {}
    for n in (10, 25):
        spark.range(n).selectExpr("IF(id < 8, 0, id) AS k").coalesce(1).write.mode("append").parquet(dirs("in"))
        count_by_key(_stream(spark, dirs("in"), schema), ["k"], dirs("check"), None).awaitTermination()
        for i in range(n):
            expected[0 if i < 8 else i] = expected.get(0 if i < 8 else i, 0) + 1
        assert dict(rows(current_counts(spark, dirs("check")))) == expected


def test_publish_to_a_folder(spark, dirs):
    df = spark.createDataFrame([(1, None)], "user_id long, login string")
    publish(df, {"path": dirs("topic")}, "json", columns=["user_id", "login"])
    assert read_topic(spark, {"path": dirs("topic")}, "json").first().value == '{"user_id":1,"login":null}'


def test_interval_trigger_runs_and_stops(spark, dirs):
    _texts(spark, dirs("topic"))
    query = sync_messages(_stream(spark, dirs("topic")), dirs("out"), dirs("check"))
    query.processAllAvailable()
    query.stop()
    assert synced(spark, dirs("out")).count() == 3


def test_missing_connectors_fail_at_once(spark):
    with pytest.raises(Exception):
        read_topic(spark, {"subscribe": "t"})
    with pytest.raises(Exception):
        start(stream_topic(spark, {"subscribe": "t"}), lambda d, i: None, "x")


RECORD = T.StructType([T.StructField("sender", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("at", T.TimestampType())])


def _deliver(spark, path, *records):
    rows = [(s, n, datetime(2024, 1, 1 + hour // 24, hour % 24)) for s, n, hour in records]
    spark.createDataFrame(rows, RECORD).coalesce(1).write.mode("append").parquet(path)


def test_numbers_are_lost_only_when_they_are_late_by_the_set_time(spark, rows, dirs):
    def run():
        with range_state(spark):
            stream = lost_ranges(_stream(spark, dirs("in"), RECORD), "sender", "seq", "at", "10 hours")
            append(stream, dirs("out"), dirs("check"), interval=None).awaitTermination()

    lost = lambda: rows(appended(spark, dirs("out"), T.StructType.fromDDL("sender string, first bigint, last bigint")))
    # a lacks 2 to 4 and 6, b begins at 3; the numbers come in any order.
    _deliver(spark, dirs("in"), ("a", 7, 2), ("a", 1, 0), ("a", 5, 1), ("a", 5, 1), ("b", 3, 2))
    run()
    assert lost() == []
    # 3 arrives late but in time; 12 hours later the rest counts as lost, and b's 4 is still awaited.
    _deliver(spark, dirs("in"), ("a", 3, 1), ("a", 8, 9))
    _deliver(spark, dirs("in"), ("b", 5, 13), ("a", 9, 13))
    run()
    expected = [("a", 2, 2), ("a", 4, 4), ("a", 6, 6), ("b", 1, 2)]
    assert lost() == expected
    _deliver(spark, dirs("in"), ("b", 4, 12), ("c", 1, 60))
    run()
    assert lost() == expected


def test_repeats_are_dropped_and_leave_the_state(spark, rows, dirs):
    kinds = T.StructType.fromDDL("seq bigint, at timestamp")
    message = lambda n: f'{{"seq":{n},"at":"2024-01-0{1 + n // 24} {n % 24:02}:00:00.000000"}}'
    for batch in ([0, 1, 1, 2], [2, 3, 0], [40, 41], [70]):
        _texts(spark, dirs("in"), [message(n) for n in batch] + ["{bad"])
    stream = received_once(_stream(spark, dirs("in")), kinds, "at", "12 hours")
    query = append(stream, dirs("out"), dirs("check"), interval=None)
    query.awaitTermination()
    assert [r[0] for r in rows(appended(spark, dirs("out"), kinds))] == [0, 1, 2, 3, 40, 41, 70]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) < 7 and held[-1] <= 2


class _State:
    """A value or a map of a processor, and the timers of its sender."""

    def __init__(self):
        self.held, self.timers = {}, set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard
        self.getValueState = self.getMapState = lambda *_: _State()

    def exists(self):
        return () in self.held

    def get(self):
        return self.held[()]

    def update(self, value):
        self.held[()] = value

    def clear(self):
        self.held.clear()

    def iterator(self):
        return iter(list(self.held.items()))

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        del self.held[key]


def test_many_ranges_of_a_sender_wait_for_one_timer():
    """Numbers over several blocks, some late, some twice; the ranges are those found number by number."""
    handle, gaps, draw = _State(), _gaps_processor(), random.Random(5)
    gaps.init(handle)
    sent = [n for n in range(1, 200_001, 7) if not 70_000 < n < 140_000]
    early = [n for n in sent if draw.random() < 0.5]
    late = [n for n in sent if n not in set(early)] + [3, 4, 5, 100_000]
    for numbers in (early, late):
        draw.shuffle(numbers)
        gaps.handleInputRows(("a",), iter([Row(_number=n, _millis=1000 + n) for n in numbers + numbers[:50]]), None)
        assert len(handle.timers) == 1
    arrived, missing, seen = {*early, *late}, [], 0
    for n in sorted(arrived):
        missing += [(seen + 1, n - 1)] if n > seen + 1 else []
        seen = n
    found = []
    for watermark in (1000, 90_000, 500_000):
        while handle.timers and min(handle.timers) < watermark:
            at = min(handle.timers)
            times = SimpleNamespace(getCurrentWatermarkInMs=lambda w=watermark: w)
            found.append([(r.first, r.last) for r in gaps.handleExpiredTimer(("a",), times, SimpleNamespace(getExpiryTimeInMs=lambda t=at: t))])
            handle.timers.discard(at)
    assert len(found) == 2 and sorted(found[0] + found[1]) == missing
    assert handle.timers == set() and not gaps.gaps.held


def test_received_once_parses_a_sending_in_several_tasks(spark, monkeypatch, tmp_path, rows):
    """Each sending is a batch of its own, and no batch is one file."""
    from syncspark.queries import streams

    events = spark.range(4000).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(id * 10 AS INT), 0) AS ts", "id % 5 AS user_id",
        "IF(id % 3 = 0, 'click', 'view') AS event_type", "1.0D AS value", "'{}' AS props",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    files, topics = [], []

    def path(session, label):
        found = new_path(session, label)
        topics.extend([found] if label == "topic" else [])
        return found

    def received(raw, *settings):
        files.append(len(list(Path(topics[0].removeprefix("file:")).glob("*.parquet"))))
        return received_once(raw, *settings)

    monkeypatch.setattr(streams, "new_path", path)
    monkeypatch.setattr(streams, "received_once", received)
    # Tables as small as these would be joined to one task.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = rows(streams.stream_received_once(spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sorted(r[0] for r in found) == list(range(1, 4001))
    assert len(files) == 4 and files[0] > 1 and files[1] > files[0] + 1
