from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from syncspark.operators import reconcile as R, sketch
from syncspark.operators.project import tag
from syncspark.operators.sketch import narrow_by_sketch
from syncspark.plans.load import combined, load, load_events, resume, verify
from syncspark.schemas import REFUSED
from syncspark.schemas import REPOSITORIES, USERS
from syncspark.sources.readers import Split
from syncspark.sources.sinks import Sink, checked_mode, file_sink, table_sink, write_all
from syncspark.workspace import matching, new_path, shared_dir, stage

SCHEMA = "user_id long, login string"
SOURCE = [(1, "a"), (1, "a"), (2, None), (3, "c"), (None, None)]
SINK = [(1, "a"), (2, None), (3, "x"), (4, "d"), (4, "d")]


def _pair(spark, source=SOURCE, sink=SINK):
    return spark.createDataFrame(source, SCHEMA), spark.createDataFrame(sink, SCHEMA)


def test_missing_and_extra_are_multisets(spark, rows):
    compared = R.compare(*_pair(spark))
    expected_missing = list((Counter(SOURCE) - Counter(SINK)).elements())
    expected_extra = list((Counter(SINK) - Counter(SOURCE)).elements())
    assert rows(R.missing(compared)) == sorted(expected_missing, key=repr)
    assert rows(R.extra(compared)) == sorted(expected_extra, key=repr)


def test_columns_are_matched_by_name_and_types_widened(spark, rows):
    source = spark.createDataFrame([(1, "a")], "user_id int, login string")
    sink = spark.createDataFrame([("a", 1)], "login string, user_id long")
    assert R.differences(R.compare(source, sink)).isEmpty()
    assert R.differences(R.compare(*R.narrow(source, sink))).isEmpty()


def test_equal_counts_are_not_a_match(spark):
    row = R.summary(R.compare(*_pair(spark)), "t").first()
    assert (row.n_source, row.n_sink, row.n_missing, row.n_extra) == (5, 5, 3, 3)
    assert row.counts_equal and row.status == R.DIFFERS


def test_summary_of_empty_frames(spark):
    row = R.summary(R.compare(*_pair(spark, [], []))).first()
    assert (row.n_source, row.n_sink, row.n_missing, row.n_extra, row.status) == (0, 0, 0, 0, R.MATCH)


def test_summary_of_differences_agrees_with_summary(spark):
    source, sink = _pair(spark)
    compared = R.compare(source, sink)
    short = R.summary_of_differences(R.differences(compared), source.count(), "t").first()
    assert short.asDict() == R.summary(compared, "t").first().asDict()


def test_summaries_of_several_sinks(spark):
    source, sink = _pair(spark)
    found = {r.sink: r.status for r in R.summaries(source, {"same": source, "other": sink}).collect()}
    assert found == {"same": R.MATCH, "other": R.DIFFERS}


def test_null_positions_matter_to_the_digest(spark):
    schema = "a string, b string"
    source = spark.createDataFrame([("x", None)], schema)
    sink = spark.createDataFrame([(None, "x")], schema)
    assert R.missing(R.compare(*R.narrow(source, sink, buckets=1))).count() == 1


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=12),
    st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=12),
)
def test_narrowing_changes_no_result(spark, rows, left, right):
    source, sink = _pair(spark, left, right)
    narrowed = R.compare(*R.narrow(source, sink, buckets=8))
    assert rows(R.missing(narrowed)) == sorted((Counter(left) - Counter(right)).elements(), key=repr)
    assert rows(R.extra(narrowed)) == sorted((Counter(right) - Counter(left)).elements(), key=repr)


def test_copies_of_one_hot_row_are_all_kept(spark):
    counted = spark.createDataFrame([("hot", 250_001), ("cold", 2), ("edge", 100_000)], "k string, n long")
    found = R.repeat_rows(counted, "n", index="i").groupBy("k").agg({"*": "count", "i": "max"})
    assert {r.k: (r["count(1)"], r["max(i)"]) for r in found.collect()} == {
        "hot": (250_001, 250_001), "cold": (2, 2), "edge": (100_000, 100_000),
    }
    distinct = R.repeat_rows(counted, "n", index="i").distinct().count()
    assert distinct == 250_001 + 2 + 100_000


def test_copies_of_a_small_table_are_spread(spark):
    """A few rows in one task, each with fewer copies than a chunk may hold."""
    counted = spark.range(0, 40, 1, 1).selectExpr("id AS k", "5000L AS n")
    found = R.repeat_rows(counted, "n", index="i").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in found) == 200_000
    assert len(found) > 1 and max(r["count"] for r in found) < 150_000


def test_hot_row_is_combined_before_the_shuffle(spark):
    plan = R.compare(*_pair(spark))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") == 1


def _users(spark, n=20):
    return spark.range(n).selectExpr(
        "id AS user_id", "concat('u', id) AS login", "CAST(NULL AS STRING) AS gravatar_id",
        "'' AS avatar_url", "concat('x/', id) AS url",
    )


def test_repair_then_verify_finds_nothing_missing(spark):
    sink = file_sink("users", new_path(spark, "t"), USERS)
    users = tag(_users(spark), "r1")
    sink.write(users.filter("user_id >= 5").union(users.filter("user_id = 7")))
    first = verify(users, sink, "r1")
    second = verify(users, sink, "r1")
    assert first.repaired and not second.repaired
    assert first.summary.first().n_missing == 5
    assert (second.summary.first().n_missing, second.summary.first().n_extra) == (0, 1)


def test_verify_without_repair_and_with_buckets(spark):
    sink = file_sink("users", new_path(spark, "t"), USERS)
    users = tag(_users(spark), "r1")
    sink.write(users.filter("user_id <> 3"))
    found = verify(users, sink, "r1", repair=False, buckets=64)
    row = found.summary.first()
    assert not found.repaired
    assert (row.n_source, row.n_sink, row.n_missing, row.n_extra) == (20, 19, 1, 0)
    assert sink.read_run(spark, "r1").count() == 19


def test_runs_do_not_mix(spark):
    sink = file_sink("users", new_path(spark, "t"), USERS)
    load(_users(spark, 5), [sink], "r1")
    results = load(_users(spark, 8), [sink], "r2")
    assert results[0].summary.first().status == R.MATCH
    assert sink.read(spark).count() == 13


@pytest.mark.parametrize("run_id", ["r1", "2015-03-01 17:00", "a=b/c%20", "run 1"])
@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_run_names(spark, rows, run_id, file_format):
    sink = file_sink("users", new_path(spark, "t"), USERS, file_format)
    if run_id == "r1":
        assert sink.read_run(spark, run_id).isEmpty()
    sink.write(tag(_users(spark, 4), run_id))
    sink.write(tag(_users(spark, 7), "other"))
    assert rows(sink.read_run(spark, run_id)) == rows(tag(_users(spark, 4), run_id))
    assert sink.read(spark).count() == 11


def test_one_run_is_read_from_its_folder(spark):
    sink = file_sink("users", new_path(spark, "t"), USERS)
    for run_id in ("r1", "r2"):
        sink.write(tag(_users(spark, 4), run_id))
    assert all("run_id=r2" in f for f in sink.read_run(spark, "r2").inputFiles())


def test_resume_completes_a_half_written_run(spark, rows):
    done = file_sink("done", new_path(spark, "t"), USERS)
    half = file_sink("half", new_path(spark, "t"), USERS, "json")
    users = _users(spark)
    done.write(tag(users, "r1"))
    half.write(tag(users.filter("user_id < 4"), "r1"))
    resume(users, [done, half], "r1")
    for sink in (done, half):
        assert rows(sink.read_run(spark, "r1").drop("run_id")) == rows(users)


def test_empty_and_null_frames_are_not_written(spark):
    sink = file_sink("users", new_path(spark, "t"), USERS)
    assert write_all(None, [sink]) is None
    assert load(_users(spark, 0), [sink], "r1") == []
    sink.prepare(spark)
    assert sink.read(spark).count() == 0


def test_events_load_into_both_tables(spark, rows):
    path = new_path(spark, "events")
    spark.sql(
        """SELECT 'PushEvent' AS type, named_struct('id', 3000000000L, 'login', 'a', 'extra', 1) AS actor,
                  named_struct('id', 7L, 'name', 'r', 'url', 'x') AS repo"""
    ).write.json(path)
    users = file_sink("users", new_path(spark, "t"), USERS)
    repos = file_sink("repos", new_path(spark, "t"), REPOSITORIES)
    results = load_events(spark, path, [users], [repos], "r1")
    assert [r.status for r in combined(results["Users"] + results["Repositories"]).collect()] == [R.MATCH] * 2
    assert rows(users.read(spark)) == [(3000000000, "a", None, None, None, "r1")]
    assert rows(repos.read(spark)) == [(7, "r", "x", "r1")]


def test_loads_count_rows_while_they_write_them(spark, monkeypatch):
    """Source and sinks are each read once: by the writes, and by the comparison."""
    sink, events = file_sink("users", new_path(spark, "t"), USERS), []
    monkeypatch.setattr(R, "summary", lambda *a: events.append("scan"))
    frame = _users(spark, 7)
    counted = []
    monkeypatch.setattr(type(frame), "count", lambda self, real=type(frame).count: counted.append(1) or real(self))
    (result,) = load(frame, [sink], "r1")
    assert tuple(result.summary.first())[1:5] == (7, 7, 0, 0) and not counted and not events
    found = R.differences(R.compare(frame, frame))
    plan = R.summary_of_differences(stage(found, "found"), 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_a_load_that_broke_off_is_called_again(spark, rows, tmp_path):
    path = tmp_path / "events.json"
    path.write_text('{"actor":{"id":1,"login":"a"},"repo":{"id":7,"name":"r"}}\n{bad\n')
    users, repos, bad = (file_sink(n, new_path(spark, n), s) for n, s in (("u", USERS), ("r", REPOSITORIES), ("b", REFUSED)))

    class Broken(Sink):
        def write(self, df, mode="append"):
            raise ConnectionError("lost")

    broken = Broken(repos.name, repos.format, repos.options, repos.partition_by, repos.schema)
    with pytest.raises(ConnectionError):
        load_events(spark, str(path), [users], [broken], "r1", bad)
    for _ in range(2):
        results = load_events(spark, str(path), [users], [repos], "r1", bad, again=True)
    assert [r.status for found in results.values() for r in [x.summary.first() for x in found]] == [R.MATCH] * 3
    assert [s.read(spark).count() for s in (users, repos, bad)] == [1, 1, 1]


def _exchanged(frame):
    """Bytes that the exchanges of an executed frame wrote."""
    frame.collect()
    todo, total = [frame._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if node.nodeName().endswith("QueryStage"):
            node = node.plan()
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("dataSize").value()
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return total


def test_a_sketch_leaves_only_the_differing_rows(spark, rows):
    source = spark.range(0, 6000, 1, 4).selectExpr("id % 4000 AS user_id", "concat('user ', id % 4000) AS login")
    sink = source.filter("user_id % 500 <> 7").union(spark.createDataFrame([(1, "user 1")] * 3 + [(9, None)], SCHEMA))
    left = narrow_by_sketch(source, sink, cells=256)
    compared, whole = R.compare(*left), R.compare(source, sink)
    assert _exchanged(compared) * 50 < _exchanged(whole)
    assert rows(R.missing(compared)) == rows(R.missing(whole)) and rows(R.extra(compared)) == rows(R.extra(whole))
    assert R.missing(compared).count() == 12 and R.extra(compared).count() == 4


def test_a_sketch_that_is_too_small_gives_way_to_the_whole_comparison(spark):
    source, sink = spark.range(500).selectExpr("id AS user_id"), spark.range(300, 900).selectExpr("id AS user_id")
    assert narrow_by_sketch(source, sink, cells=16) == (source, sink)
    kept = narrow_by_sketch(source.union(source), source, cells=1024)
    assert R.missing(R.compare(*kept)).count() == 500
    same = narrow_by_sketch(source, source, cells=16)
    assert [s.count() for s in same] == [0, 0]
    with pytest.raises(ValueError, match="cells"):
        narrow_by_sketch(source, sink, cells=0)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.tuples(*[st.integers(0, (1 << 20) - 1)] * 5), st.integers(-3, 3), max_size=40))
def test_peeling_finds_every_digest_or_says_so(counts):
    table = {}
    for digest, n in counts.items():
        for cell in sketch._cells(digest, 32):
            sums = table.setdefault(cell, [0] * 7)
            for i, value in enumerate((1, *digest, sketch._check(digest))):
                sums[i] += n * value
    found = sketch.peeled([(c, *s) for c, s in table.items() if any(s)], 32)
    assert found is None or found == {d: n for d, n in counts.items() if n}
    assert found is not None or len(counts) > 10


def test_save_modes(spark):
    sink = Sink("s", "parquet", {"path": new_path(spark, "t")})
    df = _users(spark, 3)
    sink.write(df, "error")
    sink.write(df, "ignore")
    assert sink.read(spark).count() == 3
    sink.write(df, "append")
    assert sink.read(spark).count() == 6
    sink.write(df, "overwrite")
    assert sink.read(spark).count() == 3
    with pytest.raises(Exception):
        sink.write(df, "error")
    with pytest.raises(ValueError):
        checked_mode("upsert")
    with pytest.raises(ValueError):
        write_all(df, [sink], "upsert")


def test_table_sink_options():
    options = {"url": "jdbc:x", "dbtable": "Users"}
    assert "numPartitions" not in table_sink("users", options).options
    sink = table_sink("users", options, Split("user_id", 0, 1000, 20))
    assert sink.options["partitionColumn"] == "user_id"
    assert sink.format == "jdbc"
    assert sink.options["batchsize"] == "1000" and sink.options["rewriteBatchedStatements"] == "true"
    assert sink.options["numPartitions"] == "20"


@pytest.mark.parametrize("file_format", ["json", "parquet", "orc"])
def test_sink_keeps_every_value(spark, file_format):
    rows_in = spark.sql(
        """SELECT 1L AS id, timestamp'2024-01-02 03:04:05.123456' AS t, timestamp_ntz'2024-01-02 03:04:05.000001' AS n,
                  'q"\\\\\n' AS s, 0.1D AS d, true AS b
           UNION ALL SELECT NULL, NULL, NULL, '', -0.0D, NULL"""
    )
    sink = file_sink("s", new_path(spark, "t"), rows_in.schema, file_format)
    found = load(rows_in, [sink], "r1")[0]
    assert not found.repaired and found.summary.first().status == R.MATCH


def test_maps_can_be_compared(spark):
    source = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('a', 1)")
    sink = spark.sql("SELECT map('b', 2, 'a', 1) AS m")
    assert [r.m for r in R.missing(R.compare(source, sink)).collect()] == [{"a": 1}]


def _staged(spark):
    return [path for path, _ in matching(spark, f"{shared_dir(spark)}/syncspark/*")]


def test_nothing_stays_staged_after_a_load(spark, tmp_path):
    before = set(_staged(spark))
    sink = file_sink("a", str(tmp_path / "a"), USERS)
    found = load(_users(spark, 8), [sink], "r1")
    assert combined(found).first().status == R.MATCH and found[0].differences.isEmpty()
    resume(_users(spark, 9), [sink], "r1")
    assert verify(tag(_users(spark, 9), "r1"), sink, "r1").summary.first().status == R.MATCH
    # The one difference that resume repaired is still there to be looked at.
    left = set(_staged(spark)) - before
    assert len(left) == 1 and "differences" in left.pop()


def test_damaged_events_are_refused(spark, rows, tmp_path):
    lines = [
        '{"actor":{"id":1,"login":"a"},"repo":{"id":10,"name":"r"}}',
        '{"actor":{"id":2,"login":null},"repo":{"id":11,"name":"s"}}',
        '{"actor":{"id":"x","login":"c"},"repo":{"id":12,"name":"t"}}',
        "{bad",
        '{"actor":{"id":3,"login":"' + "l" * 256 + '"},"repo":{"id":13}}',
        "",
    ]
    path = tmp_path / "events.json"
    path.write_text("\n".join(lines))
    sinks = [file_sink(n, str(tmp_path / n), s) for n, s in (("u", USERS), ("r", REPOSITORIES), ("x", REFUSED))]
    with pytest.raises(ValueError, match="refused"):
        load_events(spark, str(path), [sinks[0]], [sinks[1]], "r1")
    assert not (tmp_path / "u").exists()
    load_events(spark, str(path), [sinks[0]], [sinks[1]], "r1", sinks[2])
    assert [r.user_id for r in sinks[0].read(spark).collect()] == [1]
    assert sorted(r.repo_id for r in sinks[1].read(spark).collect()) == [10, 11]
    found = sorted((r.target, r.violations) for r in sinks[2].read(spark).collect())
    assert found == [
        ("Repositories", "name is null"), ("Users", "login is null"), ("Users", "login longer than 255"),
        ("event", "malformed line"), ("event", "malformed line"),
    ]


def test_number_of_buckets_is_bounded(spark):
    with pytest.raises(ValueError, match="buckets"):
        R.narrow(*_pair(spark), buckets=1 << 21)
