from collections import Counter
from random import Random

import pytest
from pyspark.sql import functions as F

from syncspark.operators.incremental import Cursor, last_position, next_cursor, not_yet_seen, rows_after
from syncspark.operators.sequence import (
    assign_sequence,
    copies_before,
    distinct_numbers,
    latest_per_key,
    latest_rows,
    missing_by_bitmap,
    missing_by_number,
)
from syncspark.operators.snapshot import after_log, before_log, snapshot_diff

USERS = "user_id long, login string, url string"
BEFORE = [(1, "a", None), (2, "b", "x"), (3, "c", None), (4, "d", "y")]
AFTER = [(1, "a", None), (2, "b", None), (4, "D", "y"), (5, "e", "z")]


def _snapshots(spark, before=BEFORE, after=AFTER):
    return spark.createDataFrame(before, USERS), spark.createDataFrame(after, USERS)


def _plain(diff):
    return {r.user_id: (r.state, r.old and tuple(r.old), r.new and tuple(r.new)) for r in diff.collect()}


@pytest.mark.parametrize("unique", [True, False])
def test_diff_has_both_images(spark, unique):
    assert _plain(snapshot_diff(*_snapshots(spark), key=["user_id"], unique=unique)) == {
        2: ("UPDATE", ("b", "x"), ("b", None)),
        3: ("DELETE", ("c", None), None),
        4: ("UPDATE", ("d", "y"), ("D", "y")),
        5: ("INSERT", None, ("e", "z")),
    }


@pytest.mark.parametrize("unique", [True, False])
def test_diff_of_a_snapshot_with_itself_is_empty(spark, unique):
    before, _ = _snapshots(spark)
    assert snapshot_diff(before, before, ["user_id"], unique).isEmpty()


def test_logs(spark, rows):
    diff = snapshot_diff(*_snapshots(spark), key=["user_id"])
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    assert rows(before_log(diff)) == [(2, "b", "x", "UPDATE"), (3, "c", None, "DELETE"), (4, "d", "y", "UPDATE")]
    assert rows(after_log(diff)) == [(2, "b", None, "UPDATE"), (4, "D", "y", "UPDATE"), (5, "e", "z", "INSERT")]
    assert after_log(diff, at).columns == ["user_id", "login", "url", "state", "log_timestamp"]
    assert after_log(diff, include_deletes=True).filter("state = 'DELETE'").count() == 1


def test_repeated_key_fails_instead_of_losing_rows(spark):
    frames = _snapshots(spark, [(1, "a", None), (1, "b", None)], [(1, "c", None)])
    with pytest.raises(Exception, match="key is not unique"):
        snapshot_diff(*frames, key=["user_id"]).collect()
    same = _snapshots(spark, [(1, "a", None), (1, "a", None)], [(1, "a", None)] * 4)
    with pytest.raises(Exception, match="key is not unique"):
        snapshot_diff(*same, key=["user_id"]).collect()


def test_rows_without_unique_key_are_paired_one_to_one(spark, rows):
    before = [(1, "a", None)] * 3 + [(1, "b", None), (2, "x", None), (None, "n", None)]
    after = [(1, "a", None), (1, "c", None), (None, "m", None), (None, "k", None)]
    diff = snapshot_diff(*_snapshots(spark, before, after), key=["user_id"], unique=False)
    counts = {(r.user_id, r.state): r["count"] for r in diff.groupBy("user_id", "state").count().collect()}
    assert counts == {(1, "UPDATE"): 1, (1, "DELETE"): 2, (2, "DELETE"): 1, (None, "UPDATE"): 1, (None, "INSERT"): 1}
    # Applying the changes to the first snapshot gives the second.
    olds = diff.filter("old IS NOT NULL").select("user_id", "old.*")
    news = diff.filter("new IS NOT NULL").select("user_id", "new.*")
    first, second = _snapshots(spark, before, after)
    assert rows(first.exceptAll(olds).union(news)) == rows(second)


def test_random_snapshots(spark, rows):
    random = Random(3)

    def snapshot():
        return [
            (random.choice([None, *range(40)]), random.choice(["a", "b", None]), random.choice(["x", None]))
            for _ in range(random.randint(300, 400))
        ]

    before, after = snapshot(), snapshot()
    gone, come = Counter(before) - Counter(after), Counter(after) - Counter(before)
    first, second = _snapshots(spark, before, after)
    diff = snapshot_diff(first, second, key=["user_id"], unique=False)
    found = {(r.user_id, r.state): r["count"] for r in diff.groupBy("user_id", "state").count().collect()}
    expected = {}
    for key in {r[0] for r in before + after}:
        n_old = sum(n for r, n in gone.items() if r[0] == key)
        n_new = sum(n for r, n in come.items() if r[0] == key)
        both = min(n_old, n_new)
        for state, n in (("UPDATE", both), ("DELETE", n_old - both), ("INSERT", n_new - both)):
            if n:
                expected[key, state] = n
    assert found == expected
    olds = diff.filter("old IS NOT NULL").select("user_id", "old.*")
    news = diff.filter("new IS NOT NULL").select("user_id", "new.*")
    assert rows(olds) == sorted(gone.elements(), key=repr)
    assert rows(news) == sorted(come.elements(), key=repr)


def test_one_key_with_a_third_of_all_rows(spark):
    hot = [(1, f"row {i}", None) for i in range(400)] + [(1, "copy", None)] * 300
    before = hot + [(i, "cold", None) for i in range(2, 1400)]
    after = [(1, f"new {i}", None) for i in range(500)] + [(i, "cold", None) for i in range(2, 1400)]
    diff = snapshot_diff(*_snapshots(spark, before, after), key=["user_id"], unique=False)
    counts = {r.state: r["count"] for r in diff.groupBy("state").count().collect()}
    assert counts == {"UPDATE": 500, "DELETE": 200}


@pytest.mark.parametrize("hot", [0, 3, 10**6])
def test_copies_before_is_a_running_total_per_group(spark, hot):
    df = spark.range(300).selectExpr("id % 3 AS k", "id", "id % 4 + 1 AS n")
    placed = copies_before(df, ["k"], "n", "first", hot=hot).collect()
    for k in range(3):
        group = sorted((r["first"], r.n) for r in placed if r.k == k)
        expected = 0
        for first, n in group:
            assert first == expected
            expected += n


def test_sequence_equals_global_row_number(spark):
    df = spark.range(5000).selectExpr("hash(id) % 700 AS t", "id").repartition(7)
    found = assign_sequence(df, ["t", "id"], start=10).orderBy("seq").collect()
    expected = sorted((r.t, r.id) for r in df.collect())
    assert [(r.t, r.id) for r in found] == expected
    assert [r.seq for r in found] == list(range(11, 5011))


def test_only_partition_sizes_meet_in_one_task(spark):
    numbered = assign_sequence(spark.range(1000).selectExpr("id", "id % 7 AS t"), ["t", "id"])
    lines = numbered._jdf.queryExecution().executedPlan().toString().split("\n")
    at = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(at) == 1 and "HashAggregate(keys=[_part" in lines[at[0] + 1]


def test_sequence_with_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3)], "t string, id int")
    assert [(r.t, r.seq) for r in assign_sequence(df, ["t"]).orderBy("seq").collect()] == [(None, 1), ("a", 2), ("b", 3)]
    assert assign_sequence(df.limit(0), ["t"]).count() == 0


def test_sequence_of_copies_has_no_gap(spark):
    df = spark.range(3000).selectExpr("IF(id < 1000, 0, id % 50) AS t", "id % 3 AS x")
    found = assign_sequence(df, ["t"], unique=False).orderBy("seq").collect()
    assert [r.seq for r in found] == list(range(1, 3001))
    assert [r.t for r in found] == sorted(r.t for r in df.collect())


def test_latest_rows_and_numbers(spark, rows):
    df = spark.range(1, 2001).withColumnRenamed("id", "seq")
    assert [r.seq for r in latest_rows(df).orderBy("seq").collect()] == list(range(1001, 2001))
    assert "TakeOrderedAndProject" in latest_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert distinct_numbers(df.union(df)).count() == 2000


def test_latest_per_key_keeps_whole_records(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, None), (1, 2, "c"), (None, 1, "n")], "k int, seq int, v string")
    assert rows(latest_per_key(df, ["k"], ["seq"])) == [(1, 3, None), (None, 1, "n")]


def test_missing_by_number(spark, rows):
    sent = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "seq long, v string")
    received = spark.createDataFrame([(2,), (2,), (9,), (None,)], "seq long")
    assert rows(missing_by_number(sent, received)) == [(1, "a"), (3, None)]
    assert missing_by_number(sent, sent).isEmpty()
    assert rows(missing_by_number(sent, received.limit(0))) == rows(sent)


LOG = [(1, "2024-01-01 00:00:00.001"), (2, "2024-01-01 00:00:00.001"), (3, "2024-01-01 00:00:00.002"), (4, None)]


def _log(spark):
    df = spark.createDataFrame(LOG, "id long, t string")
    return df.select("id", F.col("t").cast("timestamp").alias("log_timestamp"))


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_rows_after_cursor(spark):
    log = _log(spark)
    assert _ids(rows_after(log, Cursor())) == [1, 2, 3, 4]
    assert _ids(rows_after(log, Cursor(" "))) == [1, 2, 3, 4]
    assert _ids(rows_after(log, Cursor("2024-01-01 00:00:00.001000"))) == [3]
    assert _ids(rows_after(log, Cursor("2024-01-01 00:00:00.001", 1), key="id")) == [2, 3]


def test_overlap_catches_late_rows_once(spark):
    log = _log(spark)
    pulled = rows_after(log, Cursor("2024-01-01 00:00:00.002"), overlap="1 second")
    assert _ids(not_yet_seen(pulled, log.filter("id IN (1, 3)"), ["id"])) == [2]


def test_next_cursor(spark):
    log = _log(spark)
    start = Cursor("2023-01-01 00:00:00.000000", 5)
    assert tuple(next_cursor(log, start).first()) == ("2024-01-01 00:00:00.002000",)
    assert tuple(next_cursor(log, start, key="id").first()) == ("2024-01-01 00:00:00.002000", 3)
    assert tuple(next_cursor(log.limit(0), start, key="id").first()) == tuple(start)
    assert tuple(next_cursor(log.limit(0), Cursor()).first()) == ("",)
    assert last_position(log.limit(0)).first()[0] is None
    assert tuple(last_position(log.filter("id = 4"), key="id").first()) == (None, None)


def test_cursor_filter_reaches_the_scan(spark, tmp_path):
    _log(spark).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    plan = rows_after(log, Cursor("2024-01-01 00:00:00.001", 1), key="id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(log_timestamp" in plan


@pytest.mark.parametrize("select", [lambda d: d.count(), lambda d: d.select("user_id", "new").collect(), lambda d: d.collect()])
def test_repeated_changed_key_fails_whatever_is_selected(spark, select):
    before, after = _snapshots(spark, [(1, "a", None)], [(1, "b", None), (1, "c", None)])
    with pytest.raises(Exception, match="key is not unique"):
        select(snapshot_diff(before, after, key=["user_id"]))


def test_repeats_with_an_unchanged_row_need_the_check_of_all_rows(spark):
    from syncspark.operators.snapshot import require_unique

    before, after = _snapshots(spark, [(1, "a", None), (1, "b", None)], [(1, "a", None), (1, "c", None)])
    assert _plain(snapshot_diff(before, after, key=["user_id"])) == {1: ("UPDATE", ("b", None), ("c", None))}
    with pytest.raises(ValueError, match="user_id"):
        require_unique(before, ["user_id"])
    once = after.filter("login = 'c'")
    assert require_unique(once, ["user_id"]) is once


def test_tied_positions_are_spread(spark):
    df = spark.range(20_000).selectExpr("1 AS t", "id").repartition(4)
    # Without merging of small partitions, as with partitions of a usual size.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = assign_sequence(df, ["t"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.seq for r in numbered.collect()) == list(range(1, 20_001))
    shares = [spark.read.parquet(f).count() for f in numbered.inputFiles()]
    assert len(shares) > 4 and max(shares) < 8_000


def test_missing_numbers_by_bitmap(spark):
    """Below, at and above zero, at the ends of ranges, repeated, null, and in ranges of one side only."""
    r = Random(3)
    sent = [*range(-40, 40), *range(32_760, 32_780), *range(65_530, 65_540), 98_304, 10**12, -(10**9), -32_768, -32_767, None, 5, 5]
    received = [n for n in sent if n is not None and r.random() < 0.6] + [None, 7, 7, 10**6]
    numbers = lambda rows: spark.createDataFrame([(n, "x") for n in rows], "seq long, payload string").repartition(3)
    found = missing_by_bitmap(numbers(sent), numbers(received))
    assert sorted(r.seq for r in found.collect()) == sorted({n for n in sent if n is not None} - set(received))
    assert missing_by_bitmap(numbers(sent), numbers(sent)).isEmpty()


def test_numbers_travel_as_one_row_for_each_range(spark):
    sent = spark.range(0, 200_000, 1, 2).withColumnRenamed("id", "seq")
    frame = missing_by_bitmap(sent, sent.filter("seq % 1000 <> 1"))
    assert frame.count() == 200
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan and "Cartesian" not in plan
