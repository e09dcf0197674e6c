"""Change log: pulls, numbers, comparison by number and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from syncspark.functions.messages import accepted, decode
from syncspark.functions.scalars import format_micros, to_millis
from syncspark.operators.incremental import Cursor, last_position, next_cursor, not_yet_seen, rows_after
from syncspark.operators.reconcile import compare, missing
from syncspark.operators.sequence import (
    assign_sequence,
    distinct_numbers,
    latest_per_key,
    latest_rows,
    missing_by_bitmap,
    missing_by_number,
)
from syncspark.operators.snapshot import after_log, before_log, snapshot_diff
from syncspark.queries.inputs import (
    CHANGE_LOG_SQL,
    SNAPSHOTS_SQL,
    change_log,
    messages,
    snapshots,
    table,
)
from syncspark.queries.messages import ACCEPTED_SQL
from syncspark.queries.registry import query
from syncspark.workspace import stage

_TIME = "2024-01-10 00:00:00.000000"
_LOG_COLUMNS = "event_id, user_id, state, strftime(log_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS log_timestamp, payload"


def _shown(log: DataFrame) -> DataFrame:
    return log.withColumn("log_timestamp", format_micros(F.col("log_timestamp")))


@query(f"WITH {CHANGE_LOG_SQL} SELECT {_LOG_COLUMNS} FROM change_log WHERE log_timestamp > TIMESTAMP '{_TIME}'")
def incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(rows_after(change_log(spark, sf_dir), Cursor(_TIME)))


@query(f"WITH {CHANGE_LOG_SQL} SELECT {_LOG_COLUMNS} FROM change_log")
def incremental_read_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(rows_after(change_log(spark, sf_dir), Cursor("  ")))


# Orders share their dates, so a position needs the key as well.
@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-06-15 00:00:00', 100)"""
)
def incremental_read_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    cursor = Cursor("1998-06-15 00:00:00", 100)
    return rows_after(orders, cursor, time="o_orderdate", key="o_orderkey").drop("o_orderdate")


@query(
    f"""WITH {CHANGE_LOG_SQL} SELECT {_LOG_COLUMNS} FROM change_log
    WHERE log_timestamp > TIMESTAMP '{_TIME}'
       OR (state = 'signup' AND log_timestamp >= TIMESTAMP '2024-01-09 00:00:00')"""
)
def incremental_read_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups of the last day had not been committed at the last pull."""
    log, cursor = change_log(spark, sf_dir), Cursor(_TIME)
    pulled = rows_after(log, cursor, overlap="1 day")
    # Only the time read again has to be searched for rows handled before.
    late = F.col("log_timestamp") <= F.lit(_TIME).cast("timestamp_ntz")
    handled = pulled.filter(late & (F.col("state") != "signup"))
    return _shown(not_yet_seen(pulled, handled, ["event_id"]))


@query(
    f"""WITH {CHANGE_LOG_SQL}
    SELECT coalesce(strftime(max(log_timestamp), '%Y-%m-%d %H:%M:%S.%f'), '{_TIME}') AS cursor,
           arg_max(event_id, (log_timestamp, event_id)) AS cursor_key
    FROM change_log WHERE log_timestamp > TIMESTAMP '{_TIME}'"""
)
def next_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    cursor = Cursor(_TIME)
    return next_cursor(rows_after(change_log(spark, sf_dir), cursor), cursor, key="event_id")


@query("SELECT '2100-01-01 00:00:00.000000' AS cursor, CAST(7 AS BIGINT) AS cursor_key FROM (SELECT count(*) FROM events)")
def next_position_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing lies past the cursor, so it stays."""
    cursor = Cursor("2100-01-01 00:00:00.000000", 7)
    log = change_log(spark, sf_dir)
    return next_cursor(rows_after(log, cursor, key="event_id"), cursor, key="event_id")


@query(
    """SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS cursor FROM orders WHERE o_orderstatus = 'F'"""
)
def last_sent_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greatest time of the records that have one."""
    sent = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("log_timestamp")
    )
    return last_position(sent)


_SENT_SQL = f"""{CHANGE_LOG_SQL},
sent AS (
    SELECT *, row_number() OVER (ORDER BY log_timestamp, event_id) AS seq FROM change_log)"""
_SENT_COLUMNS = f"{_LOG_COLUMNS}, seq"


def _sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_sequence(change_log(spark, sf_dir), ["log_timestamp", "event_id"])


@query(f"WITH {_SENT_SQL} SELECT {_SENT_COLUMNS} FROM sent")
def sent_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_sent(spark, sf_dir))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
           1000 + row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS seq
    FROM lineitem"""
)
def line_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that go on from an earlier round."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select(*order)
    return assign_sequence(lines, order, start=1000).drop("l_shipdate")


@query(
    """SELECT l_shipdate, l_returnflag, min(seq) AS first_seq, max(seq) AS last_seq, count(DISTINCT seq) AS n
    FROM (SELECT CAST(l_shipdate AS VARCHAR) AS l_shipdate, l_returnflag,
                 row_number() OVER (ORDER BY l_shipdate, l_returnflag) AS seq FROM lineitem)
    GROUP BY 1, 2"""
)
def sequence_of_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal rows are numbered too; the range of each group of copies is fixed."""
    rows = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_returnflag")
    numbered = assign_sequence(rows, ["l_shipdate", "l_returnflag"], unique=False)
    # Different numbers are counted in bitmaps, so no task holds them one by one.
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("seq")).alias("bits")
    ranges = numbered.groupBy("l_shipdate", "l_returnflag", F.bitmap_bucket_number("seq").alias("bucket")).agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), bits
    )
    return (
        ranges.groupBy("l_shipdate", "l_returnflag")
        .agg(F.min("first_seq").alias("first_seq"), F.max("last_seq").alias("last_seq"), F.sum(F.bitmap_count("bits")).alias("n"))
        .withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    )


@query(
    f"""SELECT event_id, login, row_number() OVER (ORDER BY event_id) AS seq FROM ({ACCEPTED_SQL})"""
)
def received_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Received messages are numbered in arrival order; refused ones are not counted."""
    rows = accepted(decode(messages(spark, sf_dir)), keep=["event_id"])
    return assign_sequence(stage(rows.select("event_id", "login"), "received"), ["event_id"])


@query(f"WITH {_SENT_SQL} SELECT {_SENT_COLUMNS} FROM sent ORDER BY seq DESC LIMIT 1000")
def latest_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the last records are numbered, backwards from the number of all of them."""
    log = change_log(spark, sf_dir)
    last = stage(latest_rows(log, ["log_timestamp", "event_id"]), "latest")
    first = log.count() - last.count()
    return _shown(assign_sequence(last, ["log_timestamp", "event_id"], start=first))


@query(f"WITH {_SENT_SQL} SELECT {_SENT_COLUMNS} FROM sent WHERE state = 'error'")
def missing_by_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors got lost on the way; clicks arrived twice."""
    sent = _sent(spark, sf_dir)
    arrived = sent.filter(F.col("state") != "error").select("seq")
    received = arrived.union(sent.filter(F.col("state") == "click").select("seq"))
    return _shown(missing_by_number(sent, received))


@query(
    f"""WITH {CHANGE_LOG_SQL},
    sent AS (SELECT user_id, state FROM change_log),
    received AS (SELECT user_id, state FROM change_log WHERE log_timestamp < TIMESTAMP '{_TIME}' OR state = 'view')
    SELECT * FROM sent EXCEPT ALL SELECT * FROM received"""
)
def missing_by_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records are equal when their contents are; the numbers play no part."""
    sent = change_log(spark, sf_dir).drop("event_id", "payload")
    early = F.col("log_timestamp") < F.lit(_TIME).cast("timestamp_ntz")
    received = sent.filter(early | (F.col("state") == "view"))
    return missing(compare(sent.select("user_id", "state"), received))


@query("SELECT l_orderkey * 8 + l_linenumber AS seq FROM lineitem GROUP BY 1 HAVING bool_and(l_partkey % 5 = 0)")
def missing_by_bitmap_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth part's lines got lost, every seventh's arrived twice; compared as sets of numbers."""
    number = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq")
    sent = table(spark, sf_dir, "lineitem").select(number, "l_partkey")
    arrived = sent.filter(F.col("l_partkey") % 5 != 0)
    return missing_by_bitmap(sent, arrived.union(sent.filter((F.col("l_partkey") % 7 == 0) & (F.col("l_partkey") % 5 != 0))))


@query("SELECT DISTINCT l_orderkey AS seq FROM lineitem")
def distinct_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_numbers(table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "seq"))


@query(
    f"""WITH {CHANGE_LOG_SQL}
    SELECT {_LOG_COLUMNS} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY log_timestamp DESC, event_id DESC) AS place
        FROM change_log) WHERE place = 1"""
)
def latest_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(latest_per_key(change_log(spark, sf_dir), ["user_id"], ["log_timestamp", "event_id"]))


_DIFF_SQL = f"""{SNAPSHOTS_SQL},
diff AS (
    SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
           CASE WHEN a.o_orderkey IS NULL THEN 'DELETE' WHEN b.o_orderkey IS NULL THEN 'INSERT'
                ELSE 'UPDATE' END AS state,
           b.o_custkey AS old_custkey, b.o_orderstatus AS old_status, b.o_orderpriority AS old_priority,
           a.o_custkey AS new_custkey, a.o_orderstatus AS new_status, a.o_orderpriority AS new_priority
    FROM before_orders b FULL JOIN after_orders a ON a.o_orderkey = b.o_orderkey
    WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL
       OR b.o_custkey IS DISTINCT FROM a.o_custkey OR b.o_orderstatus IS DISTINCT FROM a.o_orderstatus
       OR b.o_orderpriority IS DISTINCT FROM a.o_orderpriority)"""


def _diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_diff(*snapshots(spark, sf_dir), key=["o_orderkey"])


@query(f"WITH {_DIFF_SQL} SELECT * FROM diff")
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = [
        F.col(f"{side}.o_{field}").alias(f"{side}_{short}")
        for side in ("old", "new")
        for field, short in (("custkey", "custkey"), ("orderstatus", "status"), ("orderpriority", "priority"))
    ]
    return _diff(spark, sf_dir).select("o_orderkey", "state", *images)


def _log_time() -> Column:
    return to_millis(F.lit("2024-02-01 12:00:00.123456").cast("timestamp_ntz"))


def _log_sql(side: str, states: str) -> str:
    return f"""WITH {_DIFF_SQL}
    SELECT o_orderkey, {side}_custkey AS o_custkey, {side}_status AS o_orderstatus,
           {side}_priority AS o_orderpriority, state, '2024-02-01 12:00:00.123000' AS log_timestamp
    FROM diff WHERE state IN ({states})"""


@query(_log_sql("old", "'UPDATE', 'DELETE'"))
def snapshot_before_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(before_log(_diff(spark, sf_dir), at=_log_time()))


@query(_log_sql("new", "'UPDATE', 'INSERT'"))
def snapshot_after_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(after_log(_diff(spark, sf_dir), at=_log_time()))


@query(
    f"""{_log_sql('new', "'UPDATE', 'INSERT'")}
    UNION ALL SELECT o_orderkey, old_custkey, old_status, old_priority, state, '2024-02-01 12:00:00.123000'
    FROM diff WHERE state = 'DELETE'"""
)
def snapshot_after_log_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(after_log(_diff(spark, sf_dir), at=_log_time(), include_deletes=True))


# Lines of an order have no key of their own here, so rows are paired per order.
@query(
    """WITH b AS (SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem
                  WHERE l_shipdate < TIMESTAMP '2001-01-01 00:00:00'),
    a AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN l_quantity + 100 ELSE l_quantity END AS l_quantity,
                 l_returnflag FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'),
    gone AS (SELECT l_orderkey, count(*) AS n FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY 1),
    come AS (SELECT l_orderkey, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY 1),
    paired AS (SELECT coalesce(gone.l_orderkey, come.l_orderkey) AS l_orderkey,
                    coalesce(gone.n, 0) AS n_old, coalesce(come.n, 0) AS n_new
             FROM gone FULL JOIN come ON gone.l_orderkey = come.l_orderkey)
    SELECT l_orderkey, least(n_old, n_new) AS n_update, n_old - least(n_old, n_new) AS n_delete,
           n_new - least(n_old, n_new) AS n_insert
    FROM paired"""
)
def snapshot_changes_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    raised = F.when(F.col("l_returnflag") == "R", F.col("l_quantity") + 100).otherwise(F.col("l_quantity"))
    shipped = F.col("l_shipdate")
    before = lines.filter(shipped < F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")).select(
        "l_orderkey", "l_quantity", "l_returnflag"
    )
    after = lines.filter(shipped >= F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")).select(
        "l_orderkey", raised.alias("l_quantity"), "l_returnflag"
    )
    diff = snapshot_diff(before, after, key=["l_orderkey"], unique=False)
    return diff.groupBy("l_orderkey").agg(
        *(F.count_if(F.col("state") == s).alias(f"n_{s.lower()}") for s in ("UPDATE", "DELETE", "INSERT"))
    )
