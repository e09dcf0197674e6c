"""Scans, projections, sinks and comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncspark.operators.project import (
    align,
    first_match,
    preview,
    repositories_of,
    tag,
    tagged_with,
    users_of,
    with_column_if_missing,
    without_column,
)
from syncspark.operators.reconcile import compare, extra, missing, narrow, summary
from syncspark.operators.sketch import narrow_by_sketch
from syncspark.plans.load import combined, load, load_events, verify
from syncspark.queries.inputs import (
    EVENT_REPOS_SQL,
    EVENT_USERS_SQL,
    REPOSITORIES_SQL,
    USERS_SINK_SQL,
    USERS_SQL,
    raw_events,
    repositories,
    table,
    users,
    users_sink,
)
from syncspark.queries.registry import query
from syncspark.schemas import REFUSED, REPOSITORIES, USERS
from syncspark.sources.readers import even_ranges, read_collection, read_events
from syncspark.sources.sinks import Sink, file_sink
from syncspark.workspace import new_path


def _scanned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "events-json")
    raw_events(spark, sf_dir).write.json(path)
    return read_events(spark, path)


@query(f"WITH {EVENT_USERS_SQL} SELECT * FROM event_users")
def json_scan_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_of(_scanned_events(spark, sf_dir))


@query(f"WITH {EVENT_REPOS_SQL} SELECT * FROM event_repos")
def json_scan_repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repositories_of(_scanned_events(spark, sf_dir))


@query(f"WITH {USERS_SQL} SELECT *, 'run 1' AS run_id FROM users")
def tagged_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag(users(spark, sf_dir), "run 1")


@query(f"WITH {REPOSITORIES_SQL} SELECT name, repo_id, url FROM repositories")
def aligned_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = tag(repositories(spark, sf_dir), "run 1")
    return align(wide, ["name", "repo_id", "url"])


@query(
    f"""WITH {USERS_SQL}
    SELECT user_id, login, avatar_url, url, CAST(NULL AS VARCHAR) AS run_id FROM users"""
)
def add_drop_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    widened = with_column_if_missing(users(spark, sf_dir), "run_id", "string")
    again = with_column_if_missing(widened, "login", "string")
    return without_column(without_column(again, "gravatar_id"), "absent")


@query(f"WITH {EVENT_USERS_SQL} SELECT user_id, login, url FROM event_users")
def unset_nested_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    trimmed = without_column(raw_events(spark, sf_dir), "actor.gravatar_id")
    return trimmed.select(
        F.col("actor.id").alias("user_id"), F.col("actor.login").alias("login"), F.col("actor.url").alias("url")
    )


@query(f"WITH {USERS_SQL} SELECT * FROM users")
def marker_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one run, out of a sink that also holds those of another."""
    sink = file_sink("users", new_path(spark, "marked"), USERS)
    sink.write(tag(users(spark, sf_dir), "run 1"))
    sink.write(tag(users_sink(spark, sf_dir), "run 2"))
    return without_column(sink.read_run(spark, "run 1"), "run_id")


@query(f"WITH {USERS_SQL} SELECT * FROM users WHERE user_id = 1 LIMIT 1")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_match(users(spark, sf_dir), "user_id", 1)


@query(f"WITH {USERS_SQL} SELECT * FROM users ORDER BY user_id LIMIT 5")
def preview_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(users(spark, sf_dir), 5, order=["user_id"])


# Every seventh order's line ends early, every eleventh's actor has no login.
_DAMAGED_SQL = """numbered AS (SELECT o_orderkey, o_custkey FROM orders)
    SELECT 'Users' AS target, CAST(o_custkey AS VARCHAR) AS value, NULL AS violations
    FROM numbered WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0
    UNION ALL SELECT 'Repositories', CAST(o_orderkey AS VARCHAR), NULL FROM numbered WHERE o_orderkey % 7 <> 0
    UNION ALL SELECT 'refused event', '{"actor":{"id":' || o_custkey, 'malformed line' FROM numbered WHERE o_orderkey % 7 = 0
    UNION ALL SELECT 'refused Users', CAST(o_custkey AS VARCHAR), 'login is null'
    FROM numbered WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0"""


@query(f"WITH {_DAMAGED_SQL}")
def load_damaged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of damaged JSON lines accepts, and what it refuses and why."""
    path = new_path(spark, "events-text")
    key = F.col("repo.id")
    login = F.when(key % 11 != 0, F.col("actor.login"))
    events = raw_events(spark, sf_dir).withColumn("actor", F.col("actor").withField("login", login))
    whole = F.to_json(F.struct("actor", "repo"))
    early = F.concat(F.lit('{"actor":{"id":'), F.col("actor.id").cast("string"))
    events.select(F.when(key % 7 == 0, early).otherwise(whole).alias("value")).write.text(path)
    sinks = {
        "Users": file_sink("users", new_path(spark, "users"), USERS),
        "Repositories": file_sink("repositories", new_path(spark, "repositories"), REPOSITORIES),
        "refused": file_sink("refused", new_path(spark, "refused"), REFUSED),
    }
    load_events(spark, path, [sinks["Users"]], [sinks["Repositories"]], "run 1", sinks["refused"])
    accepted = [
        sinks[name].read(spark).select(F.lit(name).alias("target"), F.col(key).cast("string").alias("value"), F.lit(None).cast("string").alias("violations"))
        for name, key in (("Users", "user_id"), ("Repositories", "repo_id"))
    ]
    refused = sinks["refused"].read(spark).select(
        F.concat(F.lit("refused "), "target").alias("target"),
        F.coalesce(F.get_json_object("value", "$.user_id"), "value").alias("value"),
        "violations",
    )
    return accepted[0].union(accepted[1]).union(refused)


_BOTH = f"WITH {USERS_SQL}, {USERS_SINK_SQL}"
_MISSING = "SELECT * FROM users EXCEPT ALL SELECT * FROM users_sink"
_EXTRA = "SELECT * FROM users_sink EXCEPT ALL SELECT * FROM users"


@query(f"{_BOTH} {_MISSING}")
def reconcile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing(compare(users(spark, sf_dir), users_sink(spark, sf_dir)))


@query(f"{_BOTH} {_EXTRA}")
def reconcile_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extra(compare(users(spark, sf_dir), users_sink(spark, sf_dir)))


def _summary_sql(source: str, sink: str, name: str) -> str:
    return f"""SELECT sink, n_source, n_sink, n_missing, n_extra, n_source = n_sink AS counts_equal,
           CASE WHEN n_missing = 0 AND n_extra = 0 THEN 'match' ELSE 'differs' END AS status
    FROM (SELECT '{name}' AS sink,
                 (SELECT count(*) FROM {source}) AS n_source, (SELECT count(*) FROM {sink}) AS n_sink,
                 (SELECT count(*) FROM (SELECT * FROM {source} EXCEPT ALL SELECT * FROM {sink})) AS n_missing,
                 (SELECT count(*) FROM (SELECT * FROM {sink} EXCEPT ALL SELECT * FROM {source})) AS n_extra)"""


@query(f"{_BOTH} {_summary_sql('users', 'users_sink', 'users')}")
def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(compare(users(spark, sf_dir), users_sink(spark, sf_dir)), "users")


# Line items as a sink that lost the returned rows of 1996 and has discounts of
# late shipments changed.
_LINES = """WITH late_lines AS (
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           CASE WHEN l_shipdate >= TIMESTAMP '2001-06-01 00:00:00' THEN 0.5 ELSE l_discount END AS l_discount,
           l_tax, l_returnflag, l_linestatus, l_shipdate
    FROM lineitem
    WHERE NOT (l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'
               AND l_shipdate < TIMESTAMP '1997-01-01 00:00:00'))"""


def _line_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    shipped = F.col("l_shipdate")
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    lost = (
        (F.col("l_returnflag") == "R")
        & (shipped >= at("1996-01-01 00:00:00"))
        & (shipped < at("1997-01-01 00:00:00"))
    )
    changed = F.when(shipped >= at("2001-06-01 00:00:00"), 0.5).otherwise(F.col("l_discount"))
    return lines, lines.filter(~lost).withColumn("l_discount", changed)


@query(f"{_LINES} {_summary_sql('lineitem', 'late_lines', 'lines')}")
def reconcile_lines_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(compare(*_line_sides(spark, sf_dir)), "lines")


@query(f"{_LINES} SELECT * FROM lineitem EXCEPT ALL SELECT * FROM late_lines")
def reconcile_lines_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing(compare(*_line_sides(spark, sf_dir)))


@query(f"{_LINES} SELECT * FROM lineitem EXCEPT ALL SELECT * FROM late_lines")
def reconcile_lines_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, with equal buckets kept out of the row shuffle."""
    return missing(compare(*narrow(*_line_sides(spark, sf_dir))))


@query("SELECT * FROM lineitem WHERE l_orderkey BETWEEN 100 AND 103 AND l_linenumber > 1")
def reconcile_lines_few_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nearly complete sink, which is what narrowing is for: only a few buckets differ."""
    lines = table(spark, sf_dir, "lineitem")
    lost = F.col("l_orderkey").between(100, 103) & (F.col("l_linenumber") > 1)
    return missing(compare(*narrow(lines, lines.filter(~lost))))


# A sink that lost a few lines, holds others twice and has the discount of some changed.
_NEARLY_SQL = """WITH nearly AS (
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           CASE WHEN l_orderkey BETWEEN 300 AND 302 THEN 0.5 ELSE l_discount END AS l_discount,
           l_tax, l_returnflag, l_linestatus, l_shipdate
    FROM lineitem JOIN (SELECT unnest([1, 2, 3]) AS copy) ON copy = 1 OR l_orderkey BETWEEN 200 AND 202
    WHERE NOT (l_orderkey BETWEEN 100 AND 103 AND l_linenumber > 1))"""


def _nearly_complete(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    order = F.col("l_orderkey")
    held = lines.filter(~(order.between(100, 103) & (F.col("l_linenumber") > 1)))
    discount = F.when(order.between(300, 302), F.lit(0.5)).otherwise(F.col("l_discount"))
    copies = F.when(order.between(200, 202), F.sequence(F.lit(1), F.lit(3))).otherwise(F.array(F.lit(1)))
    held = held.withColumn("l_discount", discount).withColumn("copy", F.explode(copies)).drop("copy")
    return lines, held


@query(f"{_NEARLY_SQL} SELECT * FROM lineitem EXCEPT ALL SELECT * FROM nearly")
def reconcile_lines_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing rows of a nearly complete sink: only those that differ reach the comparison."""
    return missing(compare(*narrow_by_sketch(*_nearly_complete(spark, sf_dir))))


@query(f"{_NEARLY_SQL} SELECT * FROM nearly EXCEPT ALL SELECT * FROM lineitem")
def reconcile_lines_sketched_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extra(compare(*narrow_by_sketch(*_nearly_complete(spark, sf_dir))))


@query(f"{_LINES} SELECT * FROM lineitem EXCEPT ALL SELECT * FROM late_lines")
def reconcile_lines_beyond_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More differences than the sketch holds: the whole comparison gives the same rows."""
    return missing(compare(*narrow_by_sketch(*_line_sides(spark, sf_dir), cells=64)))


@query(f"{_BOTH} SELECT * FROM users_sink UNION ALL ({_MISSING})")
def repair_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a damaged sink holds after the missing rows were appended."""
    sink = file_sink("users", new_path(spark, "repair"), USERS)
    sink.write(tag(users_sink(spark, sf_dir), "run 1"))
    verify(tag(users(spark, sf_dir), "run 1"), sink, "run 1")
    return without_column(sink.read_run(spark, "run 1"), "run_id")


@query(
    f"""WITH {USERS_SQL}, {REPOSITORIES_SQL}
    {_summary_sql('users', 'users', 'table')}
    UNION ALL {_summary_sql('users', 'users', 'documents')}
    UNION ALL {_summary_sql('repositories', 'repositories', 'repositories')}"""
)
def fanout_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fan-out to a columnar and a document sink, then the check of both."""
    user_sinks = [
        file_sink("table", new_path(spark, "users-table"), USERS),
        file_sink("documents", new_path(spark, "users-documents"), USERS, "json"),
    ]
    repo_sinks = [file_sink("repositories", new_path(spark, "repositories"), REPOSITORIES)]
    results = load(users(spark, sf_dir), user_sinks, "run 1")
    results += load(repositories(spark, sf_dir), repo_sinks, "run 1")
    return combined(results)


class _Interrupted(Sink):
    """A sink whose first write fails after half of the rows."""

    def write(self, df: DataFrame, mode: str = "append") -> None:
        if not self.read(df.sparkSession).isEmpty():
            return super().write(df, mode)
        super().write(df.filter(F.col("repo_id") % 2 == 0), mode)
        raise ConnectionError("lost during the write")


@query(
    f"""WITH {EVENT_USERS_SQL}, {EVENT_REPOS_SQL}
    SELECT 'Users' AS target, user_id AS id, count(*) AS n FROM event_users GROUP BY 2
    UNION ALL SELECT 'Repositories', repo_id, count(*) FROM event_repos GROUP BY 2"""
)
def load_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that broke off in its second table, called again: every row is there once."""
    path = new_path(spark, "events-json")
    raw_events(spark, sf_dir).write.json(path)
    users_, repos = (file_sink(n, new_path(spark, n), s) for n, s in (("users", USERS), ("repositories", REPOSITORIES)))
    repos = _Interrupted(repos.name, repos.format, repos.options, repos.partition_by, repos.schema)
    spark.createDataFrame([], repos.schema).write.partitionBy(*repos.partition_by).parquet(repos.options["path"])
    try:
        load_events(spark, path, [users_], [repos], "run 1")
    except ConnectionError:
        load_events(spark, path, [users_], [repos], "run 1", again=True)
    found = [sink.read(spark).select(F.lit(t).alias("target"), F.col(k).alias("id")) for sink, t, k in ((users_, "Users", "user_id"), (repos, "Repositories", "repo_id"))]
    return found[0].union(found[1]).groupBy("target", "id").agg(F.count("*").alias("n"))


# Squares of the keys: in ranges of equal width the first would hold a quarter of all rows.
@query("SELECT count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, 16 AS n_ranges, true AS even FROM orders")
def read_even_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows once by their ranges, each within a tenth of an equal share."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") * F.col("o_orderkey")).alias("square"))
    met = F.array_compact(F.array(*(F.when(F.expr(r), i) for i, r in enumerate(even_ranges(orders, "square", 16)))))
    held = orders.select("o_orderkey", F.explode(met).alias("part")).groupBy("part")
    held = held.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
    off = F.greatest(16 * F.max("n") - F.sum("n"), F.sum("n") - 16 * F.min("n"))
    return held.agg(
        F.sum("n").alias("n_rows"),
        F.sum("keys").alias("keys"),
        F.count("part").cast("int").alias("n_ranges"),
        (10 * off <= F.sum("n")).alias("even"),
    )


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_nationkey = 3")
def doc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection written as documents and read through a filter."""
    supplier = table(spark, sf_dir, "supplier")
    path = new_path(spark, "collection")
    Sink("supplier", "json", {"path": path}).write(supplier, "overwrite")
    read = read_collection(spark, "json", {"path": path}, supplier.schema)
    return tagged_with(read, 3, marker="s_nationkey")
