import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from syncspark.operators import keyvalue, rules as Q
from syncspark.operators.keyvalue import (
    check_records,
    key_index,
    lookup,
    members,
    record_fields,
    store_records,
    to_records,
)
from syncspark.operators.project import (
    align,
    first_match,
    preview,
    tag,
    tagged_with,
    with_column_if_missing,
    without_column,
)
from syncspark.plans import bootstrap
from syncspark.schemas import (
    CHANGE_LOG,
    REPOSITORIES_REQUIRED,
    USERS,
    USERS_REQUIRED,
)
from syncspark.sources import catalog
from syncspark.sources.readers import (
    Split,
    even_ranges,
    read_collection,
    read_events,
    read_table_ranges,
    stream_events,
    table_options,
    topic_options,
)
from syncspark.sources.sinks import marker_statement, table_sink, topic_write_options

DOCUMENTS = [
    ('{"user_id":1,"login":"a","gravatar_id":null,"url":"u"}', []),
    ('{"user_id":1,"login":"a","other":[1]}', []),
    ('{"user_id":"1","login":"a"}', ["user_id has a wrong type"]),
    ('{"user_id":1.5,"login":12}', ["login has a wrong type", "user_id has a wrong type"]),
    ('{"user_id":null,"login":"a"}', ["user_id has a wrong type"]),
    ('{"login":"a","url":3}', ["url has a wrong type", "user_id is missing"]),
    ("{}", ["login is missing", "user_id is missing"]),
    ('{"user_id":1,"login":"a"} trailing', ["login is missing", "not an object", "user_id is missing"]),
    ('{"user_id":1,"login":"a"} {"x":1}', ["login is missing", "not an object", "user_id is missing"]),
    ('{"user_id":1,"login":"a","other":{"x":"}"}}', []),
    ("[]", ["login is missing", "not an object", "user_id is missing"]),
    ("{bad", ["login is missing", "not an object", "user_id is missing"]),
    (None, ["login is missing", "not an object", "user_id is missing"]),
]


def test_document_rules_look_at_json_types(spark):
    df = spark.createDataFrame([(i, d[0]) for i, d in enumerate(DOCUMENTS)], "n int, doc string")
    checked = Q.check_documents(df, "doc", Q.USERS_DOCUMENT, USERS_REQUIRED)
    assert checked.columns == ["n", "doc", "violations"]
    assert [r.violations for r in checked.orderBy("n").collect()] == [d[1] for d in DOCUMENTS]
    assert Q.valid(checked).count() == 3 and Q.broken(checked).count() == 10


def test_repository_documents(spark):
    df = spark.createDataFrame([('{"repo_id":1,"name":"r"}',), ('{"repo_id":1}',)], "doc string")
    checked = Q.check_documents(df, "doc", Q.REPOSITORIES_DOCUMENT, REPOSITORIES_REQUIRED)
    assert sorted(r.violations for r in checked.collect()) == [[], ["name is missing"]]


def test_column_rules(spark):
    data = [(1, "a", "x" * 255, None, None, "s" * 50, None), (2, None, "é" * 256, "", "", "s" * 51, None)]
    checked = Q.check(spark.createDataFrame(data, CHANGE_LOG), Q.change_log_rules())
    found = {r.user_id: r.violations for r in checked.collect()}
    assert found == {1: [], 2: ["gravatar_id longer than 255", "login is null", "state longer than 50"]}
    repos = spark.createDataFrame([(1, None, "u")], "repo_id long, name string, url string")
    assert Q.check(repos, Q.repositories_rules()).first().violations == ["name is null"]


def test_require_columns(spark):
    df = spark.createDataFrame([], USERS)
    assert Q.require_columns(df, USERS) is df
    with pytest.raises(ValueError, match="login"):
        Q.require_columns(df.drop("login"), USERS)
    with pytest.raises(ValueError, match="expected bigint, found string"):
        Q.require_columns(df.withColumn("user_id", df.login), USERS)
    with pytest.raises(ValueError, match="no columns"):
        Q.require_columns(df.select(), USERS)


def test_records(spark, rows):
    users = spark.createDataFrame([(1, "a", ""), (2, None, "u")], "user_id long, login string, url string")
    records = to_records(users, "user_id", ["login", "url"])
    assert rows(record_fields(records)) == [
        ("user:1", "login", "a"), ("user:1", "url", ""), ("user:2", "login", None), ("user:2", "url", "u"),
    ]
    asked = spark.createDataFrame([("user:1",), ("user:9",), ("user:1",)], "entity_key string")
    assert rows(lookup(asked, records, "login")) == [("user:1", "a")] * 2
    assert lookup(asked, records).first().fields == {"login": "a", "url": ""}
    assert lookup(asked, records, "absent").first().value is None
    index = key_index(records.union(records))
    assert index.count() == 2 and members(asked, index).count() == 2
    expected = spark.createDataFrame(
        [("user:1", "a"), ("user:2", "b"), ("user:3", None)], "entity_key string, value string"
    )
    assert rows(check_records(expected, records, index.filter("entity_key = 'user:2'"), "login")) == [
        ("user:1", True, False), ("user:2", False, True), ("user:3", False, False),
    ]


def test_projections(spark, rows):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "user_id long, login string")
    tagged = tag(df, "r1").union(tag(df, "r2"))
    assert tagged_with(tagged, "r1").count() == 2
    assert align(tagged, ["login", "user_id"]).columns == ["login", "user_id"]
    assert align(tagged, df).columns == df.columns
    assert with_column_if_missing(df, "login", "int") is df
    assert with_column_if_missing(df, "run_id", "string").first().run_id is None
    assert without_column(df, "absent") is df and without_column(df, "login").columns == ["user_id"]
    nested = df.selectExpr("struct(user_id, login) AS actor")
    assert without_column(nested, "actor.login").schema["actor"].dataType.names == ["user_id"]
    assert rows(first_match(tagged, "user_id", 1)) == [(1, "a", "r1")]
    assert rows(preview(df, 1, ["user_id"])) == [(1, "a")]


@pytest.fixture
def database(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    bootstrap.create(spark, name, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_bootstrap(spark, database):
    users = spark.createDataFrame([(1, "a", "", None, None)], USERS)
    repos = spark.createDataFrame([("u", 1, "r")], "url string, repo_id long, name string")
    with pytest.raises(ValueError, match="user_id 1 not found"):
        bootstrap.validate(spark, database, 1)
    bootstrap.fill(spark, database, users, repos)
    bootstrap.validate(spark, database, 1)
    assert spark.table(f"{database}.Repositories").first().name == "r"
    # Data tables are made anew, logs are kept.
    spark.sql(f"INSERT INTO {database}.user_log_after VALUES (1, 'a', '', '', '', 'INSERT', now())")
    bootstrap.create(spark, database)
    assert spark.table(f"{database}.Users").isEmpty()
    assert spark.table(f"{database}.user_log_after").count() == 1
    spark.sql(f"DROP TABLE {database}.Users")
    with pytest.raises(ValueError, match="missing tables"):
        bootstrap.validate(spark, database, 1)


def test_columns_of_tables_come_and_go(spark, database):
    table = f"{database}.Users"
    spark.createDataFrame([(1, "a", "", None, None)], USERS).write.insertInto(table)
    assert catalog.add_column(spark, table, "run_id", "string")
    assert not catalog.add_column(spark, table, "run_id", "string")
    assert spark.table(table).first().run_id is None
    assert catalog.drop_column(spark, table, "run_id")
    assert not catalog.drop_column(spark, table, "run_id")
    assert spark.table(table).columns == USERS.names and spark.table(table).count() == 1
    assert all(r.ok for r in catalog.structure(spark, bootstrap.declared(database)).collect())
    wrong = {table: CHANGE_LOG, f"{database}.absent": USERS}
    assert [r.ok for r in catalog.structure(spark, wrong).collect()].count(False) == 7
    filled = {r.column_name: r.n_values for r in catalog.filled(spark.table(table), table).collect()}
    assert filled == {"user_id": 1, "login": 1, "gravatar_id": 1, "avatar_url": 0, "url": 0}
    found = catalog.sentinels({"Users": spark.table(table)}, "user_id", 2).first()
    assert tuple(found) == ("Users", False)


def test_events_keep_large_ids_and_drop_undeclared_fields(spark, tmp_path):
    path = tmp_path / "events"
    path.mkdir()
    (path / "a.json").write_text('{"type":"x","actor":{"id":3000000000,"login":"a","z":1},"repo":null}\n')
    events = read_events(spark, str(path))
    row = events.first()
    assert events.columns == ["actor", "repo"] and row.actor.id == 3000000000 and row.repo is None
    assert stream_events(spark, str(path), max_files=1).schema == events.schema


def test_collection_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.range(5).selectExpr("id", "IF(id < 2, 'r1', 'r2') AS run_id").write.parquet(path)
    read = tagged_with(read_collection(spark, "parquet", {"path": path}, match="[]"), "r1")
    assert read.count() == 2
    assert "EqualTo(run_id,r1)" in read._jdf.queryExecution().executedPlan().toString()


def test_connector_options():
    options = table_options("jdbc:x", "Users", "u", "p", split=Split("user_id", 1, 100, 8), extra={"fetchsize": 10})
    assert options == {
        "url": "jdbc:x", "dbtable": "Users", "pushDownPredicate": "true", "user": "u", "password": "p",
        "partitionColumn": "user_id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8",
        "fetchsize": "10",
    }
    assert topic_options("h:1", "t", {"kafka.group.id": "g"}) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "kafka.group.id": "g",
    }
    assert topic_options("h:1", "t", go_on_after_loss=True)["failOnDataLoss"] == "false"
    assert topic_write_options("h:1", "t")["topic"] == "t"


def test_marker_of_a_database_table():
    """Added only where it is missing, dropped only where it is there."""
    sink = table_sink("users", {"url": "jdbc:x", "dbtable": "Users", "user": "u"})
    plain, marked = ["user_id", "login"], ["user_id", "RUN_ID"]
    assert marker_statement(sink, plain, True) == "ALTER TABLE Users ADD COLUMN run_id VARCHAR(255)"
    assert marker_statement(sink, marked, True) is None
    assert marker_statement(sink, marked, False) == "ALTER TABLE Users DROP COLUMN RUN_ID"
    assert marker_statement(sink, plain, False) is None


def _partitioned(spark, name):
    df = spark.range(40).selectExpr("id", "id % 3 AS b", "'x' AS run_id")
    df.write.partitionBy("b").saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner''s note' = 'it\\'s kept')")
    spark.sql(f"COMMENT ON TABLE {name} IS 'a comment'")
    spark.sql(f"ALTER TABLE {name} ALTER COLUMN id COMMENT 'the key'")


def test_dropped_column_leaves_the_layout(spark, database):
    name = f"{database}.parted"
    _partitioned(spark, name)
    assert catalog.drop_column(spark, name, "run_id") and not catalog.drop_column(spark, name, "run_id")
    table = spark.table(name)
    assert sorted(map(tuple, table.select("id", "b").collect())) == [(i, i % 3) for i in range(40)] and table.columns == ["id", "b"]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["b"]
    assert {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}["owner's note"] == "it's kept"
    assert catalog._described(spark, name)["Comment"] == "a comment"
    assert {c.name: c.description for c in spark.catalog.listColumns(name)}["id"] == "the key"
    with pytest.raises(ValueError, match="partitioned"):
        catalog.drop_column(spark, name, "b")


@pytest.mark.parametrize("stop_at", ["DROP TABLE IF", "COMMENT ON"])
def test_a_drop_that_stops_goes_on(spark, database, monkeypatch, stop_at):
    name = f"{database}.stopped"
    _partitioned(spark, name)
    real = type(spark).sql

    def stopping(self, text, *args, **named):
        if text.startswith(stop_at):
            raise RuntimeError("stopped")
        return real(self, text, *args, **named)

    monkeypatch.setattr(type(spark), "sql", stopping)
    with pytest.raises(RuntimeError, match="stopped"):
        catalog.drop_column(spark, name, "run_id")
    monkeypatch.undo()
    assert spark.table(name).count() == 40
    assert catalog.drop_column(spark, name, "run_id")
    assert spark.table(name).columns == ["id", "b"] and spark.table(name).count() == 40
    assert catalog._described(spark, name)["Comment"] == "a comment"


def _hot(spark, name, plan):
    for key, value in {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }.items():
        spark.conf.set(key, value)
    try:
        requests = spark.range(60_000).selectExpr("IF(id % 3 = 0, 'user:7', concat('user:', id)) AS entity_key", "CAST(id AS STRING) AS value").repartition(8)
        records = keyvalue.to_records(spark.range(3000).selectExpr("id", "concat('n', id) AS login"), "id", ["login"])
        found = plan(requests, records)
        found.collect()
        return found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in ("skewJoin.skewedPartitionThresholdInBytes", "skewJoin.skewedPartitionFactor", "advisoryPartitionSizeInBytes", "coalescePartitions.enabled"):
            spark.conf.unset(f"spark.sql.adaptive.{key}")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name,plan", [
    ("members", lambda q, r: keyvalue.members(q, keyvalue.key_index(r))),
    ("lookup", lambda q, r: keyvalue.lookup(q, r, "login")),
    ("check", lambda q, r: keyvalue.check_records(q, r, keyvalue.key_index(r), "login")),
])
def test_hot_keys_are_split(spark, name, plan):
    assert "skew=true" in _hot(spark, name, plan)


def _held(df, ranges):
    """Rows that each condition finds."""
    return [df.filter(r).count() for r in ranges]


def test_even_ranges_of_a_skewed_key(spark):
    df = spark.range(20000).select((F.col("id") * F.col("id") * F.col("id")).alias("k"))
    held = _held(df, even_ranges(df, "k", 16))
    assert len(held) == 16 and sum(held) == 20000
    assert max(held) <= 1.1 * 1250 and min(held) >= 0.9 * 1250


def test_even_ranges_keep_rows_without_a_key_and_hot_values(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN -5 ELSE id END AS k")
    ranges = even_ranges(df, "k", 8)
    assert 1 < len(ranges) < 8 and sum(_held(df, ranges)) == 3000
    assert even_ranges(df.filter("k IS NULL"), "k", 8) == even_ranges(df, "k", 1) == ["1 = 1"]


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "double", "decimal(12,2)"])
def test_even_ranges_of_other_types(spark, kind):
    value = f"CAST(id * 1.5 AS {kind})" if kind[:2] in ("do", "de") else f"CAST(DATE '2020-01-01' + CAST(id AS INT) AS {kind})"
    df = spark.range(1000).selectExpr(f"{value} AS k")
    held = _held(df, even_ranges(df, "k", 4))
    assert sum(held) == 1000 and max(held) <= 275


def test_ranges_are_the_predicates_of_a_database_read(spark, monkeypatch):
    asked = {}
    reader = type(spark.read)
    monkeypatch.setattr(reader, "jdbc", lambda self, url, table, **named: asked.update(named, url=url, table=table))
    ranges = even_ranges(spark.createDataFrame([(datetime.date(2020, 1, d),) for d in (1, 2, 3)], "day date"), "day", 2)
    read_table_ranges(spark, table_options("jdbc:x", "t", user="u"), ranges)
    assert asked["url"] == "jdbc:x" and asked["table"] == "t" and asked["properties"]["user"] == "u"
    assert asked["predicates"] == ["day <= DATE '2020-01-02' OR day IS NULL", "day > DATE '2020-01-02'"]


def test_types_seen_in_bad_inputs(spark, rows):
    texts = [
        '{"user_id":1,"login":"a"}', '{"user_id":"1","login":null}', '{"user_id":2.5,"x":{"y":[1]}}', '{"user_id":3} {"z":1}',
        "{}", "[1]", '"text"', "null", "", "no json", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert rows(Q.types_seen(df, "value", Q.USERS_DOCUMENT)) == sorted(
        [
            ("$", "ARRAY", 1, False), ("$", "OBJECT", 4, True), ("$", "STRING", 1, False), ("$", "VOID", 1, False), ("$", "none", 4, False),
            ("login", "STRING", 1, True), ("login", "VOID", 1, False), ("x", "OBJECT", 1, False),
            ("user_id", "BIGINT", 1, True), ("user_id", "DECIMAL", 1, False), ("user_id", "STRING", 1, False),
        ],
        key=repr,
    )
    assert rows(Q.merged_types(df, "value")) == sorted(
        [("login", "STRING", 2), ("user_id", "VARIANT", 3), ("x", "OBJECT<y: ARRAY<BIGINT>>", 1)], key=repr
    )
    assert Q.types_seen(df.limit(0), "value", {}).count() == Q.merged_types(df.limit(0), "value").count() == 0


def test_stored_records_are_not_dealt_out_again(spark, rows):
    database = f"stored_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    plain = to_records(spark.range(500).selectExpr("id", "id * 2 AS twice"), "id", ["twice"])
    stored = store_records(plain, f"{database}.records", 16)
    requests = spark.range(2000).selectExpr("id AS asked", "concat('user:', CASE WHEN id % 3 = 0 THEN 7 ELSE id END) AS entity_key")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for found, expected in (
            (lookup(requests, stored, "twice"), lookup(requests, plain, "twice")),
            (members(requests, stored.select("entity_key")), members(requests, plain.select("entity_key"))),
        ):
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1
            assert rows(found) == rows(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql(f"DROP DATABASE {database} CASCADE")
