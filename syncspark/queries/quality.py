"""Row rules, table checks and key-value records."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncspark.operators.keyvalue import (
    KEY,
    check_records,
    key_index,
    lookup,
    members,
    record_fields,
    store_records,
    to_records,
)
from syncspark.operators.rules import (
    USERS_DOCUMENT,
    broken,
    check,
    check_documents,
    max_length,
    merged_types,
    not_null,
    types_seen,
    valid,
)
from syncspark.functions.scalars import entity_key
from syncspark.plans import bootstrap
from syncspark.queries.inputs import (
    MESSAGES_SQL,
    REPOSITORIES_SQL,
    USERS_SQL,
    messages,
    repositories,
    table,
    users,
)
from syncspark.queries.registry import query
from syncspark.schemas import NAME_LIMIT, STATE_LIMIT, USERS_REQUIRED
from syncspark.sources.catalog import add_column, drop_column, filled, sentinels, structure
from syncspark.workspace import new_path, stage

_LIMITED = ("login", "avatar_url")


def _joined(checked: DataFrame) -> DataFrame:
    return checked.withColumn("violations", F.array_join("violations", "; "))


_DOCUMENT_SQL = f"""WITH {MESSAGES_SQL},
kinds AS (
    SELECT event_id, value, coalesce(json_valid(value), false) AS ok,
           CASE WHEN json_valid(value) THEN json_type(value) END AS whole,
           CASE WHEN json_valid(value) THEN json_type(value, '$.user_id') END AS user_id,
           CASE WHEN json_valid(value) THEN json_type(value, '$.login') END AS login
    FROM messages),
named AS (
    SELECT event_id, value,
           concat_ws('; ',
               CASE WHEN login IS NULL THEN 'login is missing' END,
               CASE WHEN NOT ok OR whole <> 'OBJECT' THEN 'not an object' END,
               CASE WHEN user_id NOT IN ('BIGINT', 'UBIGINT') THEN 'user_id has a wrong type' END,
               CASE WHEN user_id IS NULL THEN 'user_id is missing' END) AS violations
    FROM kinds)"""


def _checked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_documents(messages(spark, sf_dir), "value", USERS_DOCUMENT, USERS_REQUIRED)


@query(f"{_DOCUMENT_SQL} SELECT event_id, value, violations FROM named WHERE violations <> ''")
def doc_rules_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(broken(_checked_documents(spark, sf_dir)))


@query(f"{_DOCUMENT_SQL} SELECT event_id, value FROM named WHERE violations = ''")
def doc_rules_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid(_checked_documents(spark, sf_dir))


@query(f"WITH {USERS_SQL} SELECT *, 'avatar_url is null' AS violations FROM users WHERE avatar_url IS NULL")
def not_null_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(broken(check(users(spark, sf_dir), not_null("login", "avatar_url"))))


@query(
    f"""SELECT doc_id, lang, source, n_chars,
           concat_ws('; ', CASE WHEN length(lang) > {STATE_LIMIT} THEN 'lang longer than {STATE_LIMIT}' END,
                     CASE WHEN length(text) > {NAME_LIMIT} THEN 'text longer than {NAME_LIMIT}' END) AS violations
    FROM documents WHERE length(text) > {NAME_LIMIT} OR length(lang) > {STATE_LIMIT}"""
)
def length_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {**max_length(NAME_LIMIT, "text"), **max_length(STATE_LIMIT, "lang")}
    return _joined(broken(check(table(spark, sf_dir, "documents"), rules))).drop("text")


def _new_database(spark: SparkSession, sf_dir: str) -> str:
    database = f"sync_{uuid.uuid4().hex}"
    bootstrap.create(spark, database, new_path(spark, "database"))
    bootstrap.fill(spark, database, users(spark, sf_dir), repositories(spark, sf_dir))
    return database


def _last_use(database: str, result: DataFrame) -> DataFrame:
    """The result as a table of its own; the database goes."""
    kept = stage(result, "checked")
    result.sparkSession.sql(f"DROP DATABASE {database} CASCADE")
    return kept


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, 'o_orderstatus' AS partitions, 'kept' AS note
    FROM orders"""
)
def drop_column_keeps_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table with a property, after a column came and went."""
    database = f"sync_{uuid.uuid4().hex}"
    bootstrap.create(spark, database, new_path(spark, "database"))
    name = f"{database}.orders"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    orders.write.partitionBy("o_orderstatus").saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('note' = 'kept')")
    add_column(spark, name, "run_id", "string")
    drop_column(spark, name, "run_id")
    partitions = ",".join(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    note = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get("note")
    return _last_use(database, spark.table(name).select("*", F.lit(partitions).alias("partitions"), F.lit(note).alias("note")))


def _columns_sql() -> str:
    """Declared columns of every fixed table, and their numbers of values."""
    filled = {"Users": "users", "Repositories": "repositories"}
    rows = []
    for table_name, schema in bootstrap.declared("").items():
        name = table_name.lstrip(".")
        for f in schema.fields:
            n = f"(SELECT count({f.name}) FROM {filled[name]})" if name in filled else "CAST(0 AS BIGINT)"
            kind = f.dataType.simpleString()
            rows.append(
                f"SELECT '{name}' AS table_name, '{f.name}' AS column_name, '{kind}' AS expected, "
                f"'{kind}' AS found, true AS ok, {n} AS n_values"
            )
    return " UNION ALL ".join(rows)


# Every field of every message, the unreadable ones and those of other types included.
_FIELDS_SQL = f"""WITH {MESSAGES_SQL},
docs AS (SELECT CASE WHEN coalesce(json_valid(value), false) THEN value END AS doc FROM messages),
objects AS (SELECT doc FROM docs WHERE json_type(doc) = 'OBJECT'),
found AS (
    SELECT '$' AS field, json_type(doc) AS kind FROM docs
    UNION ALL SELECT field, json_type(doc, '$.' || field) FROM (SELECT doc, unnest(json_keys(doc)) AS field FROM objects)),
typed AS (
    SELECT field, CASE kind WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN 'VOID'
                            ELSE coalesce(kind, 'none') END AS type FROM found)"""


@query(
    f"""{_FIELDS_SQL}
    SELECT field, type, count(*) AS n,
           (field = '$' AND type = 'OBJECT') OR (field = 'user_id' AND type = 'BIGINT') OR (field = 'login' AND type = 'STRING')
           OR (field IN ('gravatar_id', 'avatar_url', 'url') AND type IN ('STRING', 'VOID')) AS as_declared
    FROM typed GROUP BY field, type"""
)
def field_types_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return types_seen(messages(spark, sf_dir), "value", USERS_DOCUMENT)


@query(
    f"""{_FIELDS_SQL}
    SELECT field, CASE count(DISTINCT type) FILTER (type <> 'VOID') WHEN 0 THEN 'VOID' WHEN 1 THEN max(type) FILTER (type <> 'VOID')
                       ELSE 'VARIANT' END AS type, count(*) AS n
    FROM typed WHERE field <> '$' GROUP BY field"""
)
def field_types_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_types(messages(spark, sf_dir), "value")


@query(f"WITH {USERS_SQL}, {REPOSITORIES_SQL} {_columns_sql()}")
def structure_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns and their contents, after a column came and went."""
    database = _new_database(spark, sf_dir)
    bootstrap.validate(spark, database, 1)
    add_column(spark, f"{database}.Users", "run_id", "string")
    drop_column(spark, f"{database}.Users", "run_id")
    tables = bootstrap.declared(database)
    counts = reduce(DataFrame.union, [filled(spark.table(name), name) for name in tables])
    checked = structure(spark, tables).join(counts, ["table_name", "column_name"], "left")
    return _last_use(database, checked.withColumn("table_name", F.substring_index("table_name", ".", -1)))


@query(
    f"""WITH {USERS_SQL}, {REPOSITORIES_SQL}
    SELECT 'Users' AS table_name, count(*) FILTER (user_id = 1) > 0 AS present FROM users
    UNION ALL SELECT 'Before log', false"""
)
def sentinel_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _new_database(spark, sf_dir)
    tables = {"Users": spark.table(f"{database}.Users"), "Before log": spark.table(f"{database}.user_log_before")}
    return _last_use(database, sentinels(tables, "user_id", 1))


_RECORD_FIELDS = ("login", "gravatar_id", "avatar_url", "url")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_records(users(spark, sf_dir), "user_id", _RECORD_FIELDS)


_RECORDS_SQL = f"""WITH {USERS_SQL},
fields AS ({' UNION ALL '.join(
    f"SELECT 'user:' || user_id AS entity_key, '{f}' AS field, {f} AS value FROM users" for f in _RECORD_FIELDS)})"""


@query(f"{_RECORDS_SQL} SELECT * FROM fields")
def kv_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_fields(_records(spark, sf_dir))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders ask for the record of their customer, or of one that has none."""
    orders = table(spark, sf_dir, "orders")
    asked = F.when(F.col("o_orderstatus") == "P", -F.col("o_custkey") - 1).otherwise(F.col("o_custkey"))
    return orders.select("o_orderkey", entity_key(asked).alias(KEY))


_REQUESTS_SQL = """requests AS (
    SELECT o_orderkey, 'user:' || CASE WHEN o_orderstatus = 'P' THEN -o_custkey - 1 ELSE o_custkey END AS entity_key
    FROM orders)"""


@query(
    f"""{_RECORDS_SQL}, {_REQUESTS_SQL}
    SELECT o_orderkey, entity_key, value FROM requests JOIN fields USING (entity_key) WHERE field = 'avatar_url'"""
)
def kv_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup(_requests(spark, sf_dir), _records(spark, sf_dir), "avatar_url")


@query(
    f"""{_RECORDS_SQL}, {_REQUESTS_SQL}
    SELECT o_orderkey, entity_key, value FROM requests JOIN fields USING (entity_key) WHERE field = 'login'"""
)
def kv_lookup_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records stored once by key, which a lookup does not deal out again."""
    database = f"sync_{uuid.uuid4().hex}"
    bootstrap.create(spark, database, new_path(spark, "database"))
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stored = store_records(_records(spark, sf_dir), f"{database}.user_records", buckets)
    return _last_use(database, lookup(_requests(spark, sf_dir), stored, "login"))


@query(f"{_RECORDS_SQL}, {_REQUESTS_SQL} SELECT * FROM requests WHERE entity_key IN (SELECT entity_key FROM fields)")
def kv_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(_requests(spark, sf_dir), key_index(_records(spark, sf_dir)))


@query("SELECT DISTINCT 'user:' || user_id AS entity_key FROM events")
def kv_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_index(to_records(table(spark, sf_dir, "events"), "user_id", ["event_type"]))


# Expected logins against records that lack machinery customers and an index
# that lacks those of nation 3.
@query(
    """SELECT 'user:' || c_custkey AS entity_key,
           c_mktsegment <> 'MACHINERY' AND c_acctbal >= 0 AS value_ok, c_nationkey <> 3 AS indexed
    FROM customer"""
)
def kv_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    login = F.when(F.col("c_acctbal") >= 0, F.col("c_name")).otherwise(F.lit("another name"))
    stored = customer.filter(F.col("c_mktsegment") != "MACHINERY").withColumn("login", login)
    index = key_index(to_records(customer.filter(F.col("c_nationkey") != 3), "c_custkey", ["c_name"]))
    expected = customer.select(entity_key(F.col("c_custkey")).alias(KEY), F.col("c_name").alias("value"))
    return check_records(expected, to_records(stored, "c_custkey", ["login"]), index, "login")
