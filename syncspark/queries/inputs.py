"""Inputs of the queries, derived from the given tables.

Each input exists twice, as a frame and as a SQL common table expression.
Losses, edits and repeats of a sink are simulated with conditions on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

AVATARS = "https://avatars.example.org/u/"
USER_URLS = "https://api.example.org/users/"
REPO_URLS = "https://api.example.org/repos/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- Users and Repositories ------------------------------------------------

USERS_SQL = f"""users AS (
    SELECT c_custkey AS user_id, c_name AS login, c_mktsegment AS gravatar_id,
           CASE WHEN c_acctbal >= 0 THEN '{AVATARS}' || c_custkey END AS avatar_url,
           '{USER_URLS}' || c_name AS url
    FROM customer)"""


def users_from(customer: DataFrame, login: Column | None = None) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_name") if login is None else login).alias("login"),
        F.col("c_mktsegment").alias("gravatar_id"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(AVATARS), F.col("c_custkey"))).alias("avatar_url"),
        F.concat(F.lit(USER_URLS), F.col("c_name")).alias("url"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_from(table(spark, sf_dir, "customer"))


# A sink that lost the rows of rich customers, edited those of nation 7 and
# stored those of nation 3 twice.
USERS_SINK_SQL = f"""kept AS (SELECT * FROM customer WHERE c_acctbal <= 9000),
stored AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE c_nationkey = 3),
users_sink AS (
    SELECT c_custkey AS user_id,
           CASE WHEN c_nationkey = 7 THEN c_name || ' (edited)' ELSE c_name END AS login,
           c_mktsegment AS gravatar_id,
           CASE WHEN c_acctbal >= 0 THEN '{AVATARS}' || c_custkey END AS avatar_url,
           '{USER_URLS}' || c_name AS url
    FROM stored)"""


def users_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") <= 9000)
    stored = kept.union(kept.filter(F.col("c_nationkey") == 3))
    edited = F.when(F.col("c_nationkey") == 7, F.concat("c_name", F.lit(" (edited)"))).otherwise(F.col("c_name"))
    return users_from(stored, edited)


REPOSITORIES_SQL = f"""repositories AS (
    SELECT p_partkey AS repo_id, p_name AS name, '{REPO_URLS}' || p_partkey AS url FROM part)"""


def repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("repo_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit(REPO_URLS), F.col("p_partkey")).alias("url"),
    )


# --- Raw events --------------------------------------------------------------


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as nested events, with fields that the declared schema leaves out."""
    key, order = F.col("o_custkey"), F.col("o_orderkey")
    actor = F.struct(
        key.alias("id"),
        F.concat(F.lit("customer "), key).alias("login"),
        F.col("o_orderpriority").alias("gravatar_id"),
        F.concat(F.lit(USER_URLS), key).alias("url"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit(AVATARS), key)).alias("avatar_url"),
        F.lit("ignored").alias("undeclared"),
    )
    repo = F.struct(
        order.alias("id"),
        F.concat(F.lit("order/"), order).alias("name"),
        F.concat(F.lit(REPO_URLS), order).alias("url"),
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("type"), actor.alias("actor"), repo.alias("repo")
    )


EVENT_USERS_SQL = f"""event_users AS (
    SELECT o_custkey AS user_id, 'customer ' || o_custkey AS login, o_orderpriority AS gravatar_id,
           CASE WHEN o_orderstatus <> 'P' THEN '{AVATARS}' || o_custkey END AS avatar_url,
           '{USER_URLS}' || o_custkey AS url
    FROM orders)"""

EVENT_REPOS_SQL = f"""event_repos AS (
    SELECT o_orderkey AS repo_id, 'order/' || o_orderkey AS name, '{REPO_URLS}' || o_orderkey AS url
    FROM orders)"""


# --- Change log ----------------------------------------------------------------

CHANGE_LOG_SQL = """change_log AS (
    SELECT event_id, user_id, event_type AS state, ts AS log_timestamp, props AS payload FROM events)"""


def as_change_log(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "user_id",
        F.col("event_type").alias("state"),
        F.col("ts").alias("log_timestamp"),
        F.col("props").alias("payload"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_change_log(table(spark, sf_dir, "events"))


# --- Messages --------------------------------------------------------------------

# Views are encoded twice; purchases carry escaped quotes; errors are damaged in
# a way that depends on their value.
MESSAGES_SQL = r"""bodies AS (
    SELECT event_id, event_type, value AS v,
           CASE WHEN event_type = 'purchase' THEN 'user \"' || user_id || '\"' ELSE 'user ' || user_id END AS login,
           CASE WHEN event_type = 'error' AND value >= 30 AND value < 60 THEN '"none"'
                ELSE CAST(user_id AS VARCHAR) END AS id_text,
           CASE WHEN event_type = 'error' AND value >= 60 AND value < 100 THEN 'nick' ELSE 'login' END AS login_key,
           ',"gravatar_id":null,"avatar_url":"https:\/\/avatars.example.org\/u\/' || user_id
               || '","url":"","state":"' || event_type || '","log_timestamp":"'
               || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '"' AS rest
    FROM events),
plain AS (
    SELECT event_id, event_type, v,
           '{"user_id":' || id_text || ',"' || login_key || '":"' || login || '"' || rest AS body
    FROM bodies),
messages AS (
    SELECT event_id,
           CASE WHEN event_type = 'view' THEN '"' || replace(replace(body || '}', '\', '\\'), '"', '\"') || '"'
                WHEN event_type = 'error' AND v < 10 THEN body
                WHEN event_type = 'error' AND v < 30 THEN body || '} trailing'
                WHEN event_type = 'error' AND v >= 250 THEN NULL
                WHEN event_type = 'error' AND v >= 200 THEN '   '
                WHEN event_type = 'error' AND v >= 100 THEN '[]'
                ELSE body || '}' END AS value
    FROM plain)"""


def as_messages(events: DataFrame) -> DataFrame:
    error, v = F.col("event_type") == "error", F.col("value")
    user = F.col("user_id").cast("string")
    login = F.when(
        F.col("event_type") == "purchase", F.concat(F.lit('user \\"'), user, F.lit('\\"'))
    ).otherwise(F.concat(F.lit("user "), user))
    id_text = F.when(error & (v >= 30) & (v < 60), F.lit('"none"')).otherwise(user)
    login_key = F.when(error & (v >= 60) & (v < 100), F.lit("nick")).otherwise(F.lit("login"))
    body = F.concat(
        F.lit('{"user_id":'), id_text, F.lit(',"'), login_key, F.lit('":"'), login, F.lit('"'),
        F.lit(',"gravatar_id":null,"avatar_url":"https:\\/\\/avatars.example.org\\/u\\/'), user,
        F.lit('","url":"","state":"'), F.col("event_type"), F.lit('","log_timestamp":"'),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit('"'),
    )
    whole = F.concat(body, F.lit("}"))
    quoted = F.replace(F.replace(whole, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    text = (
        F.when(F.col("event_type") == "view", F.concat(F.lit('"'), quoted, F.lit('"')))
        .when(error & (v < 10), body)
        .when(error & (v < 30), F.concat(body, F.lit("} trailing")))
        .when(error & (v >= 250), F.lit(None))
        .when(error & (v >= 200), F.lit("   "))
        .when(error & (v >= 100), F.lit("[]"))
        .otherwise(whole)
    )
    return events.select("event_id", text.alias("value"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_messages(table(spark, sf_dir, "events"))


# --- Snapshots ---------------------------------------------------------------------

# Orders placed before 2001, and the orders kept after a purge of early 1995 in
# which open orders of that year were closed.
SNAPSHOTS_SQL = """before_orders AS (
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'),
after_orders AS (
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1996-01-01 00:00:00' THEN 'F'
                ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderdate >= TIMESTAMP '1995-07-01 00:00:00')"""


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    priority = F.when(F.col("o_totalprice") >= 50000, F.col("o_orderpriority")).alias("o_orderpriority")
    closed = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < _ntz("1996-01-01 00:00:00"))
    status = F.when(closed, "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus")
    before = orders.filter(F.col("o_orderdate") < _ntz("2001-01-01 00:00:00")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", priority
    )
    after = orders.filter(F.col("o_orderdate") >= _ntz("1995-07-01 00:00:00")).select(
        "o_orderkey", "o_custkey", status, priority
    )
    return before, after
