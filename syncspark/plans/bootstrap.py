"""Create the fixed tables and check structure and content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from syncspark.operators.rules import require_columns
from syncspark.schemas import CHANGE_LOG, LOG_TABLE_NAMES, REPOSITORIES, TABLE_NAMES, USERS
from syncspark.sources.catalog import create_tables, has_row, require_tables


def declared(database: str) -> dict[str, object]:
    tables = {f"{database}.{name}": schema for name, schema in zip(TABLE_NAMES, (USERS, REPOSITORIES))}
    logs = {f"{database}.{name}": CHANGE_LOG for name in LOG_TABLE_NAMES}
    return tables | logs


def create(spark: SparkSession, database: str, location: str | None = None) -> None:
    """New data tables; change-log tables are kept when they exist."""
    name = database.replace("`", "``")
    where = " LOCATION :location" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}", {"location": location} if location else None)
    schemas = declared(database)
    logs = {f"{database}.{name}" for name in LOG_TABLE_NAMES}
    create_tables(spark, {n: s for n, s in schemas.items() if n not in logs}, replace=True)
    create_tables(spark, {n: s for n, s in schemas.items() if n in logs})


def fill(spark: SparkSession, database: str, users: DataFrame, repositories: DataFrame) -> None:
    for name, frame in zip(TABLE_NAMES, (users, repositories)):
        target = f"{database}.{name}"
        frame.select(*spark.table(target).columns).write.insertInto(target)


def validate(spark: SparkSession, database: str, sentinel: object) -> None:
    """Raise when a table, a column or the sentinel user is missing."""
    schemas = declared(database)
    require_tables(spark, list(schemas))
    for name, schema in schemas.items():
        require_columns(spark.table(name), schema)
    if not has_row(spark.table(f"{database}.{TABLE_NAMES[0]}"), "user_id", sentinel):
        raise ValueError(f"user_id {sentinel} not found")
