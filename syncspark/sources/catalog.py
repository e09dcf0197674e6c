"""Fixed-schema catalog tables: create, change columns, check."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from syncspark.operators.project import first_match
from syncspark.workspace import delete, matching, shared_dir


def create_table(spark: SparkSession, name: str, schema: T.StructType, replace: bool = False) -> None:
    """Create an empty table; ``replace`` drops an older one first."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def create_tables(spark: SparkSession, tables: Mapping[str, T.StructType], replace: bool = False) -> None:
    for name, schema in tables.items():
        create_table(spark, name, schema, replace)


def add_column(spark: SparkSession, table: str, name: str, kind: str) -> bool:
    """Add a column unless the table has it; true when added."""
    if name in spark.table(table).columns:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{name}` {kind})")
    return True


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """Details of a catalog table by name."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    names = [r.col_name for r in rows]
    return {r.col_name: r.data_type for r in rows[names.index("# Detailed Table Information") + 1 :]}


def drop_column(spark: SparkSession, table: str, name: str) -> bool:
    """Drop a column if the table has it; true when dropped.

    File tables cannot drop a column in place. What stays is first written to
    the shared folder together with the format, partitions, properties and
    comments of the table; then the table is made anew from it. A call that
    stopped half-way left either the table or those files: the next call for the
    table goes on from them. Partition columns, bucketed tables and tables
    outside the warehouse are refused. A marker kept as a run folder needs none
    of this, see :func:`syncspark.sources.sinks.file_sink`.
    """
    kept = f"{shared_dir(spark)}/syncspark/dropping/{quote(table.lower(), safe='')}/{quote(name, safe='')}"
    ready = matching(spark, f"{kept}/layout/_SUCCESS")
    if not ready:
        current = spark.table(table)
        if name not in current.columns:
            return False
        layout = _layout(spark, table)
        if name in layout["partitions"]:
            raise ValueError(f"{table} is partitioned by {name}")
        delete(spark, kept)
        rest = current.drop(name)
        rest.write.option("compression", "zstd").parquet(f"{kept}/rows")
        layout["schema"] = rest.schema.json()
        spark.createDataFrame([(json.dumps(layout),)], "value string").coalesce(1).write.text(f"{kept}/layout")
    layout = json.loads(spark.read.text(f"{kept}/layout").first()[0])
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows = spark.read.schema(T.StructType.fromJson(json.loads(layout["schema"]))).parquet(f"{kept}/rows")
    writer = rows.write.format(layout["provider"])
    (writer.partitionBy(*layout["partitions"]) if layout["partitions"] else writer).saveAsTable(table)
    if layout["properties"]:
        listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in layout["properties"].items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")
    if layout["comment"]:
        spark.sql(f"COMMENT ON TABLE {table} IS {_text(layout['comment'])}")
    delete(spark, kept)
    return True


def _layout(spark: SparkSession, table: str) -> dict[str, object]:
    details = _described(spark, table)
    if details.get("Type") != "MANAGED" or "Num Buckets" in details:
        raise ValueError(f"{table} is bucketed or lies outside the warehouse")
    return {
        "provider": details["Provider"],
        "partitions": [c.name for c in spark.catalog.listColumns(table) if c.isPartition],
        "properties": {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()},
        "comment": details.get("Comment"),
    }


def _text(value: str) -> str:
    """A string as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def missing_tables(spark: SparkSession, names: Sequence[str]) -> list[str]:
    return [name for name in names if not spark.catalog.tableExists(name)]


def require_tables(spark: SparkSession, names: Sequence[str]) -> None:
    absent = missing_tables(spark, names)
    if absent:
        raise ValueError(f"missing tables: {', '.join(absent)}")


def has_row(df: DataFrame, key: str, value: object) -> bool:
    return not first_match(df, key, value).isEmpty()


def structure(spark: SparkSession, tables: Mapping[str, T.StructType]) -> DataFrame:
    """One row per declared column: does the table have it with its type?"""
    rows = []
    for table, schema in tables.items():
        found = {}
        if spark.catalog.tableExists(table):
            found = {f.name: f.dataType.simpleString() for f in spark.table(table).schema.fields}
        rows += [
            (table, f.name, f.dataType.simpleString(), found.get(f.name), found.get(f.name) == f.dataType.simpleString())
            for f in schema.fields
        ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, expected string, found string, ok boolean"
    )


def filled(df: DataFrame, table_name: str) -> DataFrame:
    """One row per column with its number of values, counted in one scan."""
    counts = df.agg(*(F.count(c).alias(c) for c in df.columns))
    return counts.select(F.lit(table_name).alias("table_name"), F.posexplode(F.array(*counts.columns))).select(
        "table_name",
        F.element_at(F.array(*(F.lit(c) for c in df.columns)), F.col("pos") + 1).alias("column_name"),
        F.col("col").alias("n_values"),
    )


def sentinels(tables: Mapping[str, DataFrame], key: str, value: object) -> DataFrame:
    """One row per table: is there a row with this key?"""
    rows = [
        first_match(df, key, value).agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), (F.col("n") > 0).alias("present")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, rows)
