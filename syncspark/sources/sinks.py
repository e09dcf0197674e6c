"""Named sinks that can be written and read back."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from syncspark.functions.messages import encode
from syncspark.operators.project import MARKER, tagged_with
from syncspark.schemas import JDBC_BATCH_ROWS, NAME_LIMIT, SAVE_MODES
from syncspark.sources.readers import Split, split_options
from syncspark.workspace import stage_counted

# Run names that are written as folder names without escaping.
_PLAIN_FOLDER = re.compile(r"[A-Za-z0-9_.-]+( [A-Za-z0-9_.-]+)*")


def checked_mode(mode: str) -> str:
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}, expected one of {', '.join(SAVE_MODES)}")
    return mode


@dataclass(frozen=True)
class Sink:
    """A place that keeps rows: format, options and, for files, the layout.

    ``partition_by`` is a good place for the run marker of a file sink: the
    rows of a run are then found by listing folders, and forgetting the marker
    needs no rewrite.
    """

    name: str
    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    partition_by: Sequence[str] = ()
    schema: T.StructType | None = None

    def write(self, df: DataFrame, mode: str = "append") -> None:
        writer = df.write.format(self.format).options(**self.options).mode(checked_mode(mode))
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.save()

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        return (reader if self.schema is None else reader.schema(self.schema)).load()

    def prepare(self, spark: SparkSession) -> None:
        """Create the folder of a file sink, so that it can be read while empty."""
        if self.schema is not None:
            self.write(spark.createDataFrame([], self.schema))

    def read_run(self, spark: SparkSession, run_id: str) -> DataFrame:
        """Rows written by one run.

        A sink with run folders is read from the one folder, so the work does
        not grow with the number of other runs.
        """
        if self.schema is None or tuple(self.partition_by) != (MARKER,) or not _PLAIN_FOLDER.fullmatch(run_id):
            return tagged_with(self.read(spark), run_id)
        base = self.options["path"]
        options = {**self.options, "basePath": base, "path": f"{base}/{MARKER}={run_id}"}
        try:
            return spark.read.format(self.format).options(**options).schema(self.schema).load()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.schema)


def table_sink(
    name: str, options: Mapping[str, str], split: Split | None = None, batch_rows: int = JDBC_BATCH_ROWS
) -> Sink:
    """Database table.

    ``split`` lets many tasks read the table back; without it one task reads
    everything. Its number of parts also caps the connections of a write.
    """
    batching = {"batchsize": str(batch_rows), "rewriteBatchedStatements": "true"}
    return Sink(name, "jdbc", {**batching, **options, **split_options(split)})


def marker_statement(sink: Sink, columns: Sequence[str], add: bool) -> str | None:
    """Statement that adds the run marker to a database table, or drops it; none where nothing is to do.

    ``columns`` are those the table has now: the marker is added only if it is
    missing and dropped only if it is there, whatever its case.
    """
    held = [c for c in columns if c.lower() == MARKER.lower()]
    if add == bool(held):
        return None
    change = f"ADD COLUMN {MARKER} VARCHAR({NAME_LIMIT})" if add else f"DROP COLUMN {held[0]}"
    return f"ALTER TABLE {sink.options['dbtable']} {change}"


def change_marker(spark: SparkSession, sink: Sink, add: bool) -> bool:
    """Add or drop the run marker of a database table; whether that was needed.

    The statement runs once, on the driver: one that tasks ran would run again
    with every retried task. A table sink is marked before a load and unmarked
    when its runs no longer matter; a file sink keeps the marker as a folder and
    needs neither.
    """
    reading = {k: v for k, v in sink.options.items() if k in ("url", "dbtable", "user", "password", "driver")}
    statement = marker_statement(sink, spark.read.format(sink.format).options(**reading).load().columns, add)
    if statement is None:
        return False
    jvm, properties = spark._jvm, spark._jvm.java.util.Properties()
    for name in ("user", "password"):
        if name in sink.options:
            properties.setProperty(name, sink.options[name])
    if "driver" in sink.options:
        jvm.java.lang.Class.forName(sink.options["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(sink.options["url"], properties)
    try:
        connection.createStatement().execute(statement)
    finally:
        connection.close()
    return True


# Text formats that keep every digit of a timestamp.
_JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def file_sink(name: str, path: str, schema: T.StructType, file_format: str = "parquet") -> Sink:
    """Folder of files whose rows are marked by run folder."""
    marked = T.StructType([*schema.fields, T.StructField(MARKER, T.StringType(), True)])
    options = {"path": path, **(_JSON_TIMES if file_format == "json" else {})}
    return Sink(name, file_format, options, (MARKER,), marked)


def write_all(df: DataFrame | None, sinks: Sequence[Sink], mode: str = "append") -> tuple[DataFrame, int] | None:
    """Write one frame to every sink; nothing is written for a null or empty one.

    The frame is staged first, so all sinks get the same rows from one
    evaluation. The staged table is returned for the later comparison, with the
    number of its rows, which were counted while it was written.
    """
    checked_mode(mode)
    if df is None:
        return None
    staged, n = stage_counted(df, "fanout")
    if n == 0:
        return None
    for sink in sinks:
        sink.write(staged, mode)
    return staged, n


def publish(df: DataFrame, options: Mapping[str, str], sink_format: str = "kafka",
            columns: Sequence[str] | None = None, keep: Sequence[str] = (), mode: str = "append") -> None:
    """Append each row as one JSON message value."""
    encode(df, columns, keep).write.format(sink_format).options(**options).mode(mode).save()


def topic_write_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.enable.idempotence": "true",
    }
