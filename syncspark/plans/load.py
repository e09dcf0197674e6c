"""Batch load: write to every sink, read back, compare, repair."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncspark.operators.project import repositories_of, tag, users_of
from syncspark.operators.reconcile import (
    compare,
    differences,
    missing,
    narrow,
    summary_of_differences,
)
from syncspark.operators.rules import VIOLATIONS, broken, check, repositories_rules, users_rules, valid
from syncspark.sources.readers import CORRUPT, read_events
from syncspark.sources.sinks import Sink, write_all
from syncspark.workspace import scratch, stage, stage_counted


@dataclass(frozen=True)
class Verified:
    """Outcome for one sink: the summary before repair and what differed."""

    sink: str
    summary: DataFrame
    differences: DataFrame
    repaired: bool


def find_differences(written: DataFrame, held: DataFrame, buckets: int | None = None) -> DataFrame:
    """Contents whose copies differ, staged: the comparison runs once.

    With ``buckets`` rows of equal buckets are left out of the row shuffle.
    """
    sides = (written, held) if buckets is None else narrow(written, held, buckets)
    return stage(differences(compare(*sides)), "differences")


def _verified(written: DataFrame, n_written: int, sink: Sink, run_id: str, repair: bool, buckets: int | None) -> Verified:
    held = sink.read_run(written.sparkSession, run_id)
    found = find_differences(written, held, buckets)
    absent = missing(found).select(*written.columns)
    act = repair and not absent.isEmpty()
    if act:
        sink.write(absent, "append")
    return _settled(Verified(sink.name, summary_of_differences(found, n_written, sink.name), found, act))


def _settled(outcome: Verified) -> Verified:
    """The outcome without any table of the block it was made in.

    The summary is one row; what differed is kept as a table only if there is any.
    """
    spark, found = outcome.differences.sparkSession, outcome.differences
    kept = spark.createDataFrame([], found.schema) if found.isEmpty() else stage(found, "differences", keep=True)
    summary = spark.createDataFrame(outcome.summary.collect(), outcome.summary.schema)
    return Verified(outcome.sink, summary, kept, outcome.repaired)


def verify(
    written: DataFrame, sink: Sink, run_id: str, repair: bool = True, buckets: int | None = None
) -> Verified:
    """Compare the rows of one run with a sink and append what is missing.

    Rows the sink holds beyond those are reported, not removed.
    """
    with scratch(written.sparkSession):
        return _verified(written, written.count(), sink, run_id, repair, buckets)


def verify_all(
    written: DataFrame | None,
    sinks: Sequence[Sink],
    run_id: str,
    repair: bool = True,
    buckets: int | None = None,
) -> list[Verified]:
    """Verify sink after sink; nothing to do for a null or empty frame."""
    if written is None or written.isEmpty():
        return []
    return [verify(written, sink, run_id, repair, buckets) for sink in sinks]


def combined(results: Sequence[Verified]) -> DataFrame:
    return reduce(DataFrame.union, [r.summary for r in results])


def load(
    frame: DataFrame, sinks: Sequence[Sink], run_id: str, mode: str = "append", buckets: int | None = None
) -> list[Verified]:
    """Tag, write everywhere, verify and repair.

    A second call with the same ``run_id`` after a failure should be
    :func:`resume`, which appends only what the first one did not manage. The
    staged copy of the rows is deleted at the end; only differences remain.
    """
    with scratch(frame.sparkSession):
        written = write_all(tag(frame, run_id), sinks, mode)
        return [] if written is None else [_verified(*written, sink, run_id, True, buckets) for sink in sinks]


def resume(frame: DataFrame, sinks: Sequence[Sink], run_id: str) -> list[Verified]:
    """Bring every sink to the full rows of a run, whatever it already holds."""
    with scratch(frame.sparkSession):
        staged, n = stage_counted(tag(frame, run_id), "resume")
        return [_verified(staged, n, sink, run_id, True, None) for sink in sinks] if n else []


def _refused(target: str, checked: DataFrame) -> DataFrame:
    rows = broken(checked)
    value = F.to_json(F.struct(*(c for c in checked.columns if c != VIOLATIONS)), {"ignoreNullFields": "false"})
    return rows.select(F.lit(target).alias("target"), value.alias("value"), F.array_join(VIOLATIONS, "; ").alias("violations"))


def load_events(
    spark: SparkSession,
    path: str,
    user_sinks: Sequence[Sink],
    repository_sinks: Sequence[Sink],
    run_id: str,
    refused: Sink | None = None,
    again: bool = False,
) -> dict[str, list[Verified]]:
    """JSON events to the Users and the Repositories sinks, each line parsed and checked once.

    Malformed lines and rows that break the rules of their table go to the sink
    ``refused`` (``target, value, violations``); without one they stop the load
    before anything is written. A load that failed is called ``again`` under its
    ``run_id``: every sink then gets only what it does not hold of the run.
    """
    write = resume if again else load
    with scratch(spark):
        events = stage(read_events(spark, path, keep_malformed=True), "events")
        good = events.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
        users = stage(check(users_of(good), users_rules()), "checked-users")
        repositories = stage(check(repositories_of(good), repositories_rules()), "checked-repositories")
        malformed = events.filter(F.col(CORRUPT).isNotNull()).select(
            F.lit("event").alias("target"), F.col(CORRUPT).alias("value"), F.lit("malformed line").alias("violations")
        )
        turned_down = malformed.union(_refused("Users", users)).union(_refused("Repositories", repositories))
        results = {}
        if refused is not None:
            results["Refused"] = write(turned_down, [refused], run_id)
        elif not turned_down.isEmpty():
            raise ValueError("events were refused: name a sink for them")
        results["Users"] = write(valid(users), user_sinks, run_id)
        results["Repositories"] = write(valid(repositories), repository_sinks, run_id)
        return {name: [_settled(r) for r in found] for name, found in results.items()}
