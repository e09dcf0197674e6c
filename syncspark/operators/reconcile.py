"""Compare a written frame with what a sink holds, as multisets of rows.

Both sides are tagged, unioned and grouped by all columns once. Copies of a row
are summed before the shuffle, so a row that fills a third of the table sends
one record per map task, and missing, extra and totals come from one exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from syncspark.workspace import stage

IN_SOURCE = "n_source"
IN_SINK = "n_sink"

MATCH = "match"
DIFFERS = "differs"

# Rows with more copies than this leave the task that holds them.
_COPIES_IN_PLACE = 100
# Copies of one row that a single generated array may hold.
_COPIES_PER_CHUNK = 10_000


def compare(source: DataFrame, sink: DataFrame) -> DataFrame:
    """One row per distinct content with its number of copies on both sides.

    Columns are matched by name; nulls equal nulls.
    """
    names = source.columns
    left = source.select(*names, F.lit(1).cast("long").alias(IN_SOURCE), F.lit(0).cast("long").alias(IN_SINK))
    right = sink.select(*names, F.lit(0).cast("long").alias(IN_SOURCE), F.lit(1).cast("long").alias(IN_SINK))
    return left.union(right).groupBy(*names).agg(
        F.sum(IN_SOURCE).alias(IN_SOURCE), F.sum(IN_SINK).alias(IN_SINK)
    )


def differences(compared: DataFrame) -> DataFrame:
    """Only the contents whose numbers of copies differ."""
    return compared.filter(F.col(IN_SOURCE) != F.col(IN_SINK))


def missing(compared: DataFrame) -> DataFrame:
    """Rows written but not read back, once per absent copy."""
    short = F.col(IN_SOURCE) - F.col(IN_SINK)
    return repeat_rows(compared.filter(short > 0).withColumn("_copies", short), "_copies").drop(
        IN_SOURCE, IN_SINK
    )


def extra(compared: DataFrame) -> DataFrame:
    """Rows the sink holds beyond what was written, once per surplus copy."""
    surplus = F.col(IN_SINK) - F.col(IN_SOURCE)
    return repeat_rows(compared.filter(surplus > 0).withColumn("_copies", surplus), "_copies").drop(
        IN_SOURCE, IN_SINK
    )


def repeat_rows(df: DataFrame, copies: str, index: str | None = None) -> DataFrame:
    """Each row ``copies`` times, without the count column.

    ``index`` names a column for the number of the copy, from 1. Rows with many
    copies are first cut into chunks that are spread over the cluster, so no
    task has to emit one hot row, or the copies of all rows of a small table,
    alone. The number of partitions is named: a shuffle of few rows would be
    joined to one task again, however many copies they stand for.
    """
    names = [c for c in df.columns if c != copies]
    count = F.col(copies)
    chunk_rows = F.lit(_COPIES_PER_CHUNK).cast("long")
    few = df.filter(count <= _COPIES_IN_PLACE).select(
        *names, F.explode(F.sequence(F.lit(1).cast("long"), count)).alias("_copy")
    )
    # Chunks start after 0, 1, 2, ... times the chunk size.
    starts = F.sequence(F.lit(0).cast("long"), count - 1, chunk_rows)
    chunks = df.filter(count > _COPIES_IN_PLACE).select("*", F.explode(starts).alias("_start"))
    last = F.least(F.col("_start") + chunk_rows, count)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = chunks.repartition(tasks, "_start", *names).select(
        *names, F.explode(F.sequence(F.col("_start") + 1, last)).alias("_copy")
    )
    repeated = few.union(many)
    return repeated.drop("_copy") if index is None else repeated.withColumnRenamed("_copy", index)


def _shortfall() -> list[Column]:
    short = F.greatest(F.col(IN_SOURCE) - F.col(IN_SINK), F.lit(0))
    surplus = F.greatest(F.col(IN_SINK) - F.col(IN_SOURCE), F.lit(0))
    return [
        F.coalesce(F.sum(short), F.lit(0)).cast("long").alias("n_missing"),
        F.coalesce(F.sum(surplus), F.lit(0)).cast("long").alias("n_extra"),
    ]


def _verdict(totals: DataFrame, sink_name: str) -> DataFrame:
    """Name, counts and status from the four counts of a comparison.

    The verdict rests on the rows, not on equal counts: a sink that lost one
    row and gained another has equal counts and still differs.
    """
    same = (F.col("n_missing") == 0) & (F.col("n_extra") == 0)
    return totals.select(
        F.lit(sink_name).alias("sink"),
        IN_SOURCE,
        IN_SINK,
        "n_missing",
        "n_extra",
        (F.col(IN_SOURCE) == F.col(IN_SINK)).alias("counts_equal"),
        F.when(same, MATCH).otherwise(DIFFERS).alias("status"),
    )


def summary(compared: DataFrame, sink_name: str = "sink") -> DataFrame:
    """One row of counts and a verdict."""
    totals = [
        F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in (IN_SOURCE, IN_SINK)
    ]
    return _verdict(compared.agg(*totals, *_shortfall()), sink_name)


def summary_of_differences(found: DataFrame, n_source: int, sink_name: str = "sink") -> DataFrame:
    """The same row from the differences alone and the number of source rows.

    The sink holds what was written, less the missing, plus the extra rows, so
    neither side has to be counted by a scan of its own.
    """
    totals = found.agg(*_shortfall()).withColumn(IN_SOURCE, F.lit(n_source).cast("long"))
    held = F.col(IN_SOURCE) - F.col("n_missing") + F.col("n_extra")
    return _verdict(totals.withColumn(IN_SINK, held), sink_name)


def summaries(source: DataFrame, sinks: dict[str, DataFrame]) -> DataFrame:
    """One summary row per named sink."""
    rows = [summary(compare(source, sink), name) for name, sink in sinks.items()]
    return reduce(DataFrame.union, rows)


# The numbers of that many differing buckets are still small enough to broadcast,
# and their bits stay apart from those of the digest.
MOST_BUCKETS = 1 << 20
# A hash is summed in pieces of this many bits: the sums of 2^43 rows fit a long.
PIECE_BITS = 20


def row_digest(names: Sequence[str], buckets: int) -> tuple[Column, list[Column]]:
    """Bucket of a row, and 100 further bits of two hashes in summable pieces.

    Spark's hash skips nulls, so the null positions are hashed with the values;
    otherwise (a, null) and (null, a) would look the same.
    """
    parts = [part for n in names for part in (F.col(n).isNull(), F.col(n))]
    first, second = F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)
    mask = F.lit((1 << PIECE_BITS) - 1)
    pieces = [
        F.shiftrightunsigned(bits, shift).bitwiseAND(mask)
        for bits, shift in ((first, 24), (first, 44), (second, 0), (second, 20), (second, 40))
    ]
    return F.pmod(first, F.lit(buckets)).cast("int"), pieces


def same_types(source: DataFrame, sink: DataFrame) -> list[DataFrame]:
    """Both sides with the columns of the first in types that hold either: the hash of 1 differs between int and long."""
    common = source.limit(0).union(sink.select(*source.columns).limit(0)).schema
    return [
        frame.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in common.fields))
        for frame in (source, sink)
    ]


def narrow(source: DataFrame, sink: DataFrame, buckets: int = 1 << 16) -> tuple[DataFrame, DataFrame]:
    """Both sides without the buckets of rows that hold the same multiset.

    For large sinks that are nearly complete: a first pass sends one small
    digest per bucket and map task through the shuffle, and only rows of
    differing buckets remain for :func:`compare`. Missing and extra rows are
    those of the whole frames, totals are not. Two buckets are taken as equal
    when their counts and the exact sums of all hash pieces agree. The numbers
    of the differing buckets, at most ``buckets``, are staged and broadcast.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MOST_BUCKETS}")
    names = source.columns
    bucket, pieces = row_digest(names, buckets)
    sides = same_types(source, sink)
    sums = ["_n", *(f"_h{i}" for i in range(len(pieces)))]
    tagged = [
        side.select(
            bucket.alias("_bucket"),
            *((value * sign).alias(name) for name, value in zip(sums, [F.lit(1).cast("long"), *pieces])),
        )
        for side, sign in zip(sides, (1, -1))
    ]
    unequal = reduce(Column.__or__, [F.col(name) != 0 for name in sums])
    differing = (
        tagged[0]
        .union(tagged[1])
        .groupBy("_bucket")
        .agg(*(F.sum(name).alias(name) for name in sums))
        .filter(unequal)
        .select("_bucket")
    )
    differing = F.broadcast(stage(differing, "buckets"))
    kept = [side.withColumn("_bucket", bucket).join(differing, "_bucket", "left_semi") for side in sides]
    return kept[0].select(*names), kept[1].select(*names)
