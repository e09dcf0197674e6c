"""Key-value records: one map of text fields per entity key, and a key index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from syncspark.functions.scalars import entity_key, field_map
from syncspark.schemas import ENTITY_PREFIX
from syncspark.workspace import stage

KEY = "entity_key"
FIELDS = "fields"


def to_records(df: DataFrame, key: str, fields: Sequence[str], prefix: str = ENTITY_PREFIX) -> DataFrame:
    """``entity_key`` and a map of the fields as text."""
    return df.select(entity_key(F.col(key), prefix).alias(KEY), field_map(fields).alias(FIELDS))


def record_fields(records: DataFrame) -> DataFrame:
    """One row per key, field and value."""
    return records.select(KEY, F.explode(FIELDS).alias("field", "value"))


def key_index(records: DataFrame) -> DataFrame:
    """The set of keys, as a staged table: it may be larger than one task can hold.

    A join with the table deals both sides out for itself, so adaptive execution
    can split the partition of a hot key; below a join, the grouping that makes
    keys distinct would forbid that.
    """
    return stage(records.select(KEY).distinct(), "key-index")


def store_records(records: DataFrame, table: str, buckets: int) -> DataFrame:
    """Write records as a table that is looked up without dealing it out again.

    The table is bucketed and sorted by key, one file a bucket, so
    :func:`lookup` and :func:`members` shuffle the requests alone. Take at least
    as many buckets as the session has shuffle partitions, and so many that
    one fits a task. The requests of a bucket meet in one task, which adaptive
    execution cannot split: where a key may hold a large share of the requests,
    look it up in records that are not bucketed.
    """
    dealt = records.repartition(buckets, KEY)
    dealt.write.bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(table)
    return records.sparkSession.table(table)


def members(candidates: DataFrame, index: DataFrame) -> DataFrame:
    """Candidates whose key is in the index."""
    return candidates.join(index, KEY, "left_semi").select(*candidates.columns)


def lookup(requests: DataFrame, records: DataFrame, field: str | None = None) -> DataFrame:
    """The record of each requested key, or one of its fields.

    ``records`` holds a key once; a key without a record gives no row.
    """
    value = F.col(FIELDS) if field is None else F.try_element_at(F.col(FIELDS), F.lit(field)).alias("value")
    return requests.join(records, KEY).select(*requests.columns, value)


def check_records(expected: DataFrame, records: DataFrame, index: DataFrame, field: str) -> DataFrame:
    """Per expected (entity_key, value): is the field right, is the key indexed?

    Both lookups are brought together first, as a table, and joined once: a
    second join on the partitioning of the first could not split a hot key.
    """
    found = records.select(
        KEY, F.try_element_at(F.col(FIELDS), F.lit(field)).alias("_found"), F.lit(True).alias("_present")
    )
    known = index.select(KEY, F.lit(True).alias("_indexed"))
    value_ok = F.col("_present").isNotNull() & F.col("value").eqNullSafe(F.col("_found"))
    lookups = stage(found.join(known, KEY, "full"), "lookups")
    return expected.join(lookups, KEY, "left").select(
        KEY, value_ok.alias("value_ok"), F.col("_indexed").isNotNull().alias("indexed")
    )
