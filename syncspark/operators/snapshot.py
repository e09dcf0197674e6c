"""Row changes between two snapshots, as before and after images."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from syncspark.operators.reconcile import IN_SINK, IN_SOURCE, compare, differences, repeat_rows
from syncspark.operators.sequence import copies_before
from syncspark.schemas import STATE_DELETE, STATE_INSERT, STATE_UPDATE
from syncspark.workspace import stage


def snapshot_diff(before: DataFrame, after: DataFrame, key: Sequence[str], unique: bool = True) -> DataFrame:
    """``key``, ``state``, ``old`` and ``new`` (structs of the other columns).

    Equal rows cancel out in one grouping over both snapshots, so only changed
    rows reach the pairing by key; nulls compare as equal.

    With ``unique`` a key may occur once per snapshot. Only changed rows are
    looked at: a key with two rows that differ on one side fails the query,
    whichever columns are selected, while a repeat whose other row is the same in
    both snapshots passes as a change of the one row. :func:`require_unique`
    checks all rows for the price of one more shuffle. Without ``unique`` the changed rows
    of a key are paired one to one, giving as many updates as the shorter side
    has rows and deletes or inserts for the rest.
    """
    keys = list(key)
    columns = before.columns
    payload = [c for c in columns if c not in keys]
    net = F.col(IN_SINK) - F.col(IN_SOURCE)
    rows = differences(compare(before, after)).select(
        *columns, (net > 0).alias("_is_new"), F.abs(net).alias("_copies")
    )
    pair_by = keys
    if not unique:
        rows = stage(rows, "changed")
        placed = copies_before(rows, [*keys, "_is_new"], "_copies", "_first")
        rows = (
            repeat_rows(placed, "_copies", index="_nth")
            .withColumn("_nth", F.col("_first") + F.col("_nth"))
            .withColumn("_copies", F.lit(1).cast("long"))
        )
        pair_by = [*keys, "_nth"]
    image = F.struct(*payload)
    paired = rows.groupBy(*pair_by).agg(
        F.first(F.when(~F.col("_is_new"), image), ignorenulls=True).alias("old"),
        F.first(F.when(F.col("_is_new"), image), ignorenulls=True).alias("new"),
        F.sum(F.when(~F.col("_is_new"), F.col("_copies"))).alias("_n_old"),
        F.sum(F.when(F.col("_is_new"), F.col("_copies"))).alias("_n_new"),
    )
    state: Column = (
        F.when(F.col("_n_new").isNull(), STATE_DELETE)
        .when(F.col("_n_old").isNull(), STATE_INSERT)
        .otherwise(STATE_UPDATE)
    )
    if unique:
        repeated = (F.col("_n_old") > 1) | (F.col("_n_new") > 1)
        # A filter stays in every plan; a check inside a column would go with the column.
        refusal = F.raise_error(F.lit("snapshot_diff: key is not unique, pass unique=False")).cast("boolean")
        paired = paired.filter(F.when(F.coalesce(repeated, F.lit(False)), refusal).otherwise(F.lit(True)))
    return paired.select(*keys, state.alias("state"), "old", "new")


def require_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df`` itself; a key that occurs more than once, changed or not, raises."""
    repeated = df.groupBy(*key).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).select(*key).first()
    if repeated is not None:
        raise ValueError(f"key is not unique: {repeated.asDict()}")
    return df


def _image_log(diff: DataFrame, image: str, states: Sequence[str], at: Column | None) -> DataFrame:
    keys = [c for c in diff.columns if c not in ("state", "old", "new")]
    log = diff.filter(F.col("state").isin(*states)).select(*keys, f"{image}.*", "state")
    return log if at is None else log.withColumn("log_timestamp", at)


def before_log(diff: DataFrame, at: Column | None = None) -> DataFrame:
    """Old images of updated and deleted rows."""
    return _image_log(diff, "old", (STATE_UPDATE, STATE_DELETE), at)


def after_log(diff: DataFrame, at: Column | None = None, include_deletes: bool = False) -> DataFrame:
    """New images of updated and inserted rows.

    Deletes are in the before log only, as consumers of the after log expect;
    ``include_deletes`` adds them with their old image.
    """
    log = _image_log(diff, "new", (STATE_UPDATE, STATE_INSERT), at)
    return log.unionByName(_image_log(diff, "old", (STATE_DELETE,), at)) if include_deletes else log
