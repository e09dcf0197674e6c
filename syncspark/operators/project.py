"""Projections, marker column and column changes. All narrow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

MARKER = "run_id"


def users_of(events: DataFrame) -> DataFrame:
    """``actor`` structs of raw events as rows of the Users table."""
    return events.select(
        F.col("actor.id").alias("user_id"),
        F.col("actor.login").alias("login"),
        F.col("actor.gravatar_id").alias("gravatar_id"),
        F.col("actor.avatar_url").alias("avatar_url"),
        F.col("actor.url").alias("url"),
    )


def repositories_of(events: DataFrame) -> DataFrame:
    """``repo`` structs of raw events as rows of the Repositories table."""
    return events.select(
        F.col("repo.id").alias("repo_id"), F.col("repo.name").alias("name"), F.col("repo.url").alias("url")
    )


def tag(df: DataFrame, run_id: str, marker: str = MARKER) -> DataFrame:
    """Mark every row as written by one run."""
    return df.withColumn(marker, F.lit(run_id))


def tagged_with(df: DataFrame, run_id: str, marker: str = MARKER) -> DataFrame:
    """Rows written by one run; an equality that scans can push down."""
    return df.filter(F.col(marker) == run_id)


def align(df: DataFrame, like: DataFrame | Sequence[str]) -> DataFrame:
    """Same columns in the same order as ``like``, matched by name."""
    names = like.columns if isinstance(like, DataFrame) else list(like)
    return df.select(*names)


def with_column_if_missing(
    df: DataFrame, name: str, kind: T.DataType | str, default: Column | None = None
) -> DataFrame:
    if name in df.columns:
        return df
    value = F.lit(None) if default is None else default
    return df.withColumn(name, value.cast(kind))


def without_column(df: DataFrame, path: str) -> DataFrame:
    """Drop a column, or a field of a struct given as ``column.field``.

    A path that does not exist leaves the frame as it is.
    """
    if path in df.columns:
        return df.drop(path)
    parent, _, child = path.partition(".")
    if child and parent in df.columns:
        return df.withColumn(parent, F.col(parent).dropFields(child))
    return df


def first_match(df: DataFrame, key: str, value: object) -> DataFrame:
    """At most one row with this key; the scan stops at the first hit."""
    return df.filter(F.col(key) == F.lit(value)).limit(1)


def preview(df: DataFrame, rows: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The first rows; ordered previews use a per-partition top-n."""
    return (df.orderBy(*order) if order else df).limit(rows)
