"""Cleaning and packing of a corpus: each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncspark.llm import grace_dedup, lsh_forest, packing, quality, suffix_dedup
from syncspark.llm.ship import with_package
from syncspark.workspace import scratch, stage

_LAST_ID = (1 << 63) - 1


def kept_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text are marked ``kept``; of rows that repeat both, one.

    Both steps need the rows dealt by the same key, so texts move once.
    """
    name = lambda id_: F.coalesce(id_.cast("long"), F.lit(_LAST_ID))
    marked = decisions.where("kept").select(name(F.col("doc_id")).alias("_id"), F.col("raw").alias("_raw"))
    keyed = docs.withColumn("_id", name(F.col("doc_id"))).withColumn("_raw", F.xxhash64(F.col("text").cast("string")))
    return keyed.join(marked, ["_id", "_raw"], "left_semi").dropDuplicates(["_id", "_raw"]).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return kept_rows(docs, grace_dedup.exact_duplicates(docs))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: of the smallest id, among its rows of the smallest hash of the text."""
    rows = lsh_forest.near_groups(docs).select(F.coalesce("doc_id", F.lit(_LAST_ID)).alias("doc_id"), "raw", "group")
    first = rows.where("group IS NOT NULL").groupBy("group").agg(F.min(F.struct("doc_id", "raw")).alias("one")).select("one.*")
    # Texts without words are copies of nothing.
    alone = rows.where("group IS NULL").select("doc_id", "raw")
    return kept_rows(docs, first.unionByName(alone).withColumn("kept", F.lit(True)))


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with earlier ones."""
    return suffix_dedup.without_repeated_passages(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of the remaining documents in padded batches."""
    return packing.pack(docs)


STAGES = [
    ("quality", with_package(quality_stage)),
    ("exact", with_package(exact_stage)),
    ("near", with_package(near_stage)),
    ("passages", with_package(passages_stage)),
    ("packing", with_package(packing_stage)),
]

# A trained model, a search over signatures and repeated byte strings are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    with scratch(spark):
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, function in STAGES[:-1]:
            docs = stage(function(spark, docs, sf_dir), name)
        name, function = STAGES[-1]
        return stage(function(spark, docs, sf_dir), name, keep=True)
