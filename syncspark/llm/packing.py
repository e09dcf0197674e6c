"""Packing of documents into batches of padded sequences, with optimal length buckets.

The histogram of lengths of the whole corpus decides where buckets end: dynamic
programming finds the bounds with the least padding. Sequences of a bucket are
then put into batches one after another, as many as the token budget allows.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from syncspark.workspace import scratch, stage

WINDOW = 2048
BUCKETS = 12
BATCH_TOKENS = 65_536
_ROW_BITS = 33


def word_count(text: str = "text") -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null counts as empty."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def bucket_bounds(histogram: Mapping[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least padding.

    ``histogram`` gives the sequences of each length. The cost of a bucket is
    its bound for each sequence in it. Of equally good bounds the smaller ones
    are taken, and no more buckets than lower the cost.
    """
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    counts = np.concatenate([[0], np.cumsum([histogram[int(n)] for n in lengths])]).astype(np.int64)
    m = len(lengths)
    best = lengths * counts[1:]
    choices = []
    # best[j]: least padded tokens of the lengths up to j with the buckets so far.
    for _ in range(1, min(buckets, m)):
        nxt, choice = best.copy(), np.full(m, -1, np.int64)
        for j in range(1, m):
            cost = best[:j] + lengths[j] * (counts[j + 1] - counts[1 : j + 1])
            i = int(cost.argmin())
            if cost[i] < nxt[j]:
                nxt[j], choice[j] = cost[i], i
        choices.append(choice)
        if nxt[-1] == best[-1]:
            break
        best = nxt
    bounds, j = [m - 1], m - 1
    for choice in reversed(choices):
        if choice[j] >= 0:
            j = int(choice[j])
            bounds.append(j)
    return [int(lengths[i]) for i in sorted(bounds)]


def pieces(docs: DataFrame, doc_id: str, length: Column, window: int) -> DataFrame:
    """``doc_id, piece, n_tokens``: documents longer than ``window`` in consecutive pieces."""
    sized = docs.select(F.col(doc_id).cast("long").alias("doc_id"), length.alias("_length"))
    last = F.greatest(F.lit(0), F.ceil(F.col("_length") / window) - 1).cast("int")
    cut = sized.select("doc_id", "_length", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    rest = F.col("_length") - F.col("piece").cast("long") * window
    return cut.select("doc_id", "piece", F.least(F.lit(window).cast("long"), rest).alias("n_tokens"))


def pack(docs: DataFrame, doc_id: str = "doc_id", length: Column | None = None, window: int = WINDOW, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """One row per piece of a document: ``doc_id, piece, n_tokens, bucket_length, batch, slot``.

    ``length`` is the number of tokens, by default that of the words of
    ``text``. Batches are numbered in each bucket, in the order of ``doc_id`` and
    ``piece`` (null ids first, of repeated ids the shorter piece first); a batch holds
    ``batch_tokens // bucket_length`` sequences, at least one, and only the last
    of a bucket may hold fewer. Documents without tokens have one piece of length
    0, bucket 0 and neither batch nor slot. Repeated rows are packed each, an
    empty table gives an empty result; other columns are not read.

    The histogram has at most ``window`` rows. Rows are dealt out by bucket and
    id in ranges, numbered in each range and shifted by the sizes of the ranges
    before it: neither a bucket nor an id that repeats often meets in one task.
    """
    with scratch(docs.sparkSession):
        cut = stage(pieces(docs, doc_id, word_count() if length is None else length, window), "pieces")
        histogram = {r.n_tokens: r["count"] for r in cut.where("n_tokens > 0").groupBy("n_tokens").count().collect()}
        bounds = bucket_bounds(histogram, buckets)
        bucket = F.lit(0)
        for bound in reversed(bounds):
            bucket = F.when(F.col("n_tokens") <= bound, F.lit(bound)).otherwise(bucket)
        bucket = F.when(F.col("n_tokens") <= 0, F.lit(0)).otherwise(bucket).cast("long")
        # Pieces that agree in all but the last are alike in the result, too.
        order = ["bucket_length", "doc_id", "piece", "n_tokens", "_spread"]
        ranged = cut.withColumn("bucket_length", bucket).withColumn("_spread", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*order).sortWithinPartitions(*order)
        placed = stage(ranged.withColumn("_place", F.monotonically_increasing_id()), "placed")
        placed = placed.withColumn("_part", F.shiftright("_place", _ROW_BITS))
        runs = placed.groupBy("bucket_length", "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
        earlier = Window.partitionBy("bucket_length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        runs = runs.select("bucket_length", "_part", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        at = F.col("_before") + F.col("_place") - F.col("_first")
        room = F.greatest(F.lit(1), F.floor(F.lit(batch_tokens) / F.col("bucket_length"))).cast("long")
        filled = F.col("bucket_length") > 0
        return stage(
            placed.join(runs, ["bucket_length", "_part"]).select(
                "doc_id", "piece", "n_tokens", "bucket_length",
                F.when(filled, F.floor(at / room)).alias("batch"),
                F.when(filled, at % room).alias("slot"),
            ),
            "packed",
            keep=True,
        )
