from itertools import combinations

import pytest
from hypothesis import given, settings, strategies as st

from syncspark.llm.packing import bucket_bounds, pack
from pyspark.sql import functions as F


def padded(histogram, bounds):
    return sum(n * min(b for b in bounds if b >= length) for length, n in histogram.items())


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 5))
def test_bounds_have_the_least_padding(histogram, buckets):
    bounds = bucket_bounds(histogram, buckets)
    lengths = sorted(histogram)
    best = min(padded(histogram, (*some, lengths[-1])) for k in range(min(buckets, len(lengths))) for some in combinations(lengths[:-1], k))
    assert len(bounds) <= buckets and bounds == sorted(set(bounds)) and padded(histogram, bounds) == best


def test_no_lengths_no_buckets():
    assert bucket_bounds({}, 4) == []


def check(rows, window, budget):
    """Batches are full but for the last of a bucket, and every token has one place."""
    places = [(r["bucket_length"], r["batch"], r["slot"]) for r in rows if r["bucket_length"]]
    assert len(set(places)) == len(places)
    for bucket in {p[0] for p in places}:
        room = max(1, budget // bucket)
        own = sorted((b, s) for x, b, s in places if x == bucket)
        assert own == [(i // room, i % room) for i in range(len(own))]
    assert all(0 <= r["n_tokens"] <= min(window, r["bucket_length"]) for r in rows)
    for r in rows:
        assert (r["batch"] is None) == (r["n_tokens"] == 0)


def test_hard_documents(hard_docs, local_rows):
    rows = local_rows(pack(hard_docs, window=50, buckets=3, batch_tokens=200))
    check(rows, 50, 200)
    total = {}
    for r in rows:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
    expected = {}
    for r in hard_docs.select("doc_id", "text").collect():
        expected[r.doc_id] = expected.get(r.doc_id, 0) + len((r.text or "").split())
    assert total == expected


def test_empty_table(no_docs):
    assert pack(no_docs).count() == 0


def test_order_and_bounds_over_partitions(spark, local_rows):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 37).cast("int")).alias("text")).repartition(7)
    rows = local_rows(pack(docs, window=30, buckets=4, batch_tokens=120))
    check(rows, 30, 120)
    histogram = {}
    for r in rows:
        if r["n_tokens"]:
            histogram[r["n_tokens"]] = histogram.get(r["n_tokens"], 0) + 1
    assert sorted({r["bucket_length"] for r in rows} - {0}) == bucket_bounds(histogram, 4)
    for bucket in {r["bucket_length"] for r in rows} - {0}:
        own = sorted((r["batch"], r["slot"], r["doc_id"], r["piece"]) for r in rows if r["bucket_length"] == bucket)
        assert [x[2:] for x in own] == sorted(x[2:] for x in own)


@pytest.mark.parametrize("budget", [1, 10_000])
def test_a_batch_holds_at_least_one_sequence(hard_docs, local_rows, budget):
    check(local_rows(pack(hard_docs, window=64, buckets=2, batch_tokens=budget)), 64, budget)


def test_repeated_ids_have_one_result(spark, local_rows):
    """Rows of one id, or of none, in any order and partitioning."""
    rows = [(None if i % 3 else 7, "w " * (i * i % 41)) for i in range(600)]
    results = []
    for parts, order in ((2, rows), (5, rows[::-1])):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(parts)
        found = local_rows(pack(docs, window=30, buckets=4, batch_tokens=120))
        check(found, 30, 120)
        results.append(sorted((tuple(sorted(r.items())) for r in found), key=repr))
    assert results[0] == results[1]
