import random
import re
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from syncspark.llm import lsh_forest
from syncspark.llm.components import connected_components
from syncspark.llm.text import utf8

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_force(rows):
    """Rows of ``(doc_id, text)`` as ``(doc_id, size, component)``; a null id is largest."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=repr)


def edited(random_, words, n):
    words = list(words)
    for _ in range(n):
        words[random_.randrange(len(words))] = f"w{random_.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies(spark):
    """Groups of near copies around the threshold, one of them large, and unrelated texts."""
    r = random.Random(4)
    rows, doc_id = [], 0
    for group, size in enumerate([120, 30, 8, 4, 2, 2, 2, 2]):
        base = [f"t{group}x{r.randrange(400)}" for _ in range(r.randrange(60, 300))]
        for _ in range(size):
            rows.append((doc_id * 7 % 1009, edited(r, base, r.randrange(0, len(base) // 18))))
            doc_id += 1
    for _ in range(60):
        rows.append((doc_id * 7 % 1009, " ".join(f"u{r.randrange(10**5)}" for _ in range(r.randrange(0, 40)))))
        doc_id += 1
    return rows


def test_components_of_brute_force(spark, copies):
    docs = spark.createDataFrame(copies, "doc_id long, text string").repartition(4)
    found = lsh_forest.near_duplicates(docs).drop("raw")
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(copies)


@pytest.mark.parametrize("orders", [1, 6])
def test_clusters_beyond_one_task(spark, copies, orders):
    docs = spark.createDataFrame(copies, "doc_id long, text string").repartition(4)
    s = replace(lsh_forest.Settings(), region=16, cluster=1500, orders=orders)
    found = lsh_forest.near_duplicates(docs, settings=s).drop("raw")
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(copies)


def test_hard_documents(hard_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in hard_docs.select("doc_id", "text").collect()]
    found = lsh_forest.near_duplicates(hard_docs).drop("raw")
    expected = [(i, n, c, i == c) for i, n, c, _ in brute_force(rows)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert lsh_forest.near_duplicates(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="Aab \n É", max_size=24)), max_size=6))
def test_shingle_sets_have_the_sizes_of_the_words(texts):
    data, offsets = utf8(pa.array(texts, pa.string()))
    found = lsh_forest.shingle_sets(data, offsets)
    own = [shingles(t) for t in texts]
    assert [len(s) for s in found] == [len(s) for s in own]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(found[i], found[j])) == len(own[i] & own[j])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1), min_size=1, max_size=9))
def test_exact_join_finds_every_link(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    got = lsh_forest.linked(arrays)
    parent = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= 75 * len(a | b):
                    parent[i] = parent[j] = min(parent[i], parent[j])
    assert got == parent


def test_estimates_are_near_the_similarity():
    r = np.random.default_rng(2)
    base = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
    s = lsh_forest.Settings()
    a, b = np.unique(base[:3000]), np.unique(base[1000:])
    values = lsh_forest.signatures([a, b], s)
    assert abs((values[0] == values[1]).mean() - 0.5) < 0.16


def test_connected_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100)] + [(200, x) for x in range(201, 240)] + [(r.randrange(300, 340), r.randrange(300, 340)) for _ in range(25)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    parent = {x: x for e in edges for x in e}
    for _ in range(60):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert found == parent
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_that_polynomials_confuse_are_told_apart(spark, n):
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, word)]
    found = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (2, 2), (3, 1)]


@pytest.mark.parametrize("region", [2048, 32])
def test_crowded_regions(spark, region):
    """Pairs at 0.77 among thousands of texts that share half of their words, in regions far too small for them."""
    random = np.random.default_rng(8)
    words = lambda n: [f"w{x}" for x in random.integers(0, 10**9, n)]
    head, rows = words(140), []
    for i in range(0, 2000, 2):
        tail = words(64)
        rows += [(i, " ".join(head + tail)), (i + 1, " ".join(head + tail[:-26] + words(26)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = lsh_forest.near_duplicates(docs, settings=lsh_forest.Settings(region=region)).collect()
    component = {r.doc_id: r.component_id for r in found}
    assert all(component[i] == i for i in range(0, 2000, 2))
    assert sum(component[i + 1] == i for i in range(0, 2000, 2)) >= 990
