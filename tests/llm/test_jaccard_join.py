import random
import re

import numpy as np
import pytest
from hypothesis import given, settings as examples, strategies as st

from syncspark.llm.jaccard_join import Settings, jaccard_components, linked, subset_keys

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def is_link(a, b, percent=80):
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def components(sets):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if is_link(a, sets[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    roots, out = components(sets), []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if roots[j] == roots[i] and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None) if sets[i] else doc_id))
    return sorted(out, key=repr)


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"w{r.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def copies():
    """Groups of near copies around the threshold, short texts that differ at their ends, shared passages, exact copies."""
    r = random.Random(8)
    texts = []
    for group, size in enumerate([90, 30, 8, 4, 2, 2]):
        base = [f"t{group}x{r.randrange(400)}" for _ in range(r.randrange(60, 200))]
        texts += [edited(r, base, r.randrange(0, len(base) // 20)) for _ in range(size)]
    for group in range(12):
        base = [f"s{group}x{i}" for i in range(r.randrange(3, 24))]
        for _ in range(8):
            kind = r.randrange(4)
            texts.append([base + ["end"], base[: -1 or None], base[1:], base[:-1] + [f"e{r.randrange(3)}"]][kind])
    passage = [f"p{i}" for i in range(40)]
    texts += [[f"a{r.randrange(10**6)}" for _ in range(r.randrange(0, 30))] + passage + [f"b{r.randrange(10**6)}" for _ in range(r.randrange(0, 6))] for _ in range(40)]
    texts += [[f"u{r.randrange(10**5)}" for _ in range(r.randrange(0, 40))] for _ in range(30)]
    texts += texts[:5] * 3
    return [(i * 7 % 1009, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("settings", [Settings(), Settings(boundary=0, chunk=300, bucket=500), Settings(boundary=14, cluster=1500)])
def test_components_of_brute_force(spark, copies, settings):
    docs = spark.createDataFrame(copies, "doc_id long, text string").repartition(4)
    found = jaccard_components(docs, settings=settings)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(copies)


def test_hard_rows_words_that_polynomials_confuse_and_empty_tables(spark, hard_docs, no_docs):
    found = jaccard_components(hard_docs)
    rows = [(r.doc_id, r.text) for r in hard_docs.collect()]
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(rows)
    assert jaccard_components(no_docs).collect() == []
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(4096))
    twins = [(1, word), (2, word.translate(str.maketrans("ab", "ba")))]
    found = jaccard_components(spark.createDataFrame(twins, "doc_id long, text string"))
    assert sorted(r.component_id for r in found.collect()) == [1, 2]


@examples(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1, max_size=12), min_size=1, max_size=14))
def test_scanned_lists_connect_what_links_connect(sets):
    found = linked([np.array(sorted(s), np.uint64) for s in sets], Settings())
    parent = list(range(len(sets)))
    for i, j in found:
        assert is_link(sets[i], sets[j])
        old, new = parent[j], parent[i]
        parent = [new if p == old else p for p in parent]
    expected = components(sets)
    assert [[p == q for q in parent] for p in parent] == [[p == q for q in expected] for p in expected]


@examples(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 12), min_size=1, max_size=10), st.sets(st.integers(0, 12), min_size=1, max_size=10))
def test_light_sets_list_a_common_subset_if_they_link(a, b):
    keys = [set(subset_keys(np.array(sorted(s), np.uint64), Settings(), 10)) for s in (a, b)]
    both = min(len(a), len(b)), max(len(a), len(b))
    assert is_link(a, b) == any(k[:2] == both for k in keys[0] & keys[1])


def test_boundary_grows_with_the_lists(spark):
    from syncspark.llm.jaccard_join import _boundary

    short = spark.createDataFrame([(t, s) for t in range(20) for s in range(2)], "token long, set_key long")
    long = spark.createDataFrame([(t, s) for t in range(20) for s in range(60)], "token long, set_key long")
    assert 0 < _boundary(short, Settings()) < _boundary(long, Settings()) <= Settings().lightest
