import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from syncspark.llm import suffix_dedup as sd


def brute_force(rows):
    """``(doc_id, text)`` rows to digests, and the kept bytes."""
    order = lambda i: float("inf") if i is None else i
    least = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, x in raw:
        for p in range(len(x) - 49):
            s = x[p : p + 50]
            least[s] = min(least.get(s, float("inf")), order(i))
    out, kept = [], []
    for i, x in raw:
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - 49):
            if least[x[p : p + 50]] < order(i):
                gone[p : p + 50] = True
        left = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(1 for p in range(len(x)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(x), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
        kept.append(left)
    return sorted(out, key=repr), kept


@pytest.fixture(scope="module")
def shared():
    """Texts with common passages of about the width, overlaps, repeats inside one text, and copies."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(n)) for n in (8, 12, 13, 14, 20, 40)]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(r.randrange(0, 6)):
            p = r.choice(passages)
            a = r.randrange(len(p) // 2)
            parts.append(r.choice([p, p[a:], p[: len(p) - a], " ".join(word() for _ in range(9)), passages[3]]))
        rows.append((i * 31 % 151, " ".join(parts)))
    return rows + [(500, rows[7][1]), (501, rows[7][1]), (501, rows[9][1]), (None, rows[9][1]), (None, rows[11][1]), (502, passages[5] * 3)]


@pytest.mark.parametrize("s", [sd.Settings(), sd.Settings(chunk=900, bucket=1500, hot=3, shallow=1), sd.Settings(chunk=200, bucket=400, hot=10_000)])
def test_bytes_of_brute_force(spark, shared, s):
    docs = spark.createDataFrame(shared, "doc_id long, text string").repartition(3)
    expected, _ = brute_force(shared)
    assert sorted(map(tuple, sd.repeated_passages(docs, s).collect()), key=repr) == expected


def test_hard_documents(hard_docs, no_docs, local_rows):
    rows = [(r.doc_id, r.text) for r in hard_docs.select("doc_id", "text").collect()]
    expected, kept = brute_force(rows)
    assert sorted(map(tuple, sd.repeated_passages(hard_docs).collect()), key=repr) == expected
    cut = sd.without_repeated_passages(hard_docs)
    assert cut.columns == hard_docs.columns
    found = local_rows(cut)
    assert sorted((repr(r["doc_id"]), r["text"]) for r in found) == sorted((repr(i), k.decode("utf-8", "ignore")) for (i, _), k in zip(rows, kept))
    assert all(r["hash"] == "h" and r["chunk"] == 4 for r in found)
    assert sd.repeated_passages(no_docs).count() == 0 and sd.without_repeated_passages(no_docs).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(min_size=6, max_size=6), min_size=1, max_size=40), st.integers(0, 2))
def test_deep_shallow_order(strings, zeros):
    strings = [b"\0" * 4 * zeros + b"ab" * 4 + s + bytes(4) for s in strings]
    rows = np.frombuffer(b"".join(strings), np.uint8).reshape(len(strings), -1)
    for shallow in (1, 2, 3):
        order = sd.deep_shallow_order(rows, shallow)
        assert sorted(order.tolist()) == list(range(len(strings)))
        assert [strings[i] for i in order] == sorted(strings)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=2, max_size=2), min_size=1, max_size=60))
def test_multikey_quicksort(rows):
    words = np.array(rows, np.uint64)
    order, ends = sd.multikey_quicksort(words)
    ordered = [tuple(rows[i]) for i in order]
    assert ordered == sorted(map(tuple, rows))
    assert ends.tolist() == [i + 1 for i in range(len(rows)) if i + 1 == len(rows) or ordered[i] != ordered[i + 1]]


def test_runs_cover_every_string_once():
    r = np.random.default_rng(1)
    sizes = [0, 49, 50, 51, 200, 0, 3000, 7]
    data = r.integers(97, 100, sum(sizes)).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    old, sd._SEGMENT = sd._SEGMENT, 256
    try:
        runs = sd.find_runs(data, offsets)
    finally:
        sd._SEGMENT = old
    starts = sorted(p for a, b in zip(runs.first.tolist(), runs.last.tolist()) for p in range(a, b + 1))
    assert starts == [p for a, n in zip(offsets[:-1].tolist(), sizes) for p in range(a, a + n - 49)]
    assert ((runs.anchor >= runs.last) & (runs.anchor <= runs.first + 30)).all()
