import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings as examples, strategies as st

from syncspark.llm import divergence
from syncspark.llm.divergence import Settings, pair_sums, skyband

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_force(rows, least=3, ranks=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, docs, groups = {}, Counter(), {}
    for text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
        groups.setdefault(lang, set()).add(source)
        counts.setdefault((lang, source), Counter()).update(words)
        docs.update((lang, w) for w in set(words))
    out = []
    for lang, sources in groups.items():
        kept = sorted(w for (at, w), n in docs.items() if at == lang and n >= least)
        total = Counter()
        for s in sources:
            total.update({w: counts[lang, s][w] for w in kept})

        def shares(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 1) // (n + len(kept)) for w in kept}

        q = shares(total)
        p = {s: shares(counts[lang, s]) for s in sources}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(sum(f(p[s][w], p[o][w]) for w in kept), o) for o in sources if o != s]
            terms = [(f(p[s][w], q[w]), w) for w in kept if counts[lang, s][w] > 0 and p[s][w] > q[w]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, ranks)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out.extend((lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items[:most]))
    return sorted(out)


def corpus(n, seed):
    r = random.Random(seed)
    words = [f"{c}{d}" for c in "abcdefÉß" for d in ("", "x", "yy", "Ö", "Zz", "q")] + ["don't", "x9y", "日本", "A_b"]
    rows = []
    for _ in range(n):
        lang, source = r.choice(["en", "en", "de", None]), r.choice(["s1", "s1", "s1", "s2", "s3", None])
        text = None if r.random() < 0.05 else " ".join(r.choices(words, weights=[i + 1 + 5 * len(str(source)) * (i % 7 == 0) for i in range(len(words))], k=r.randrange(0, 30)))
        rows.append((text, lang, source))
    return rows


SCHEMA = "text string, lang string, source string, term int, n int, m int, p int, q int, bucket int, own int, part string, rank int"


@pytest.mark.parametrize("settings", [Settings(), Settings(documents=2, ranks=3, rows=5, held=20)])
def test_rows_of_brute_force(spark, settings):
    rows = corpus(150, 3) + [("only here", "xx", "lonely"), (None, "yy", "a"), ("", "yy", "b"), ("Zebra zebra 12 zebra", "yy", "b")]
    rows += [("run " * 9000, "en", "s9")] * 3
    docs = spark.createDataFrame([(*r, *[1] * 7, "p", 2) for r in rows], SCHEMA).repartition(3)
    found = divergence.divergence(docs, settings=settings)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == brute_force(rows, settings.documents, settings.ranks)


def test_empty_table(spark):
    assert divergence.divergence(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_texts_are_split_at_blanks(monkeypatch):
    monkeypatch.setattr(divergence, "_SEGMENT", 7)
    raw = "One twoé, three-four5five aVeryLongWordIndeed x ".encode() * 5
    assert [w for part in divergence._segments(raw) for w in part] == "one twoé three four five averylongwordindeed x".encode().split() * 5


@examples(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5), st.integers(1, 5), st.integers(0, 60)), max_size=40, unique_by=lambda x: x[2]), st.integers(1, 5))
def test_skyband_of_its_definition(terms, k):
    n, m, t = (np.array(x, np.int64) for x in (zip(*terms) if terms else ([], [], [])))
    names = pa.array([f"{x:03d}".encode() for x in t], pa.binary())
    expected = [i for i in range(len(terms)) if sum((n[j] >= n[i]) & (m[j] <= m[i]) & (t[j] < t[i]) for j in range(len(terms))) < k]
    assert sorted(skyband(n, m, names, k).tolist()) == expected


def test_pair_sums_of_their_definition(monkeypatch):
    monkeypatch.setattr(divergence, "_CELLS", 10)
    p = np.random.default_rng(1).integers(1, 10**9, (23, 4))
    expected = [[sum((int(r[a]) - int(r[b])) ** 2 // int(r[b]) for r in p) for b in range(4)] for a in range(4)]
    assert pair_sums(p).tolist() == expected
