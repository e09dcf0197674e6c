import hashlib
import math
import random

import numpy as np
import pytest

from syncspark.llm import equal_average
from syncspark.llm.equal_average import Settings, compress, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, code string, length int, share int, of int"


def brute_force(rows, entries=256, rounds=4):
    """Rows ``(vec_id, vector, label)``, all vectors of one length that four divides; Python numbers only."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [[math.floor(float(np.float32(x)) * 1024) for x in v] for _, v, _ in kept]
    if not kept:
        return []
    width = len(whole[0]) // 4
    parts = [[v[p * width : (p + 1) * width] for v in whole] for p in range(4)]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[list(parts[p][i]) for i in first] for p in range(4)]

    def assign(p):
        return [min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(books[p])) for x in parts[p]]

    for _ in range(rounds):
        for p in range(4):
            of = assign(p)
            for j in range(len(books[p])):
                mine = [x for x, (_, k) in zip(parts[p], of) if k == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [assign(p) for p in range(4)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(found[p][i][0] for p in range(4)) for i in range(len(kept))]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    return [(k[0], "".join(f"{found[p][i][1]:02x}" for p in range(4)), errors[i], by_label[k[2]], digest) for i, k in enumerate(kept)]


def rows_of(n, size, seed, scale=1.0):
    r = random.Random(seed)
    few = [[float(np.float32(r.gauss(0, scale))) for _ in range(size)] for _ in range(max(2, n // 2))]
    return [(i * 7 % 1009, r.choice(few) if r.random() < 0.4 else [float(np.float32(r.gauss(0, scale))) for _ in range(size)], r.choice([None, 1, 2])) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "c", 1, 2, 3) for i, v, lab in rows], SCHEMA)


@pytest.mark.parametrize("entries", [256, 9])
def test_codes_of_brute_force(spark, entries):
    rows = rows_of(120, 8, 5, 0.01)
    rows += [rows[0], (None, rows[3][1], None), (None, [0.5] * 8, 1), (900, None, 1), (901, [None] * 8, 1), (902, [math.nan] + [0.0] * 7, 1), (903, [math.inf] + [0.0] * 7, 2)]
    found = compress(frame(spark, rows).repartition(3), settings=Settings(entries=entries))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute_force(rows, entries), key=repr)


def test_ties_take_the_lowest_index_and_bounds_hide_none():
    r = np.random.default_rng(2)
    for _ in range(40):
        entries = r.integers(-4, 5, (r.integers(1, 40), 3))
        parts = r.integers(-6, 7, (50, 3))
        index, best = nearest(parts, entries)
        every = ((parts[:, None] - entries[None]) ** 2).sum(2)
        assert index.tolist() == every.argmin(1).tolist() and best.tolist() == every.min(1).tolist()


def test_very_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(3e38 if i % 2 else -1e30 * i)), 1.0, -1e-30, float(i)], i % 2) for i in range(7)]
    expected = [(i, c, e if e < 1 << 63 else None, None if any(x[2] >= 1 << 63 for x in brute_force(rows, 3) if rows[x[0]][2] == rows[i][2]) else s, d) for i, c, e, s, d in brute_force(rows, 3)]
    assert sorted(map(tuple, compress(frame(spark, rows), settings=Settings(entries=3)).collect())) == sorted(expected)


def test_lengths_apart_empty_vectors_and_empty_tables(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0], 1), (2, [1.0, 2.0, 3.0], 1), (3, [], None), (4, [0.0, 2.0, 3.0, 4.0], None)]
    found = {r.vec_id: r for r in compress(frame(spark, rows)).collect()}
    assert [found[i].code for i in (1, 2, 3, 4)] == ["00000000", "00000000", "00000000", "01010101"[:2] + "000000"]
    assert all(r.error == 0 and r.label_error == 0 for r in found.values())
    assert found[1].codebooks_sha256 != found[2].codebooks_sha256
    empty = frame(spark, []).select("*")
    assert compress(empty).collect() == [] and compress(empty).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_sums_travel_as_digits():
    for n in (0, 1, -1, 1 << 40, -(1 << 40) - 5, 3 << 130):
        assert sum(d << (40 * i) for i, d in enumerate(equal_average._digits(n))) == n
