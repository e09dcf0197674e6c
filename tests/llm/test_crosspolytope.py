import math

import numpy as np
import pytest

from syncspark.llm import crosspolytope as cp


def brute_force(rows, k=5, every=50):
    valid = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            valid[i] = np.array(v, float)
    out = {}
    for q, x in valid.items():
        if q % every == 0:
            scores = [(-float(x @ y) / (np.linalg.norm(x) * np.linalg.norm(y)), i) for i, y in valid.items() if i != q and len(y) == len(x)]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in near}) for q, near in want.items()) / sum(map(len, want.values()))


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(6)
    centres = r.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + r.normal(size=24)).tolist()) for i in range(3000)]
    return rows


@pytest.mark.parametrize("bucket_rows", [65_536, 20])
def test_recall_and_exact_scores(spark, vectors, bucket_rows):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(4)
    vectors = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in vectors]
    want = brute_force(vectors)
    got = found(cp.search(df, settings=cp.Settings(bucket_rows=bucket_rows)))
    assert recall(got, want) >= 0.9 and set(got) == set(want)
    own = dict(vectors)
    for q, near in got.items():
        for i, s in near:
            a, b = np.array(own[q]), np.array(own[i])
            assert abs(s - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_copies_tie_to_smaller_ids(spark):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(i), 1.0, -2.0]) for i in range(1, 400)]
    rows += [(0, [1.0, 2.0, 3.0]), (0, [1.0, 2.0, 3.0])]
    got = found(cp.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)))
    assert [i for i, _ in got[0]] == [3, 6, 9, 12, 15] and len({s for _, s in got[0]}) == 1
    assert [i for i, _ in got[150]] == [0, 3, 6, 9, 12]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, None), (100, [0.0, 0.0]), (150, [nan, 1.0]), (200, [inf, 1.0]), (250, [None, 1.0]), (300, []), (None, [1.0, 0.0]), (7, [1.0, 1.0]), (8, [-1.0, 0.0]), (9, [1.0, 2.0, 3.0]), (350, [2.0, 1.0, 0.0]), (400, [1e200, 1e200]), (450, [1e-200, 0.0])]
    got = found(cp.search(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, ids int, bucket string")))
    assert set(got) == {0, 350, 400, 450}
    assert sorted(i for i, _ in got[0]) == [7, 8, 400, 450] and [i for i, _ in got[350]] == [9]


def test_fewer_candidates_than_wanted(spark):
    schema = "vec_id long, embedding array<float>"
    assert cp.search(spark.createDataFrame([], schema)).count() == 0
    assert cp.search(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    assert found(cp.search(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], schema))) == {0: [(1, 0.0)]}


def test_hadamard_is_orthonormal():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(cp.hadamard(cp.hadamard(x)), x) and np.allclose((cp.hadamard(x) ** 2).sum(1), (x**2).sum(1))


@pytest.mark.parametrize("length", [1, 2])
def test_first_probe_is_the_own_bucket_and_probes_reach_all(length):
    x = np.random.default_rng(1).normal(size=(30, 4))
    turns = cp.Rotations(4, length, 0, 1)
    probes = turns.probes(x, 8**length)
    assert (probes[:, 0] == turns.bucket(x)).all()
    assert all(sorted(p) == list(range(8**length)) for p in probes.tolist())


@pytest.mark.parametrize("length", [1, 2])
def test_places_are_those_of_the_probes(length):
    r = np.random.default_rng(2)
    q, v = r.normal(size=(2, 40, 4))
    turns = cp.Rotations(4, length, 0, 1)
    hit = turns.probes(q, 8**length) == turns.bucket(v)[:, None]
    assert (turns.places(q, v) == hit.argmax(1) + 1).all()


def test_wished_recall_where_long_buckets_miss_it(spark):
    """Far neighbours of 128 dimensions: 4,096 of the 65,536 buckets of two axes do not hold 97 % of them."""
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(4).normal(size=(1500, 128)))]
    got = found(cp.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2), settings=cp.Settings(bucket_rows=4)))
    assert recall(got, brute_force(rows)) >= 0.97


def test_packs_of_probes_are_made_in_blocks(spark, vectors, monkeypatch):
    df = spark.createDataFrame(vectors[:300], "vec_id long, embedding array<float>")
    (batch,) = cp.valid_vectors(df, "vec_id", "embedding").coalesce(1).toArrow().combine_chunks().to_batches()
    monkeypatch.setattr(cp, "_BLOCK", 1 << 16)
    packs = list(cp._packed(cp.Settings(), 2, 50)([batch]))
    assert len(packs) > 4 and all(sum(map(len, p.column("vectors").to_pylist())) <= 8 << 16 for p in packs)
    assert sum(len(i) // 8 for p in packs for i in p.column("ids").to_pylist()) == 4 * 50 * 300


def test_many_ties_of_a_pack_go_to_smaller_ids(spark):
    """Scaled copies of one direction are different vectors that score the same; an id counts once, however many vectors it has."""
    rows = [(i, [x * 2.0 ** (i % 61) for x in (1.0, 2.0, 3.0)]) for i in reversed(range(61))]
    got = found(cp.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[50]] == [0, 1, 2, 3, 4]
    rows = [(0, [1.0, 2.0, 3.0])] + [(9, [2.0**n, 2.0 ** (n + 1), 3.0 * 2.0**n]) for n in range(40)] + [(i, [1.0, 2.0, 3.0 + i]) for i in range(1, 5)]
    got = found(cp.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)))
    assert [i for i, _ in got[0]] == [9, 1, 2, 3, 4]


def test_ids_of_many_vectors_while_probes_are_chosen(spark):
    """One id holds half of all vectors: each neighbour brings one vector to the driver."""
    random = np.random.default_rng(4)
    rows = [(i if i % 2 else 1, [float(x) for x in random.normal(size=16)]) for i in range(800)] + [(50 * i, [float(x) for x in random.normal(size=16)]) for i in range(1, 5)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = cp.search(data).collect()
    kept = {}
    for i, v in rows:
        kept.setdefault(i, []).append(np.asarray(v, np.float32).astype(float))
    for q in (50, 100, 150, 200):
        own = kept[q][0]
        best = sorted(((-max(float(own @ v / np.linalg.norm(own) / np.linalg.norm(v)) for v in vs), i) for i, vs in kept.items() if i != q))[:5]
        got = {r.vec_id for r in found if r.query_id == q}
        assert len(got) == 5 and len(got & {i for _, i in best}) >= 3
