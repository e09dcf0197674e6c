"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by fast Hadamard pseudo-rotations and falls to the
nearest signed axis; ``length`` such axes make a bucket of a table. A query
looks into the buckets nearest to it in every table, and all vectors found
there are ranked by their exact cosine.

Vectors travel in packs: the vectors of one task and bucket in one row. Queries
meet the packs of a bucket one by one, so a bucket that holds a large part of
all vectors is shared by many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import pairwise, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from syncspark.workspace import scratch, stage

_KEY = ["tab", "dim", "bucket"]
_PACK = "tab int, dim int, bucket long, ids binary, vectors binary"
# More than the rounding of a product of unit vectors.
_ROUNDING = 1e-10
# Numbers in the packs that are made together, and in the scores of their probes.
_BLOCK = 1 << 24


@dataclass(frozen=True)
class Settings:
    """``probes``: buckets a query looks into per table; None chooses them by the recall on ``sample`` queries.

    Where that takes more than ``long_probes`` buckets, shorter ones are taken.
    """

    tables: int = 4
    probes: int | None = None
    long_probes: int = 4096
    recall: float = 0.97
    sample: int = 150
    bucket_rows: int = 65_536
    seed: int = 3


class Rotations:
    """Pseudo-rotations of one table: signs and Hadamard transforms, three times for each axis of a bucket."""

    def __init__(self, dimension: int, length: int, table: int, seed: int):
        self.size = 1 << max(1, math.ceil(math.log2(max(2, dimension))))
        random = np.random.default_rng([seed, table, dimension])
        self.signs = random.choice([-1.0, 1.0], (length, 3, self.size))

    def turn(self, vectors: np.ndarray) -> list[np.ndarray]:
        """Turned copies of unit vectors, one for each axis of a bucket."""
        padded = np.zeros((len(vectors), self.size))
        padded[:, : vectors.shape[1]] = vectors
        out = []
        for signs in self.signs:
            x = padded
            for s in signs:
                x = hadamard(x * s)
            out.append(x)
        return out

    def axes(self, turned: np.ndarray) -> np.ndarray:
        """All signed axes of each vector, the nearest first."""
        return np.argsort(-np.concatenate([turned, -turned], 1), 1, kind="stable")

    def bucket(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros(len(vectors), np.int64)
        for x in self.turn(vectors):
            out = out * (2 * self.size) + np.concatenate([x, -x], 1).argmax(1)
        return out

    def probes(self, vectors: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` buckets nearest to each vector, by the sum of the distances to their axes."""
        turned = self.turn(vectors)
        if len(turned) == 1:
            return self.axes(turned[0])[:, :n]
        scores, buckets = np.zeros((len(vectors), 1)), np.zeros((len(vectors), 1), np.int64)
        for x in turned:
            both = np.concatenate([x, -x], 1)
            order = np.argsort(-both, 1, kind="stable")[:, : min(n, both.shape[1])]
            gap = both.max(1, keepdims=True) - np.take_along_axis(both, order, 1)
            scores = (scores[:, :, None] + gap[:, None, :] ** 2).reshape(len(vectors), -1)
            buckets = (buckets[:, :, None] * (2 * self.size) + order[:, None, :]).reshape(len(vectors), -1)
            best = np.argsort(scores, 1, kind="stable")[:, :n]
            scores, buckets = np.take_along_axis(scores, best, 1), np.take_along_axis(buckets, best, 1)
        return buckets

    def places(self, queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Number of probes that lead each query to the bucket of the vector beside it; equally near buckets come first."""
        rows = np.arange(len(queries))
        gaps, own = [], np.zeros(len(queries))
        for x, y in zip(self.turn(queries), self.turn(vectors), strict=True):
            both = np.concatenate([x, -x], 1)
            gaps.append((both.max(1, keepdims=True) - both) ** 2)
            own += gaps[-1][rows, np.concatenate([y, -y], 1).argmax(1)]
        *first, last = gaps
        last, out = np.sort(last, 1), np.zeros(len(queries), np.int64)
        for i in rows:
            sums = np.zeros(1)
            for gap in first:
                sums = np.add.outer(sums, gap[i]).ravel()
            out[i] = np.searchsorted(last[i], own[i] + _ROUNDING - sums, "right").sum()
        return out


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, orthonormal."""
    n, size = x.shape
    width = 1
    while width < size:
        x = x.reshape(n, size // (2 * width), 2, width)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(n, size)
        width *= 2
    return x / math.sqrt(size)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a batch, those of one dimension together."""
    column = batch.column("embedding")
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    firsts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield ids[at].astype(np.int64), flat[firsts[at][:, None] + np.arange(size)]


def valid_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Vectors that take part, as ``vec_id, embedding``."""
    value = F.col(embedding).cast("array<double>")
    usable = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), value.alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return usable.where(F.col("vec_id").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0))


def _few_copies(vectors: DataFrame, most: int) -> DataFrame:
    """Of equal vectors those with the ``most`` smallest ids.

    ``most - 1`` neighbours and the query itself cannot hold more of them, as all
    score the same. Spark limits the rows of a vector before it deals them out,
    so many copies of one vector do not meet in one task.
    """
    vectors = vectors.distinct()
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    return vectors.withColumn("nth", rank).where(F.col("nth") <= most).drop("nth")


def _packed(settings: Settings, length: int, probes: int | None):
    """Packs of a task: by their own bucket, or with ``probes`` by all buckets a query looks into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for ids, vectors in _matrices(batch):
                unit, dim = _unit(vectors), vectors.shape[1]
                axes = 2 * Rotations(dim, 1, 0, settings.seed).size
                looks = 1 if probes is None else min(probes, axes**length)
                step = max(1, _BLOCK // (looks * max(dim, axes if length > 1 else 1)))
                for table, a in product(range(settings.tables), range(0, len(ids), step)):
                    turns, some = Rotations(dim, length, table, settings.seed), unit[a : a + step]
                    buckets = turns.bucket(some)[:, None] if probes is None else turns.probes(some, probes)
                    row = np.repeat(np.arange(a, a + len(some)), buckets.shape[1])
                    flat = buckets.ravel()
                    order = np.argsort(flat, kind="stable")
                    cuts = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) != 0, [True]]))
                    packs = [row[order[i:j]] for i, j in pairwise(cuts)]
                    n = len(packs)
                    yield pa.record_batch(
                        [pa.array([table] * n, pa.int32()), pa.array([dim] * n, pa.int32()), pa.array(flat[order][cuts[:-1]], pa.int64()), pa.array([ids[p].tobytes() for p in packs], pa.binary()), pa.array([vectors[p].tobytes() for p in packs], pa.binary())],
                        ["tab", "dim", "bucket", "ids", "vectors"],
                    )

    return run


def _pair_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine of pairs of rows, the same for the same two vectors wherever they stand."""
    top = (queries * vectors).sum(1)
    return top / (np.sqrt((queries * queries).sum(1)) * np.sqrt((vectors * vectors).sum(1)))


def _nearest(k: int):
    """Best pairs of the packs a task sees: ``k`` for each query."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def pruned(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, v, s = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((-s, v, q))
        q, v, s = q[order], v[order], s[order]
        once = np.concatenate([[True], (q[1:] != q[:-1]) | (v[1:] != v[:-1])])
        q, v, s = q[once], v[once], s[once]
        order = np.lexsort((v, -s, q))
        q, v, s = q[order], v[order], s[order]
        start = np.maximum.accumulate(np.where(np.concatenate([[True], q[1:] != q[:-1]]), np.arange(len(q)), 0))
        best = np.arange(len(q)) - start < k
        return q[best], v[best], s[best]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held, least = [], 0, 1 << 18
        for batch in batches:
            for dim, q_ids, q_vectors, ids, vectors in zip(*(batch.column(c).to_pylist() for c in ("dim", "q_ids", "q_vectors", "ids", "vectors")), strict=True):
                q_ids, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
                q_vectors, vectors = np.frombuffer(q_vectors).reshape(-1, dim), np.frombuffer(vectors).reshape(-1, dim)
                order = np.argsort(ids, kind="stable")
                ids, vectors = ids[order], vectors[order]
                unit_q, unit_v = _unit(q_vectors), _unit(vectors)
                # An id may have several vectors; its best one counts.
                own = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
                step, piece = max(1, (1 << 20) // max(1, len(ids))), max(1, (1 << 22) // dim)
                for a in range(0, len(q_ids), step):
                    near = unit_q[a : a + step] @ unit_v.T
                    near[q_ids[a : a + step, None] == ids[None, :]] = -np.inf
                    best = near if len(own) == len(ids) else np.maximum.reduceat(near, own, 1)
                    kth = -np.partition(-best, k - 1, 1)[:, k - 1] if k < best.shape[1] else np.full(len(best), -np.inf)
                    # All that may be among the best but for rounding, however many tie.
                    row, col = np.nonzero((near >= kth[:, None] - _ROUNDING) & (near > -np.inf))
                    row += a
                    for b in range(0, len(row), piece):
                        i, j = row[b : b + piece], col[b : b + piece]
                        found.append((q_ids[i], ids[j], _pair_scores(q_vectors[i], vectors[j])))
                        held += len(i)
                        if held > least:
                            found = [pruned(found)]
                            held = len(found[0][0])
                            least = max(least, 2 * held)
        if found:
            q, v, s = pruned(found)
            for a in range(0, len(q), 100_000):
                yield pa.record_batch([pa.array(x[a : a + 100_000]) for x in (q, v, s)], schema=schema)

    return run


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best different neighbours of each query."""
    pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def exact_nearest(vectors: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """True neighbours of a bounded list of queries among all valid vectors, in blocks."""
    shared = vectors.sparkSession.sparkContext.broadcast(queries)
    best = _nearest(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packs():
            for batch in batches:
                for ids, rows in _matrices(batch) if batch.num_rows else ():
                    own = [(i, q) for i, q in shared.value if len(q) == rows.shape[1]]
                    if own:
                        q_ids, q = np.array([i for i, _ in own], np.int64), np.array([x for _, x in own])
                        yield pa.record_batch([pa.array([rows.shape[1]]), pa.array([q_ids.tobytes()]), pa.array([q.tobytes()]), pa.array([ids.tobytes()]), pa.array([rows.tobytes()])], ["dim", "q_ids", "q_vectors", "ids", "vectors"])

        yield from best(packs())

    return _ranked(vectors.mapInArrow(run, "query_id long, vec_id long, score double"), k)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _unit_column(vector: str) -> Column:
    """A vector that is not zero, with length 1; scaled first, as squares may be too small or large for a double."""
    scale = F.array_max(F.transform(vector, lambda a: F.abs(a.cast("double"))))
    scaled = F.transform(vector, lambda a: a.cast("double") / scale)
    length = F.sqrt(_sum(F.transform(scaled, lambda a: a * a)))
    return F.transform(scaled, lambda a: a / length)


def _chosen(vectors: DataFrame, queries: DataFrame, length: int, k: int, settings: Settings) -> tuple[int, int]:
    """Length of a bucket, and fewest probes that find the wished share of the true neighbours of a sample of queries.

    Probes are never cut off: a length that takes too many gives way to the next
    shorter one, and those of one axis may be all buckets.
    """
    position = F.xxhash64("vec_id", F.lit(5))
    sample = queries.orderBy(position, "vec_id").limit(settings.sample).toPandas()
    chosen = [(int(i), np.asarray(v, np.float64)) for i, v in zip(sample["vec_id"], sample["embedding"], strict=True)]
    if not chosen:
        return length, 1
    # An id may have any number of vectors: of each neighbour the one nearest to the query is taken.
    asked = queries.where(F.col("vec_id").isin([i for i, _ in chosen])).select(F.col("vec_id").alias("query_id"), _unit_column("embedding").alias("own"))
    met = exact_nearest(vectors, chosen, k).join(vectors, "vec_id").join(F.broadcast(asked), "query_id")
    cosine = _sum(F.zip_with("own", _unit_column("embedding"), lambda a, b: a * b))
    near = met.groupBy("query_id", "vec_id").agg(F.max_by("embedding", cosine).alias("embedding")).where("embedding IS NOT NULL").toPandas()
    own = dict(chosen)
    pairs = []
    for dim in sorted({len(v) for v in own.values()}):
        rows = [(q, np.asarray(v)) for q, v in zip(near["query_id"], near["embedding"], strict=True) if len(v) == dim == len(own[q])]
        if rows:
            pairs.append((dim, _unit(np.array([own[i] for i, _ in rows])), _unit(np.array([x for _, x in rows]))))
    if not pairs:
        return length, 1
    while True:
        places = [np.min([Rotations(dim, length, t, settings.seed).places(q, v) for t in range(settings.tables)], 0) for dim, q, v in pairs]
        ordered = np.sort(np.concatenate(places))
        probes = int(ordered[math.ceil(settings.recall * len(ordered)) - 1])
        if length == 1 or probes <= settings.long_probes:
            return length, probes
        length -= 1


def search(vectors: DataFrame, is_query: str = "vec_id % 50 = 0", k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """The ``k`` nearest found of each query: ``query_id, rank, vec_id, score``.

    Queries are the valid rows that satisfy ``is_query``; candidates are all
    valid rows with another id. A vector is valid if neither it nor its id is
    null, it has no null or non-finite component and it is not zero. Nearest
    first by exact cosine, ties to the smaller id; fewer than ``k`` if there are
    fewer candidates of its dimension in its buckets. Of rows that share an id,
    equal vectors count once, a neighbour with several vectors has its best
    score, and a query is the smallest of its vectors. Other columns are not
    read; an empty table gives an empty result.

    The length of a bucket grows with the logarithm of the rows, so that buckets
    stay near ``bucket_rows`` rows, as long as few enough probes reach the wished
    recall. Both are chosen by the recall measured against brute force on a
    bounded sample of queries; on it the chosen probes always reach the wished one.
    """
    with scratch(vectors.sparkSession):
        usable = valid_vectors(vectors, vec_id, embedding)
        candidates = stage(_few_copies(usable, k + 1), "vectors")
        # Few copies of a vector are kept as neighbours, but every row may be a query.
        queries = stage(usable.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
        rows = candidates.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("d")).first()
        axes = 2 << max(1, math.ceil(math.log2(max(2, rows.d or 2))))
        length = max(1, math.ceil(math.log(max(1, rows.n / settings.bucket_rows)) / math.log(axes)))
        length, probes = (length, settings.probes) if settings.probes else _chosen(candidates, queries, length, k, settings)
        found = stage(_looked_up(candidates, queries, length, probes, k, settings), "nearest")
        enough = found.groupBy("query_id").count().where(F.col("count") >= k)
        short = queries.join(enough, queries["vec_id"] == enough["query_id"], "left_anti")
        if not short.isEmpty():
            # One table, all its buckets: every candidate is met once.
            whole = _looked_up(candidates, short, length, axes**length, k, replace(settings, tables=1))
            found = found.join(short, found["query_id"] == short["vec_id"], "left_anti").unionByName(whole)
        return stage(found, "nearest", keep=True)


def _looked_up(candidates: DataFrame, queries: DataFrame, length: int, probes: int, k: int, settings: Settings) -> DataFrame:
    packs = candidates.mapInArrow(_packed(settings, length, None), _PACK)
    looks = queries.mapInArrow(_packed(settings, length, probes), _PACK)
    looks = looks.withColumnRenamed("ids", "q_ids").withColumnRenamed("vectors", "q_vectors")
    met = packs.join(looks, _KEY).select("dim", "q_ids", "q_vectors", "ids", "vectors")
    return _ranked(met.mapInArrow(_nearest(k), "query_id long, vec_id long, score double"), k)
