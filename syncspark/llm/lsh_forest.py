"""Near-duplicate detection with an LSH forest over MinHash signatures.

A text becomes the set of its five-word shingles, a set a signature. The forest
holds several orders of the signatures, each sorted by its own part of the
hashes: sets with a common prefix lie side by side. Where few sets share the
first values, all of them are compared; where many do, each set meets its
neighbours of the longest common prefix, so the depth adapts to the region.

Candidates only decide which sets are looked at together. Links are confirmed on
full sets: all sets of a candidate cluster meet in one task, which joins them
exactly. A cluster too large for that is first joined in overlapping stretches
of some orders; what is then not in its largest component meets the whole cluster,
block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from syncspark.llm.components import connected_components
from syncspark.llm import text as texts_of
from syncspark.llm.text import blocks, utf8
from syncspark.operators.sequence import assign_sequence
from syncspark.workspace import scratch, stage

SHINGLE_WORDS = 5
# A link: 100 * intersection >= PERCENT * union.
PERCENT = 75


@dataclass(frozen=True)
class Settings:
    """A pair of similarity s shares ``depth`` values in one of ``trees`` orders with chance 1 - (1 - s**depth)**trees.

    ``values`` are the values of an order; ``region`` sets of a common prefix are
    compared at once; ``margin`` standard deviations below the threshold an
    estimate still makes a candidate; ``cluster`` shingles are joined in one task,
    larger clusters along ``orders`` of the orders first.
    """

    trees: int = 20
    depth: int = 3
    values: int = 6
    region: int = 2048
    margin: float = 4.0
    cluster: int = 3_000_000
    orders: int = 6
    seed: int = 23

    @property
    def least(self) -> float:
        s = PERCENT / 100
        return s - self.margin * (s * (1 - s) / (self.trees * self.values)) ** 0.5


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the different five-word shingles of each text."""
    return texts_of.shingle_sets(data, offsets, SHINGLE_WORDS)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(sets: Sequence[np.ndarray], settings: Settings) -> np.ndarray:
    """MinHash values of non-empty sets, a row for each."""
    random = np.random.default_rng(settings.seed)
    n = settings.trees * settings.values
    mask = random.integers(0, 1 << 32, n, dtype=np.uint32)
    factor = random.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    flat = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), n), np.uint32)
    for i in range(n):
        mixed = (flat ^ mask[i]) * factor[i]
        mixed ^= mixed >> np.uint32(15)
        out[:, i] = np.minimum.reduceat(mixed, starts) if len(sets) else 0
    return out


def _described(settings: Settings):
    """Size, key and signature of the set of each text; none of a set without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in blocks(offsets):
                sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                full = [i for i, s in enumerate(sets) if len(s)]
                signature = signatures([sets[i] for i in full], settings)
                keys, signs = [None] * len(sets), [None] * len(sets)
                for row, i in enumerate(full):
                    keys[i], signs[i] = set_key(sets[i]), signature[row].astype(">u4").tobytes()
                yield pa.record_batch(
                    [batch.column("doc_id")[a:b], batch.column("raw")[a:b], pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
                    ["doc_id", "raw", "n", "set_key", "signature"],
                )

    return run


def _ordered(settings: Settings):
    """A row of each order: the set's values in that order, and low bits of all values for estimates."""
    width = 4 * settings.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column("signature").to_pylist()
            values = np.frombuffer(b"".join(raw), ">u4").reshape(len(raw), -1)
            bits = (values & 15).astype(np.uint8)
            bits = (bits[:, 0::2] << 4) | bits[:, 1::2]
            packed = pa.array([x.tobytes() for x in bits], pa.binary())
            for tree in range(settings.trees):
                order = pa.array([x[tree * width : (tree + 1) * width] for x in raw], pa.binary())
                yield pa.record_batch([pa.array([tree] * len(raw), pa.int32()), order, batch.column("node"), packed], ["tree", "ord", "node", "bits"])

    return run


def estimates(bits: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Similarity of each row to one other, from four bits of each value."""
    different = bits ^ one
    same = ((different & 0xF0) == 0).sum(1) + ((different & 0x0F) == 0).sum(1)
    return (16 * same / (2 * bits.shape[1]) - 1) / 15


def spanning_pairs(bits: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs that connect all rows whose estimates connect them, one for each row reached."""
    out, left = [], np.arange(len(bits))
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            one = front.pop()
            near = estimates(bits[left], bits[one]) >= least
            found = left[near].tolist()
            out.extend((one, other) for other in found)
            front.extend(found)
            left = left[~near]
    return out


def _neighbours(settings: Settings):
    """Pairs that connect candidates, from rows sorted by tree and order."""
    prefix = 4 * settings.depth
    half = settings.region // 2

    def pairs_of(rows: list[tuple[int, bytes]]) -> list[tuple[int, int]]:
        nodes = [n for n, _ in rows]
        bits = np.frombuffer(b"".join(b for _, b in rows), np.uint8).reshape(len(rows), -1)
        return [(min(nodes[i], nodes[j]), max(nodes[i], nodes[j])) for i, j in spanning_pairs(bits, settings.least)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, done, out = None, [], 0, set()
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("tree", "ord", "node", "bits"))
            for tree, order, node, bits in zip(*columns, strict=True):
                key = tree, order[:prefix]
                if key != current:
                    if len(rows) - done > 0 and len(rows) > 1:
                        out.update(pairs_of(rows))
                    current, rows, done = key, [], 0
                rows.append((node, bits))
                if len(rows) == settings.region:
                    out.update(pairs_of(rows))
                    rows, done = rows[half:], settings.region - half
            if len(out) > 50_000:
                yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])
                out = set()
        if len(rows) - done > 0 and len(rows) > 1:
            out.update(pairs_of(rows))
        if out:
            yield pa.record_batch([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], ["a", "b"])

    return run


class _Union:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def _is_link(shared: int, a: int, b: int) -> bool:
    return 100 * shared >= PERCENT * (a + b - shared)


def linked(sets: Sequence[np.ndarray]) -> list[int]:
    """Component of each set under exact links, as the smallest place of its sets.

    Two linked sets share one of the rarest quarter of their shingles: sets are
    listed under those. Neighbours in the lists are compared first; what is then
    outside the largest component is compared with everything it shares a list with.
    """
    n = len(sets)
    if n == 1:
        return [0]
    if n == 2:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return [0, 0 if _is_link(shared, len(sets[0]), len(sets[1])) else 1]
    sizes = np.fromiter(map(len, sets), np.int64, n)
    owner = np.repeat(np.arange(n), sizes)
    _, shingle, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    count = often[shingle]
    start = np.cumsum(sizes) - sizes
    order = np.lexsort((shingle, count, owner))
    place = np.arange(len(order)) - np.repeat(start, sizes)
    prefix = sizes - (PERCENT * sizes + 99) // 100 + 1
    listed = order[(place < np.repeat(prefix, sizes)) & (count[order] > 1)]
    listed = listed[np.argsort(shingle[listed], kind="stable")]
    lists, members = shingle[listed], owner[listed]
    own = [shingle[a : a + s] for a, s in zip(start.tolist(), sizes.tolist(), strict=True)]
    union = _Union(n)
    beside = np.flatnonzero(lists[1:] == lists[:-1])
    pairs = np.unique(np.stack([members[beside], members[beside + 1]], 1), axis=0)
    fits = PERCENT * np.maximum(sizes[pairs[:, 0]], sizes[pairs[:, 1]]) <= 100 * np.minimum(sizes[pairs[:, 0]], sizes[pairs[:, 1]])
    for a, b in pairs[fits].tolist():
        if union.find(a) != union.find(b):
            shared = len(np.intersect1d(own[a], own[b], assume_unique=True))
            if _is_link(shared, len(own[a]), len(own[b])):
                union.join(a, b)
    roots = np.fromiter(map(union.find, range(n)), np.int64, n)
    largest = np.bincount(roots).argmax()
    outside = np.flatnonzero(roots != largest)
    if len(outside):
        list_cut = np.searchsorted(lists, np.arange(len(often) + 1))
        by_shingle = np.argsort(shingle, kind="stable")
        held = owner[by_shingle]
        cut = np.concatenate([[0], np.cumsum(often)])
        mine = np.zeros(len(order), bool)
        mine[listed] = True
        for x in outside.tolist():
            rare = own[x][mine[start[x] : start[x] + sizes[x]]]
            met = np.unique(np.concatenate([members[list_cut[s] : list_cut[s + 1]] for s in rare.tolist()])) if len(rare) else np.zeros(0, np.int64)
            home = union.find(x)
            if not any(union.find(y) != home for y in met.tolist()):
                continue
            shared = np.bincount(np.concatenate([held[cut[s] : cut[s + 1]] for s in own[x].tolist()]), minlength=n)
            for y in np.flatnonzero(100 * shared >= PERCENT * (sizes + sizes[x] - shared)).tolist():
                union.join(x, y)
    return [union.find(i) for i in range(n)]


def _joined(units: Iterator[tuple[object, list[int], list[np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    a, b = [], []
    for _, nodes, sets in units:
        for i, root in enumerate(linked(sets)):
            a.append(nodes[root])
            b.append(nodes[i])
        if len(a) > 50_000:
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            a, b = [], []
    if a:
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Unit, node and set of rows sorted by unit; rows whose text has another set are left out."""
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        units, nodes, keys = (batch.column(c).to_pylist() for c in ("unit", "node", "set_key"))
        for a, b in blocks(offsets):
            sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            for i, s in enumerate(sets, a):
                if set_key(s) == keys[i]:
                    yield units[i], nodes[i], s


def _units(rows: Iterator[tuple[object, int, np.ndarray]]) -> Iterator[tuple[object, list[int], list[np.ndarray]]]:
    current, nodes, sets, seen = None, [], [], set()
    for unit, node, s in rows:
        if unit != current:
            if len(nodes) > 0:
                yield current, nodes, sets
            current, nodes, sets, seen = unit, [], [], set()
        if node not in seen:
            seen.add(node)
            nodes.append(node)
            sets.append(s)
    if len(nodes) > 0:
        yield current, nodes, sets


def _links_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _joined(_units(_of_texts(batches)))


def _links_of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (
        (unit, node, np.frombuffer(s, np.uint64))
        for batch in batches
        for unit, node, s in zip(*(batch.column(c).to_pylist() for c in ("unit", "node", "shingles")), strict=True)
    )
    yield from _joined(_units(rows))


def _sets_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, node, s in _of_texts(batches):
        yield pa.record_batch([pa.array([node], pa.int64()), pa.array([s.tobytes()], pa.binary())], ["node", "shingles"])


def _links_of_large(members: DataFrame, shingles: DataFrame, settings: Settings) -> DataFrame:
    """Links inside clusters too large for one task.

    ``members``: ``node, component, n, signature``. First each of some orders is
    numbered over the whole cluster and joined in overlapping stretches of about
    half of ``settings.cluster`` shingles: nearly all sets that belong together
    find each other there. Those still outside the largest component of their
    cluster are then joined with the whole cluster, block by block.
    """
    mean = members.agg(F.avg("n")).first()[0]
    stretch = max(2, int(settings.cluster / 2 / mean))

    def joined(rows: DataFrame) -> DataFrame:
        dealt = rows.join(shingles, "node").repartition("unit").sortWithinPartitions("unit").select("unit", "node", "shingles")
        return stage(dealt.mapInArrow(_links_of_sets, "a long, b long").where("a <> b"), "unit-links")

    found, placed = None, None
    for tree in range(min(settings.orders, settings.trees)):
        order = F.substring("signature", 4 * settings.values * tree + 1, 4 * settings.values)
        placed = assign_sequence(members.select("component", order.alias("ord"), "node"), ["component", "ord", "node"])
        place = F.col("seq") - 1
        units = F.explode(F.array(F.floor(place / stretch) * 2, F.floor((place + stretch // 2) / stretch) * 2 + 1))
        links = joined(placed.select("node", "component", units.alias("x")).select("node", F.xxhash64("component", "x").alias("unit")))
        found = links if found is None else found.unionByName(links)
    roots = connected_components(found).withColumnRenamed("component", "root")
    block = F.floor((F.col("seq") - 1) / stretch).alias("block")
    blocks = placed.select("node", "component", block).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    blocks = stage(blocks, "blocks")
    counts = blocks.groupBy("component", "root").count()
    largest = counts.groupBy("component").agg(F.max_by("root", F.struct("count", "root")).alias("largest"))
    outside = stage(blocks.join(largest, "component").where("root <> largest").select("node", "component", "block"), "outside")
    if outside.isEmpty():
        return found
    whole = blocks.select("component", F.col("block").alias("of_all")).distinct()
    some = outside.select("component", F.col("block").alias("of_outside")).distinct()
    unit = F.xxhash64("component", "of_outside", "of_all").alias("unit")
    left = outside.withColumnRenamed("block", "of_outside").join(whole, "component").select("node", unit)
    right = blocks.withColumnRenamed("block", "of_all").join(some, "component").select("node", unit)
    return found.unionByName(joined(left.union(right).distinct()))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """:func:`near_groups` without ``group``: ``doc_id, n_shingles, component_id, kept, raw``."""
    return near_groups(docs, doc_id, text, settings).drop("group")


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept, raw, group``.

    ``component_id`` is the smallest ``doc_id`` reachable over links (null counts
    as largest), ``kept`` whether it is the row's own. Equal sets are linked and
    are searched once. Texts without words, empty and null ones are linked with
    nothing: they stay with their own id. Repeated rows share a component and,
    having one id, are kept or not together. ``raw`` is the ``xxhash64`` of the
    text as it came; ``group`` numbers the components, also those without an id,
    and is null for texts without words. Other columns are not read; an empty
    table gives an empty result.
    """
    last = F.lit((1 << 63) - 1)
    with scratch(docs.sparkSession):
        source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        source = source.withColumn("raw", F.xxhash64("text"))
        rows = stage(source.mapInArrow(_described(settings), "doc_id long, raw long, n long, set_key binary, signature binary"), "signatures")
        sets = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(
            F.min(F.struct(F.coalesce("doc_id", last).alias("id"), "raw")).alias("one"),
            F.any_value("n").alias("n"),
            F.any_value("signature").alias("signature"),
        )
        sets = stage(sets.select(F.monotonically_increasing_id().alias("node"), "set_key", "one.id", "one.raw", "n", "signature"), "sets")
        # A link between different sets needs three shingles in one of them and more in the other.
        orders = sets.where("n >= 3").select("node", "signature").mapInArrow(_ordered(settings), "tree int, ord binary, node long, bits binary")
        orders = orders.repartitionByRange("tree", "ord", "node").sortWithinPartitions("tree", "ord")
        pairs = stage(orders.mapInArrow(_neighbours(settings), "a long, b long").distinct(), "candidates")
        clusters = stage(connected_components(pairs), "clusters")
        members = clusters.join(sets, "node").select("node", "component", "set_key", "id", "raw", "n", "signature")
        sizes = clusters.join(sets.select("node", "n"), "node").groupBy("component").agg(F.sum("n").alias("total"))
        members = stage(members.join(sizes, "component"), "members")
        keyed = source.withColumn("id", F.coalesce("doc_id", last)).select("id", "raw", "text")
        in_one_task = members.where(F.col("total") <= settings.cluster)
        texts = keyed.join(in_one_task.select("id", "raw", "node", "set_key", F.col("component").alias("unit")), ["id", "raw"])
        texts = texts.select("unit", "node", "set_key", "text").repartition("unit").sortWithinPartitions("unit")
        links = stage(texts.mapInArrow(_links_of_texts, "a long, b long").where("a <> b"), "links")
        large = members.where(F.col("total") > settings.cluster).select("node", "component", "set_key", "id", "raw", "n", "signature")
        if not large.isEmpty():
            own = keyed.join(large.select("id", "raw", "node", "set_key"), ["id", "raw"]).select(F.lit(0).alias("unit"), "node", "set_key", "text")
            shingles = stage(own.mapInArrow(_sets_of_texts, "node long, shingles binary").dropDuplicates(["node"]), "shingles")
            links = links.unionByName(_links_of_large(large.select("node", "component", "n", "signature"), shingles, settings))
        groups = connected_components(links)
        named = sets.select("node", "set_key", "id").join(groups, "node", "left")
        named = stage(named.select("set_key", "id", F.coalesce("component", "node").alias("component")), "named")
        smallest = named.groupBy("component").agg(F.min("id").alias("least"))
        named = named.join(smallest, "component").select("set_key", "least", F.col("component").alias("group"))
        found = rows.select("doc_id", "raw", "n", "set_key").join(named, "set_key", "left")
        component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.when(F.col("least") != last, F.col("least")))
        return stage(
            found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "raw", "group"),
            "near-result",
            keep=True,
        )
