"""Exact Jaccard join of word n-gram sets, light sets apart from heavy ones.

Two sets of given sizes link when they share some number of elements. Light
(small) sets list all their subsets of that number: two that list the same
subset are linked, nothing needs to be confirmed. The lists grow fast with the
size, so heavy (large) sets are found by scanning inverted lists instead. The
boundary is the size up to which listing subsets is the cheaper way, by the
measured length of the lists.

Which lists: in any one order of all elements, two linked sets share one of
their first few. Elements with a hash below a limit come first, the rarest of
them first; how often each occurs is counted over all sets. A set whose first
elements all occur nowhere else is linked with nothing. The others form
clusters by the lists they share, and a cluster's lists are scanned in one
task. A cluster too large for that is first joined in overlapping stretches of
some orders; then sets of different components meet wherever they share a list.

Links are used for components only, so a set is not compared with sets it is
already connected with, and the lists lose the sets that have been reached.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from syncspark.llm.components import connected_components
from syncspark.llm.text import blocks, ranges, scramble, shingle_sets, utf8
from syncspark.operators.sequence import assign_sequence
from syncspark.workspace import scratch, stage

# Broadcast bits that hold back texts which cannot be needed: at most 2**17 words of 64 bits.
_BITS = 1 << 23
# Elements that are counted but not among those below the hash limit come last.
_LATER = 1 << 62
_MOST = np.iinfo(np.uint64).max
_DOCS = "array<struct<doc_id:long,raw:long,n:long,set_key:binary>>"


@dataclass(frozen=True)
class Settings:
    """A link: ``100 * intersection >= percent * union`` of sets of ``words``-word shingles.

    Elements in the lowest ``share`` of hashes are counted. ``chunk`` elements of
    texts travel together, ``bucket`` elements are counted in one task, and the
    sets of ``cluster`` elements are joined in one; larger clusters along
    ``orders`` orders first. Sets above ``lightest`` elements are always heavy.
    """

    percent: int = 80
    words: int = 5
    share: float = 0.3
    chunk: int = 1_000_000
    bucket: int = 4_000_000
    cluster: int = 1_000_000
    orders: int = 3
    lightest: int = 24
    boundary: int | None = None

    def needed(self, a: int, b: int) -> int:
        """Elements that linked sets of these sizes share at least."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def first(self, n: np.ndarray) -> np.ndarray:
        """Elements of a set that include one of every linked set's first ones."""
        return n - (self.percent * n + 99) // 100 + 1

    def partners(self, n: int) -> range:
        """Sizes of sets that a set of ``n`` elements may link with."""
        return range(-(-self.percent * n // 100), 100 * n // self.percent + 1)

    def subsets(self, n: int) -> int:
        """Subsets that a light set of ``n`` elements lists."""
        return sum(comb(n, self.needed(n, m)) for m in self.partners(n))


def set_key(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def _sets(batch: pa.RecordBatch, settings: Settings) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and sets of blocks of a batch."""
    data, offsets = utf8(batch.column("text"))
    for a, b in blocks(offsets):
        yield a, shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], settings.words)


def _chunks(settings: Settings):
    """Chunks of a task: its documents, and the first elements of its different sets."""
    limit = np.uint64(int(settings.share * (1 << 64)))

    def chunk(number: int, docs: list, sets: dict[bytes, tuple[int, np.ndarray]]) -> pa.RecordBatch:
        tokens = [t for _, t in sets.values()]
        flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        sizes = np.array([n for n, _ in sets.values()], np.int64)
        counts = np.array([len(t) for t in tokens], np.int64)
        return pa.record_batch(
            [
                pa.array([number], pa.int64()),
                pa.array([docs], pa.list_(pa.struct([("doc_id", pa.int64()), ("raw", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary())]))),
                pa.array([len(flat)], pa.int64()),
                *(pa.array([x], pa.binary()) for x in (b"".join(sets), sizes.tobytes(), counts.tobytes(), flat.tobytes())),
            ],
            ["chunk", "docs", "elements", "keys", "sizes", "counts", "tokens"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, docs, sets, held = TaskContext.get().partitionId() << 33, [], {}, 0
        for batch in batches:
            ids, raws = batch.column("doc_id").to_pylist(), batch.column("raw").to_pylist()
            for a, found in _sets(batch, settings):
                for i, s in enumerate(found, a):
                    key = set_key(s) if len(s) else None
                    docs.append({"doc_id": ids[i], "raw": raws[i], "n": len(s), "set_key": key})
                    if key and key not in sets:
                        least = max(int(np.searchsorted(s, limit)), int(settings.first(len(s))))
                        # A copy, so that the rest of a large set can go.
                        sets[key] = len(s), s[:least].copy()
                        held += least
                if held > settings.chunk:
                    yield chunk(number, docs, sets)
                    number, docs, sets, held = number + 1, [], {}, 0
        if docs:
            yield chunk(number, docs, sets)

    return run


def _array(raw: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(raw, kind)


def _dealt(n_buckets: int):
    """Elements of a chunk by ranges of their hashes, with the number of sets that have them (255 stands for more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, raw in zip(batch.column("chunk").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                token, count = np.unique(_array(raw, np.uint64), return_counts=True)
                # The first elements are the lowest hashes: spread them again.
                bucket = (scramble(token) % np.uint64(n_buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                token, count = token[order], np.minimum(count[order], 255).astype(np.uint8)
                found, cuts = np.unique(bucket[order], return_index=True)
                ends = [*cuts[1:].tolist(), len(token)]
                pieces = list(zip(cuts.tolist(), ends, strict=True))
                yield pa.record_batch(
                    [
                        pa.array(found, pa.int64()),
                        pa.array([chunk] * len(found), pa.int64()),
                        pa.array([token[a:b].tobytes() for a, b in pieces], pa.binary()),
                        pa.array([count[a:b].tobytes() for a, b in pieces], pa.binary()),
                    ],
                    ["bucket", "chunk", "tokens", "times"],
                )

    return run


def _answered(table: pa.Table) -> pa.Table:
    """For each chunk of a bucket, its elements that occur more than once, and how often."""
    chunks, raw, times = (table.column(c).to_pylist() for c in ("chunk", "tokens", "times"))
    sizes = [len(x) // 8 for x in raw]
    token, count = _array(b"".join(raw), np.uint64), _array(b"".join(times), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(chunks)), sizes)
    _, which = np.unique(token, return_inverse=True)
    total = np.bincount(which, count).astype(np.int64)[which]
    again = total > 1
    token, total, owner = token[again], total[again], owner[again]
    cuts = np.searchsorted(owner, np.arange(len(chunks) + 1)).tolist()
    some = [i for i in range(len(chunks)) if cuts[i + 1] > cuts[i]]
    return pa.table(
        {
            "chunk": pa.array([chunks[i] for i in some], pa.int64()),
            "tokens": pa.array([token[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
            "times": pa.array([total[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
        }
    )


def _first_elements(settings: Settings):
    """``set_key, n, token`` of the first elements of each set, without those that occur nowhere else."""
    limit = np.uint64(int(settings.share * (1 << 64)))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, sizes, tokens = [], [], []
        token = _array(b"".join(right.column("tokens").to_pylist()), np.uint64)
        times = _array(b"".join(right.column("times").to_pylist()))
        order = np.argsort(token)
        token, times = token[order], times[order]
        for raw_keys, raw_sizes, raw_counts, raw_tokens in zip(*(left.column(c).to_pylist() for c in ("keys", "sizes", "counts", "tokens")), strict=True):
            size, counts, own = _array(raw_sizes), _array(raw_counts), _array(raw_tokens, np.uint64)
            owner = np.repeat(np.arange(len(size)), counts)
            often = np.ones(len(own), np.int64)
            if len(token):
                at = np.minimum(np.searchsorted(token, own), len(token) - 1)
                often[token[at] == own] = times[at[token[at] == own]]
            # Elements above the limit are in the order of their hashes, however often they are seen.
            rank = np.where(own < limit, often, _LATER)
            order = np.lexsort((own, rank, owner))
            place = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
            taken = order[place < settings.first(size)[owner]]
            taken = taken[often[taken] > 1]
            keys.extend(raw_keys[16 * i : 16 * i + 16] for i in owner[taken].tolist())
            sizes.append(size[owner[taken]])
            tokens.append(own[taken].view(np.int64))
        flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.table({"set_key": pa.array(keys, pa.binary()), "n": pa.array(flat(sizes), pa.int64()), "token": pa.array(flat(tokens), pa.int64())})

    return run


def _boundary(lists: DataFrame, settings: Settings) -> int:
    """Size up to which a set lists fewer subsets than scanning its elements' lists would read.

    A list is read about once, however long it is, as sets that have been reached
    leave it: a set pays for the mean length of a list, for each of its elements.
    """
    if settings.boundary is not None:
        return settings.boundary
    length = lists.groupBy("token").count().agg(F.avg("count")).first()[0] or 1.0
    return max((n for n in range(1, settings.lightest + 1) if settings.subsets(n) <= n * length), default=0)


def subset_keys(elements: np.ndarray, settings: Settings, boundary: int) -> list[tuple[int, int, int]]:
    """For each size of a light partner the smaller and the larger size, and a hash of each subset both would share."""
    n, out = len(elements), []
    for m in settings.partners(n):
        if m < 1 or m > boundary:
            continue
        shared = settings.needed(n, m)
        if shared > min(n, m):
            continue
        places = np.array(list(combinations(range(n), shared)))
        # The elements are sorted, so equal subsets come in equal order.
        value = np.full(len(places), np.uint64(shared))
        for column in places.T:
            value = scramble(value + elements[column]) * np.uint64(0x9DDFEA08EB382D69)
        out.extend((min(n, m), max(n, m), v) for v in value.view(np.int64).tolist())
    return out


def _light(settings: Settings, boundary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, s in _of_texts(batches, settings, "set_key"):
            rows = subset_keys(s, settings, boundary)
            small, large, value = ([r[i] for r in rows] for i in range(3))
            yield pa.record_batch(
                [pa.array(small, pa.int32()), pa.array(large, pa.int32()), pa.array(value, pa.int64()), pa.array([key] * len(rows), pa.binary()), pa.array([len(s)] * len(rows), pa.int32())],
                ["small", "large", "subset", "set_key", "n"],
            )

    return run


def _light_links(texts: DataFrame, settings: Settings, boundary: int) -> DataFrame:
    """Links of light sets: a set of the smaller size is linked with all others that list its subset."""
    rows = stage(texts.mapInArrow(_light(settings, boundary), "small int, large int, subset long, set_key binary, n int"), "subsets")
    keys = ["small", "large", "subset"]
    centres = rows.where("n = small").groupBy(*keys).agg(F.min("set_key").alias("a"))
    return rows.join(stage(centres, "centres"), keys).select("a", F.col("set_key").alias("b")).where("a <> b").distinct()


def _candidates(lists: DataFrame, settings: Settings) -> DataFrame:
    """Edges that connect all sets which share a list and may link by their sizes, a few for each entry."""
    step = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / settings.percent))
    rows = lists.select("token", "set_key", step.alias("step"))
    centres = stage(rows.groupBy("token", "step").agg(F.min("set_key").alias("a")), "list-centres")
    of_list = rows.join(centres, ["token", "step"]).select("a", F.col("set_key").alias("b"))
    above = centres.select("token", (F.col("step") - 1).alias("step"), F.col("a").alias("b"))
    return of_list.union(centres.join(above, ["token", "step"]).select("a", "b")).where("a <> b").distinct()


def linked(sets: Sequence[np.ndarray], settings: Settings) -> list[tuple[int, int]]:
    """Links that connect all sets which links connect: from each set reached to those it reaches first.

    A set is compared with all unreached ones at once, by scanning the lists of
    its elements, if one of them shares one of its rarest elements.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    owner = np.repeat(np.arange(n), sizes)
    _, code, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often[code] > 1
    order = np.lexsort((often[code], owner))
    place = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rare = np.zeros(len(order), bool)
    rare[order] = place < settings.first(sizes)[owner[order]]
    code, owner, rare = code[shared], owner[shared], rare[shared]
    mine = np.searchsorted(owner, np.arange(n + 1))
    held, first = owner[np.argsort(code, kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(often)))])
    alive, left, size_then, out = np.ones(n, bool), n, n, []
    for start in range(n):
        if not alive[start]:
            continue
        alive[start] = False
        left -= 1
        front = [start]
        while front and left:
            if 2 * left < size_then:
                # The lists lose the sets that have been reached.
                stays = alive[held]
                first = np.concatenate([[0], np.cumsum(stays)])[first]
                held, size_then = held[stays], left
            x = front.pop()
            own, own_rare = code[mine[x] : mine[x + 1]], rare[mine[x] : mine[x + 1]]
            few = own[own_rare]
            if not alive[held[ranges(first[few], first[few + 1] - first[few])]].any():
                continue
            same = np.bincount(held[ranges(first[own], first[own + 1] - first[own])], minlength=n)
            near = np.flatnonzero(alive & (100 * same >= settings.percent * (sizes + sizes[x] - same))).tolist()
            out.extend((x, y) for y in near)
            alive[near] = False
            left -= len(near)
            front.extend(near)
    return out


def _of_texts(batches: Iterator[pa.RecordBatch], settings: Settings, *columns: str) -> Iterator[tuple]:
    """Some columns and the set of each row; rows whose text has another set than their key says are left out."""
    for batch in batches:
        keys = batch.column("set_key").to_pylist()
        values = [batch.column(c).to_pylist() for c in columns]
        for a, found in _sets(batch, settings):
            for i, s in enumerate(found, a):
                if len(s) and set_key(s) == keys[i]:
                    yield *(v[i] for v in values), s


def _unit_links(rows: Iterator[tuple], settings: Settings) -> Iterator[pa.RecordBatch]:
    """Links of rows ``(unit, set_key, set)`` sorted by unit."""
    a, b = [], []

    def join(unit: dict[bytes, np.ndarray]) -> None:
        keys = list(unit)
        for i, j in linked(list(unit.values()), settings) if len(keys) > 1 else ():
            a.append(keys[i])
            b.append(keys[j])

    def out() -> pa.RecordBatch:
        batch = pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
        a.clear()
        b.clear()
        return batch

    current, unit = None, {}
    for number, key, s in rows:
        if number != current:
            join(unit)
            current, unit = number, {}
            if len(a) > 50_000:
                yield out()
        unit[key] = s
    join(unit)
    yield out()


def _links_of_texts(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _unit_links(_of_texts(batches, settings, "unit", "set_key"), settings)

    return run


def _links_of_sets(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = (zip(*(batch.column(c).to_pylist() for c in ("unit", "set_key", "elements")), strict=True) for batch in batches)
        yield from _unit_links(((u, k, _array(s, np.uint64)) for rows in columns for u, k, s in rows), settings)

    return run


def _whole_sets(settings: Settings):
    """Elements of each set, and its least element in each of some orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, s in _of_texts(batches, settings, "set_key"):
            least = [int(scramble(s ^ np.uint64(0x51ED270B * (i + 1))).min().view(np.int64)) for i in range(settings.orders)]
            yield pa.record_batch([pa.array([key], pa.binary()), pa.array([s.tobytes()], pa.binary()), pa.array([least], pa.list_(pa.int64()))], ["set_key", "elements", "least"])

    return run


def _links_of_large(members: DataFrame, sets: DataFrame, lists: DataFrame, settings: Settings) -> DataFrame:
    """Links inside clusters (``members``: ``set_key, component, n``) too large for one task."""
    mean = members.agg(F.avg("n")).first()[0]
    stretch = max(2, int(settings.cluster / 2 / mean))

    def joined(rows: DataFrame) -> DataFrame:
        dealt = rows.join(sets.select("set_key", "elements"), "set_key").repartition("unit").sortWithinPartitions("unit")
        return stage(dealt.select("unit", "set_key", "elements").mapInArrow(_links_of_sets(settings), "a binary, b binary"), "unit-links")

    found = None
    ordered = stage(members.join(sets.select("set_key", "least"), "set_key"), "ordered")
    for i in range(settings.orders):
        placed = assign_sequence(ordered.select("component", F.col("least")[i].alias("ord"), "set_key"), ["component", "ord", "set_key"])
        place = F.col("seq") - 1
        units = F.explode(F.array(F.floor(place / stretch) * 2, F.floor((place + stretch // 2) / stretch) * 2 + 1))
        links = joined(placed.select("set_key", "component", units.alias("x")).select("set_key", F.xxhash64("component", "x").alias("unit")))
        found = links if found is None else found.unionByName(links)
    roots = connected_components(found).select(F.col("node").alias("set_key"), F.col("component").alias("root"))
    blocks_ = placed.select("set_key", "component", F.floor((F.col("seq") - 1) / stretch).alias("block")).join(roots, "set_key", "left")
    blocks_ = stage(blocks_.withColumn("root", F.coalesce("root", "set_key")), "blocks")
    largest = blocks_.groupBy("component", "root").count().groupBy("component").agg(F.max_by("root", F.struct("count", "root")).alias("largest"))
    outside = stage(blocks_.join(largest, "component").where("root <> largest").select("set_key", F.col("block").alias("own_block")), "outside")
    if outside.isEmpty():
        return found
    entries = stage(lists.select("token", "set_key").join(blocks_, "set_key"), "entries")
    targets = stage(entries.select("component", "token", "block", F.col("root").alias("of_root")).distinct(), "targets")
    seeking = entries.join(outside, "set_key").select("component", "token", "set_key", "own_block", "root")
    met = seeking.join(targets, ["component", "token"]).where("root <> of_root").select("component", "set_key", "own_block", "block").distinct()
    met = stage(met.withColumn("unit", F.xxhash64("component", "own_block", "block")), "met")
    units = met.select("component", "block", "unit").distinct()
    whole = blocks_.select("component", "block", "set_key").join(units, ["component", "block"]).select("set_key", "unit")
    return found.unionByName(joined(met.select("set_key", "unit").union(whole).distinct()))


def _slot() -> F.Column:
    return F.pmod(F.xxhash64("id", "raw"), F.lit(_BITS))


def _needed_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``texts`` joined with ``wanted`` on ``id, raw``; most other texts are held back where they are read."""
    words = wanted.select(_slot().alias("slot")).select(F.shiftright("slot", 6).alias("word"), F.expr("shiftleft(1L, CAST(slot & 63 AS INT))").alias("one"))
    words = stage(words.groupBy("word").agg(F.bit_or("one").alias("ones")), "bits")
    likely = texts.withColumn("slot", _slot()).withColumn("word", F.shiftright("slot", 6)).join(F.broadcast(words), "word")
    likely = likely.where(F.getbit("ones", F.col("slot").bitwiseAND(F.lit(63)).cast("int")) == 1)
    return likely.select("id", "raw", "text").join(wanted, ["id", "raw"])


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest ``doc_id`` reachable over links; a null id
    counts as largest, and a component without any id has a null one. No link is
    missed. Equal sets are linked and are searched once. Texts without words,
    empty and null ones are linked with nothing: they stay with their own id.
    Repeated rows give repeated rows; other columns are not read; an empty table
    gives an empty result. Elements are 64-bit hashes of words, equal sets those of one 128-bit key.
    """
    last = F.lit((1 << 63) - 1)
    with scratch(docs.sparkSession):
        source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("raw", F.xxhash64("text"))
        chunks = stage(source.mapInArrow(_chunks(settings), f"chunk long, docs {_DOCS}, elements long, keys binary, sizes binary, counts binary, tokens binary"), "chunks")
        rows = chunks.select(F.inline("docs"))
        total = chunks.agg(F.sum("elements")).first()[0] or 0
        n_buckets = max(1, -(-total // settings.bucket))
        dealt = chunks.select("chunk", "tokens").mapInArrow(_dealt(n_buckets), "bucket long, chunk long, tokens binary, times binary")
        answers = dealt.groupBy("bucket").applyInArrow(_answered, "chunk long, tokens binary, times binary")
        sets = chunks.select("chunk", "keys", "sizes", "counts", "tokens")
        first = answers.groupBy("chunk").cogroup(sets.groupBy("chunk")).applyInArrow(lambda right, left: _first_elements(settings)(left, right), "set_key binary, n long, token long")
        first = stage(first.distinct(), "first-elements")
        shared = stage(first.groupBy("token").count().where("count > 1").select("token"), "shared-elements")
        lists = stage(first.join(shared, "token"), "lists")
        boundary = _boundary(lists, settings)
        heavy = lists.where(100 * F.col("n") >= settings.percent * (boundary + 1))
        clusters = stage(connected_components(_candidates(heavy, settings)).withColumnRenamed("node", "set_key"), "clusters")
        known = rows.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min(F.struct(F.coalesce("doc_id", last).alias("id"), "raw")).alias("one"), F.any_value("n").alias("n"))
        known = stage(known.select("set_key", "one.id", "one.raw", "n"), "sets")
        members = clusters.join(known, "set_key")
        sizes = stage(members.groupBy("component").agg(F.sum("n").alias("total"), F.max("n").alias("largest")), "sizes")
        members = stage(members.join(sizes.where(F.col("largest") > boundary), "component"), "members")
        texts = source.select(F.coalesce("doc_id", last).alias("id"), "raw", "text")
        small = members.where(F.col("total") <= settings.cluster).select("id", "raw", "set_key", F.xxhash64("component").alias("unit"))
        together = _needed_texts(texts, small).select("unit", "set_key", "text").repartition("unit").sortWithinPartitions("unit")
        links = stage(together.mapInArrow(_links_of_texts(settings), "a binary, b binary"), "links")
        light = known.where(F.col("n") <= boundary).join(lists.select("set_key").distinct(), "set_key").select("id", "raw", "set_key")
        links = links.unionByName(_light_links(_needed_texts(texts, stage(light, "light")).select("set_key", "text"), settings, boundary))
        large = members.where(F.col("total") > settings.cluster).select("id", "raw", "set_key", "component", "n")
        if not large.isEmpty():
            whole = _needed_texts(texts, large.select("id", "raw", "set_key")).select("set_key", "text")
            whole = stage(whole.mapInArrow(_whole_sets(settings), "set_key binary, elements binary, least array<long>").dropDuplicates(["set_key"]), "whole-sets")
            links = links.unionByName(_links_of_large(large.select("set_key", "component", "n"), whole, heavy, settings))
        found = connected_components(links).select(F.col("node").alias("set_key"), F.col("component").alias("root"))
        named = stage(known.select("set_key", "id").join(found, "set_key", "left").withColumn("root", F.coalesce("root", "set_key")), "named")
        least = named.groupBy("root").agg(F.min("id").alias("least"))
        named = stage(named.join(least, "root").select("set_key", "least"), "named-sets")
        component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.when(F.col("least") != last, F.col("least")))
        result = rows.select("doc_id", "n", "set_key").join(named, "set_key", "left")
        return stage(result.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")), "joined", keep=True)
