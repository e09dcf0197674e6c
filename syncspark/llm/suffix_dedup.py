"""Removal of repeated passages with suffix arrays in buckets.

A byte goes if a ``WIDTH``-byte string over it also starts in a document with a
smaller id. Sorting all suffixes of a corpus together is out of reach, so each
suffix is brought next to those it may equal:

1. Every string of ``WIDTH`` bytes has an anchor, the least hash of the
   ``GRAM``-byte strings in it. Equal strings have equal anchors, at equal
   distances. Consecutive strings with one anchor form a run, cut in two where
   the anchor is ``_HALF`` bytes from the start: all strings of a part have about
   35 bytes in common, whose hash then stands for the anchor. Shorter ones are
   shared by chance more and more often as a corpus grows.
2. Anchors are dealt by hash, packed per chunk of documents. Those of one
   document only are settled: nothing repeats there.
3. The runs of all other anchors are dealt by anchor, equal runs of a chunk
   once. In a bucket the suffixes at the anchors and the reversed prefixes
   before them are ordered by deep-shallow sorting: multikey quicksort to a
   shallow depth, blind tries below it. Neighbours' common prefixes then say
   which strings are equal, and the smallest document of each is known.
4. The verdicts go back to the chunks, which remove the bytes.

An anchor whose records would fill a large part of a bucket is dealt otherwise:
its strings go one by one, by their own hash, equal strings of a chunk once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from syncspark.llm.text import Rolling, ranges, scramble, utf8
from syncspark.workspace import scratch, stage

WIDTH = 50
GRAM = 20
_STEPS = WIDTH - GRAM  # places of an anchor after the first
_HALF = _STEPS // 2
_LAST_ID = (1 << 63) - 1
_SEGMENT = 1 << 19


@dataclass(frozen=True)
class Settings:
    """``chunk`` bytes of text are handled at once, ``bucket`` bytes of text make a bucket.

    Strings are dealt singly where ``hot`` chunks share their anchor: that many
    records are about a quarter of what a bucket holds. It depends on the size of a
    bucket alone, not on that of the corpus.
    """

    chunk: int = 4 << 20
    bucket: int = 8 << 20
    hot: int = (8 << 20) // 400
    shallow: int = 3


def multikey_quicksort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by their words, and the ends of groups of equal rows.

    Three-way partition around a pivot, all open segments of one round at once;
    rows equal to the pivot go on with their next word.
    """
    n, depth_most = words.shape
    order = np.arange(n)
    start, size, depth = np.array([0]), np.array([n]), np.array([0])
    cuts = np.zeros(n + 1, bool)
    cuts[[0, n]] = True
    while True:
        open_ = (size > 1) & (depth < depth_most)
        start, size, depth = start[open_], size[open_], depth[open_]
        if not len(start):
            return order, np.flatnonzero(cuts)[1:]
        at = ranges(start, size)
        segment = np.repeat(np.arange(len(start)), size)
        rows = order[at]
        value = words[rows, depth[segment]]
        first = np.cumsum(size) - size
        a, b, c = value[first], value[first + size // 2], value[first + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[segment]
        less, more = value < pivot, value > pivot
        equal = ~(less | more)
        counts = np.stack([np.add.reduceat(x, first, dtype=np.int64) for x in (less, equal, more)], 1)
        begin = start[:, None] + np.cumsum(counts, 1) - counts
        target = np.empty(len(rows), np.int64)
        for k, part in enumerate((less, equal, more)):
            where = np.flatnonzero(part)
            own = segment[where]
            rank = np.arange(len(where)) - (np.cumsum(counts[:, k]) - counts[:, k])[own]
            target[where] = begin[own, k] + rank
        order[target] = rows
        # Closed parts of one kind stay apart from the next kind.
        start, size = begin.ravel(), counts.ravel()
        cuts[start[size > 0]] = True
        depth = (depth[:, None] + np.array([0, 1, 0])).ravel()


class BlindTrie:
    """Strings in order, told apart by their branching bytes alone.

    A node is ``[depth, {byte: child}]``, a leaf ``[string, members]``. A string is
    led down by the branching bytes, compared once with the leaf it arrives at,
    and hung where their first difference belongs.
    """

    def __init__(self, string: bytes, member: int):
        self.root: list = [string, [member]]

    def insert(self, string: bytes, member: int) -> None:
        node = self.root
        while type(node[1]) is dict:
            children = node[1]
            node = children.get(string[node[0]]) or next(iter(children.values()))
        other = node[0]
        if other == string:
            node[1].append(member)
            return
        differ = int.from_bytes(string, "big") ^ int.from_bytes(other, "big")
        depth = len(string) - (differ.bit_length() + 7) // 8
        parent, node = None, self.root
        while type(node[1]) is dict and node[0] < depth:
            parent, node = node, node[1][string[node[0]]]
        leaf = [string, [member]]
        if type(node[1]) is dict and node[0] == depth:
            node[1][string[depth]] = leaf
            return
        branch = [depth, {other[depth]: node, string[depth]: leaf}]
        if parent is None:
            self.root = branch
        else:
            parent[1][string[parent[0]]] = branch

    def members(self) -> Iterator[int]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if type(node[1]) is dict:
                stack.extend(child for _, child in sorted(node[1].items(), reverse=True))
            else:
                yield from node[1]


def deep_shallow_order(strings: np.ndarray, shallow: int) -> np.ndarray:
    """Order of strings of equal length (rows of bytes): ``shallow`` words of eight bytes by quicksort, the rest by tries."""
    n, width = strings.shape
    padded = np.zeros((n, 8 * shallow), np.uint8)
    head = min(width, 8 * shallow)
    padded[:, :head] = strings[:, :head]
    order, ends = multikey_quicksort(padded.view(">u8").astype(np.uint64).reshape(n, shallow))
    if head == width:
        return order
    starts = np.concatenate([[0], ends[:-1]])
    deep = np.ascontiguousarray(strings[order, head:])
    same = np.concatenate([[False], (deep[1:] == deep[:-1]).all(1)])
    flat, step = deep.tobytes(), width - head
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        if b - a == 1 or same[a + 1 : b].all():
            continue
        trie = BlindTrie(flat[a * step : (a + 1) * step], a)
        for i in range(a + 1, b):
            trie.insert(flat[i * step : (i + 1) * step], i)
        order[a:b] = order[list(trie.members())]
    return order


def _common_prefixes(strings: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each string with the one before it in order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 1 << 17):
        rows = strings[order[a - 1 : a + (1 << 17)]]
        differ = rows[1:] != rows[:-1]
        out[a : a + len(differ)] = np.where(differ.any(1), differ.argmax(1), strings.shape[1])
    return out


@dataclass(frozen=True)
class Runs:
    """Consecutive strings with one anchor: first and last start, anchor, document, hash of what they have in common."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    doc: np.ndarray
    hash: np.ndarray


def find_runs(data: np.ndarray, offsets: np.ndarray) -> Runs:
    """Runs of all strings of ``WIDTH`` bytes that lie in one document."""
    parts = []
    total = len(data)
    for a in range(0, max(0, total - WIDTH + 1), _SEGMENT):
        piece = data[a : min(total, a + _SEGMENT + WIDTH - 1)]
        rolling = Rolling(piece)
        hashes = rolling.windows(GRAM)
        key = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        least, reach = key, 1
        while 2 * reach <= _STEPS + 1:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        rest = _STEPS + 1 - reach
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        n = len(anchor)
        # Starts whose string would pass the end of their document.
        ends = offsets[1:] - a
        low = np.clip(np.maximum(ends - WIDTH + 1, offsets[:-1] - a), 0, n)
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, low, 1)
        np.add.at(step, np.clip(ends, 0, n), -1)
        valid = np.cumsum(step[:n]) == 0
        change = np.ones(n + 1, bool)
        change[1:n] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
        cut = np.flatnonzero(change)
        first, last = cut[:-1], cut[1:] - 1
        good = valid[first]
        first, last = first[good], last[good]
        at = anchor[first]
        doc = np.searchsorted(offsets, first + a, "right") - 1
        # Strings that begin at most _HALF bytes before the anchor, and the others.
        near, far = at - last <= _HALF, at - first > _HALF
        right = rolling.slices(at[near], at[near] + WIDTH - _HALF)
        left = rolling.slices(at[far] - _HALF - 1, at[far] + GRAM)
        parts.append((np.maximum(first, at - _HALF)[near] + a, last[near] + a, at[near] + a, doc[near], right))
        parts.append((first[far] + a, np.minimum(last, at - _HALF - 1)[far] + a, at[far] + a, doc[far], left))
    if not parts:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none.astype(np.uint64))
    return Runs(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _codes(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (high half) and tag (low half) of anchors."""
    mixed = scramble(hashes ^ np.uint64(0x5851F42D4C957F2D))
    return ((mixed >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (mixed & np.uint64(0xFFFFFFFF))


def _by_bucket(codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Bucket and range of each bucket in sorted codes."""
    bucket = (codes >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(codes) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield int(bucket[a]), a, b


class Chunk:
    """Some documents as they are staged: ids, offsets and compressed text."""

    def __init__(self, ids: bytes, offsets: bytes, text: bytes):
        self.ids = np.frombuffer(ids, "<i8")
        self.offsets = np.frombuffer(offsets, "<i8")
        self.data = np.frombuffer(zstandard.decompress(text, max(1, int(self.offsets[-1]))), np.uint8) if len(text) else np.zeros(0, np.uint8)
        self.runs = find_runs(self.data, self.offsets)

    def records(self, flags: dict[int, bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs that may repeat, as records dealt to buckets.

        Gives for each string group (run, or single string of a hot anchor) its
        start range and document row, and the record it belongs to; and for each
        record its code, a place that shows it, and its smallest document id.
        """
        runs = self.runs
        codes = _codes(runs.hash, buckets)
        known = np.unique(codes)
        shared, hot = np.zeros(len(known), bool), np.zeros(len(known), bool)
        for bucket, a, b in _by_bucket(known):
            if bucket in flags:
                bits = np.unpackbits(np.frombuffer(flags[bucket], np.uint8).reshape(2, -1), axis=1)[:, : b - a].astype(bool)
                shared[a:b], hot[a:b] = bits
        place = np.searchsorted(known, codes)
        # Also anchors of two documents of this chunk alone.
        low, high = np.full(len(known), _LAST_ID), np.zeros(len(known), np.int64) - 1 - _LAST_ID
        owner = self.ids[runs.doc]
        np.minimum.at(low, place, owner)
        np.maximum.at(high, place, owner)
        use = np.flatnonzero((shared | (low < high))[place])
        single = hot[place[use]]
        first, last, anchor, doc, code = (x[use] for x in (runs.first, runs.last, runs.anchor, runs.doc, codes))
        # Hot anchors: every start on its own.
        times = np.where(single, last - first + 1, 1)
        index = np.repeat(np.arange(len(use)), times)
        offset = np.arange(len(index)) - np.repeat(np.cumsum(times) - times, times)
        alone = single[index]
        start = first[index] + offset
        stop = np.where(alone, start, last[index])
        anchor, doc, code = anchor[index], doc[index], code[index]
        if alone.any():
            whole = np.zeros(int(alone.sum()), np.uint64)
            where = np.flatnonzero(alone)
            for k in range(0, len(where), 1 << 17):
                rows = np.lib.stride_tricks.sliding_window_view(self.data, WIDTH)[start[where[k : k + (1 << 17)]]]
                whole[k : k + len(rows)] = _row_hash(rows)
            code[where] = _codes(whole, buckets)
        return start, stop, anchor, doc, code, self._windows(start, stop, anchor)

    def _windows(self, start: np.ndarray, stop: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Bytes around each anchor: up to ``_STEPS`` before it and ``WIDTH`` from it, zero outside the strings."""
        wide = _STEPS + WIDTH
        padded = np.zeros(len(self.data) + wide, np.uint8)
        padded[_STEPS : _STEPS + len(self.data)] = self.data
        out = np.empty((len(anchor), wide), np.uint8)
        view = np.lib.stride_tricks.sliding_window_view(padded, wide) if len(padded) >= wide else None
        for a in range(0, len(anchor), 1 << 16):
            at = slice(a, a + (1 << 16))
            rows = view[anchor[at]]
            out[at] = np.where(_inside(anchor[at] - start[at], stop[at] + WIDTH - anchor[at]), rows, 0)
        return out


def _inside(before: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """Which bytes of the windows belong to the records."""
    column = np.arange(_STEPS + WIDTH)
    return (column >= _STEPS - before.astype(np.int64)[:, None]) & (column < _STEPS + behind.astype(np.int64)[:, None])


def _row_hash(rows: np.ndarray) -> np.ndarray:
    """64-bit hash of rows of bytes."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    h = np.zeros(len(rows), np.uint64)
    for column in padded.view(np.uint64).T:
        h = scramble((h ^ column) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    return h


def _collapsed(chunk: Chunk, flags: dict[int, bytes], buckets: int) -> tuple:
    """Records of a chunk, equal ones once and sorted by bucket, with the record of each string group."""
    start, stop, anchor, doc, code, windows = chunk.records(flags, buckets)
    before, behind = (anchor - start).astype(np.uint8), (stop + WIDTH - anchor).astype(np.uint8)
    extent = np.stack([before, behind], 1)
    h = _row_hash(windows) ^ scramble(before.astype(np.uint64) << np.uint64(8) | behind)
    order = np.lexsort((h, code >> np.uint64(32)))
    new = np.ones(len(order), bool)
    if len(order):
        a, b = order[1:], order[:-1]
        equal = (h[a] == h[b]) & (code[a] == code[b]) & (extent[a] == extent[b]).all(1)
        same = np.flatnonzero(equal)
        equal[same] = (windows[a[same]] == windows[b[same]]).all(1)
        new[1:] = ~equal
    record = np.empty(len(order), np.int64)
    record[order] = np.cumsum(new) - 1
    shown = order[new]
    least = np.full(len(shown), _LAST_ID)
    np.minimum.at(least, record, chunk.ids[doc])
    return start, stop, anchor, doc, record, code[shown], windows[shown], before[shown], behind[shown], least


def _chunks(settings: Settings, rest: bool):
    """Rows of a task gathered to chunks; other columns travel along with ``rest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId() << 33, 0
        ids, sizes, texts, others, held = [], [], [], [], 0

        def full():
            size = np.concatenate(sizes)
            offsets = np.concatenate([[0], np.cumsum(size)]).astype("<i8")
            if others:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, others[0].schema) as writer:
                    for other in others:
                        writer.write_batch(other)
                extra = sink.getvalue().to_pybytes()
            else:
                extra = b""
            text = zstandard.compress(b"".join(texts), 6)
            return pa.record_batch([pa.array([task + number]), pa.array([held]), pa.array([np.concatenate(ids).astype("<i8").tobytes()]), pa.array([offsets.tobytes()]), pa.array([text]), pa.array([extra])], ["chunk", "n_bytes", "ids", "offsets", "text", "rest"])

        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            doc_ids = batch.column("doc_id").fill_null(_LAST_ID).to_numpy(zero_copy_only=False)
            first = 0
            while first < len(doc_ids):
                room = max(1, settings.chunk - held)
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + room, "right")) - 1)
                ids.append(doc_ids[first:last])
                sizes.append(np.diff(offsets[first : last + 1]))
                texts.append(data[offsets[first] : offsets[last]].tobytes())
                if rest:
                    others.append(batch.select([c for c in batch.schema.names if c not in ("doc_id", "text")]).slice(first, last - first))
                held += int(offsets[last] - offsets[first])
                first = last
                if held >= settings.chunk or sum(map(len, ids)) >= 50_000:
                    yield full()
                    number, ids, sizes, texts, others, held = number + 1, [], [], [], [], 0
        if ids:
            yield full()

    return run


def _anchors(buckets: int):
    """Tags of all anchors of a chunk, a sorted pack for each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids, offsets, text in zip(*(batch.column(c).to_pylist() for c in ("chunk", "ids", "offsets", "text")), strict=True):
                codes = np.unique(_codes(Chunk(ids, offsets, text).runs.hash, buckets))
                found = [(bucket, codes[a:b].astype(np.uint32).tobytes()) for bucket, a, b in _by_bucket(codes)]
                if found:
                    yield pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([number] * len(found), pa.int64()), pa.array([x for _, x in found], pa.binary())], ["bucket", "chunk", "tags"])

    return run


def _flag_bucket(hot: int):
    """For each chunk of a bucket, bits of the tags that other chunks have too, and of those that ``hot`` chunks have."""

    def run(table: pa.Table) -> pa.Table:
        packs = [np.frombuffer(x, np.uint32) for x in table.column("tags").to_pylist()]
        tags = np.sort(np.concatenate(packs))
        cuts = np.flatnonzero(np.concatenate([[True], tags[1:] != tags[:-1]]))
        times = np.diff(np.append(cuts, len(tags)))
        often, count = tags[cuts[times > 1]], times[times > 1]
        flags = []
        for pack in packs:
            at = np.searchsorted(often, pack)
            at[at == len(often)] = 0
            hit = often[at] == pack if len(often) else np.zeros(len(pack), bool)
            many = hit & (count[at] >= hot) if len(often) else hit
            flags.append(np.packbits(np.stack([hit, many]), axis=1).tobytes())
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "flags": pa.array(flags, pa.binary())})

    return run


def _listed(value: list) -> dict[int, bytes]:
    return {x["bucket"]: x["bits"] for x in value or ()}


def _dealt_records(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, ids, offsets, text, flags in zip(*(batch.column(c).to_pylist() for c in ("chunk", "ids", "offsets", "text", "flags")), strict=True):
                *_, code, windows, before, behind, least = _collapsed(Chunk(ids, offsets, text), _listed(flags), buckets)
                out = []
                for bucket, a, b in _by_bucket(code):
                    raw = b"".join(x.tobytes() for x in (least[a:b].astype("<i8"), before[a:b], behind[a:b], windows[a:b][_inside(before[a:b], behind[a:b])]))
                    out.append((bucket, b - a, zstandard.compress(raw, 6)))
                if out:
                    yield pa.record_batch([pa.array([x[0] for x in out], pa.int64()), pa.array([number] * len(out), pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.binary())], ["bucket", "chunk", "n", "records"])

    return run


def repeated_starts(windows: np.ndarray, before: np.ndarray, behind: np.ndarray, docs: np.ndarray, shallow: int) -> np.ndarray:
    """Bits of each record: bit ``o`` for the string that starts ``o`` bytes before the anchor, if a smaller document has it.

    ``windows`` holds the bytes around the anchors, ``before`` and ``behind`` how
    many of them belong to the record. The suffixes from the anchors and the
    reversed prefixes are ordered; strings are equal when both parts are.
    """
    right = np.ascontiguousarray(windows[:, _STEPS:])
    left = np.ascontiguousarray(windows[:, _STEPS - 1 :: -1])
    ranks = []
    for strings in (right, left):
        order = deep_shallow_order(strings, shallow)
        ranks.append((order, _common_prefixes(strings, order)))
    bits = np.zeros(len(docs), np.uint32)

    def classes(side: int, depth: int) -> np.ndarray:
        order, common = ranks[side]
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(common < depth)
        return out

    for o in range(_STEPS + 1):
        own = np.flatnonzero((before >= o) & (behind >= WIDTH - o))
        if len(own) < 2:
            continue
        key = (classes(1, o)[own] << 32) | classes(0, WIDTH - o)[own]
        order = np.argsort(key)
        key = key[order]
        cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        least = np.minimum.reduceat(docs[own[order]], cuts)
        sizes = np.diff(np.append(cuts, len(key)))
        rows = own[order]
        bits[rows[docs[rows] > np.repeat(least, sizes)]] |= np.uint32(1 << o)
    return bits


def _judged_bucket(shallow: int):
    def run(table: pa.Table) -> pa.Table:
        docs, before, behind, windows, sizes = [], [], [], [], table.column("n").to_pylist()
        for n, raw in zip(sizes, table.column("records").to_pylist(), strict=True):
            raw = zstandard.decompress(raw)
            docs.append(np.frombuffer(raw, "<i8", n))
            before.append(np.frombuffer(raw, np.uint8, n, 8 * n))
            behind.append(np.frombuffer(raw, np.uint8, n, 9 * n))
            window = np.zeros((n, _STEPS + WIDTH), np.uint8)
            window[_inside(before[-1], behind[-1])] = np.frombuffer(raw, np.uint8, -1, 10 * n)
            windows.append(window)
        bits = repeated_starts(*(np.concatenate(x) for x in (windows, before, behind, docs)), shallow)
        ends = np.cumsum(sizes).tolist()
        packs = [bits[b - n : b].astype("<u4").tobytes() for n, b in zip(sizes, ends, strict=True)]
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "bits": pa.array(packs, pa.binary())})

    return run


def removed_bytes(chunk: Chunk, flags: dict[int, bytes], verdicts: dict[int, bytes], buckets: int) -> np.ndarray:
    """Whether each byte of a chunk goes."""
    start, stop, anchor, doc, record, code, _, _, _, least = _collapsed(chunk, flags, buckets)
    bits = np.zeros(len(code), np.uint32)
    for bucket, a, b in _by_bucket(code):
        bits[a:b] = np.frombuffer(verdicts[bucket], "<u4")
    lengths = stop - start + 1
    starts = ranges(start, lengths)
    group = np.repeat(np.arange(len(start)), lengths)
    distance = (anchor[group] - starts).astype(np.uint32)
    # Of equal runs in a chunk only those of the smallest document need the verdict.
    later = (chunk.ids[doc] > least[record])[group]
    gone = starts[later | ((bits[record[group]] >> distance) & 1).astype(bool)]
    step = np.zeros(len(chunk.data) + 1, np.int32)
    np.add.at(step, gone, 1)
    np.add.at(step, gone + WIDTH, -1)
    return np.cumsum(step[:-1]) > 0


def _cleaned(buckets: int, names: list[str] | None):
    """What is left of each document: the columns ``names``, or without them a digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, offsets, text, extra, flags, verdicts in zip(*(batch.column(c).to_pylist() for c in ("ids", "offsets", "text", "rest", "flags", "verdicts")), strict=True):
                chunk = Chunk(ids, offsets, text)
                gone = removed_bytes(chunk, _listed(flags), _listed(verdicts), buckets)
                cut = chunk.offsets
                doc_ids = pa.array([None if i == _LAST_ID else i for i in chunk.ids.tolist()], pa.int64())
                pieces = [chunk.data[a:b][~gone[a:b]].tobytes() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                if names is not None:
                    columns = {"doc_id": doc_ids, "text": pa.array([p.decode("utf-8", "ignore") for p in pieces], pa.string())}
                    if extra:
                        others = pa.ipc.open_stream(extra).read_all()
                        columns |= {c: others.column(c).combine_chunks() for c in others.schema.names}
                    yield pa.record_batch([columns[c] for c in names], names)
                    continue
                edge = gone.copy()
                edge[1:] &= ~gone[:-1]
                # A removed stretch never goes on into the next document.
                inner = cut[:-1][cut[:-1] < len(gone)]
                edge[inner] = gone[inner]
                total, spans = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(edge)])
                yield pa.record_batch(
                    [doc_ids, pa.array(np.diff(cut)), pa.array(total[cut[1:]] - total[cut[:-1]], pa.int64()), pa.array(spans[cut[1:]] - spans[cut[:-1]], pa.int64()), pa.array([hashlib.sha256(p).hexdigest() for p in pieces], pa.string())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    return run


def _judged(docs: DataFrame, settings: Settings, rest: bool) -> tuple[DataFrame, int]:
    """Chunks with all that is known of their strings, and the number of buckets."""
    names = ", ".join(["chunk long", "n_bytes long", "ids binary", "offsets binary", "text binary", "rest binary"])
    chunks = stage(docs.mapInArrow(_chunks(settings, rest), names), "chunks")
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(1, -(-total // settings.bucket))
    light = chunks.select("chunk", "ids", "offsets", "text")
    tags = light.mapInArrow(_anchors(buckets), "bucket long, chunk long, tags binary")
    flags = tags.groupBy("bucket").applyInArrow(_flag_bucket(settings.hot), "chunk long, bucket long, flags binary")
    listed = lambda df, column, name: df.groupBy("chunk").agg(F.collect_list(F.struct("bucket", F.col(column).alias("bits"))).alias(name))
    flags = stage(listed(flags, "flags", "flags"), "flags")
    records = light.join(flags, "chunk", "left").select("chunk", "ids", "offsets", "text", "flags").mapInArrow(_dealt_records(buckets), "bucket long, chunk long, n long, records binary")
    verdicts = records.groupBy("bucket").applyInArrow(_judged_bucket(settings.shallow), "chunk long, bucket long, bits binary")
    verdicts = stage(listed(verdicts, "bits", "verdicts"), "verdicts")
    known = flags.join(verdicts, "chunk", "left")
    return chunks.join(known, "chunk", "left").select("ids", "offsets", "text", "rest", "flags", "verdicts"), buckets


def _source(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.coalesce(F.col("text").cast("string"), F.lit(""))})


def repeated_passages(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Each byte covered by a 50-byte string that also starts in a document with a
    smaller ``doc_id`` is removed; strings are judged on the input. Null texts
    count as empty. A null id counts as larger than all others; rows of one id,
    null or repeated, remove nothing from each other. Other columns are not
    read; an empty table gives an empty result.
    """
    with scratch(docs.sparkSession):
        judged, buckets = _judged(_source(docs.select("doc_id", "text")), settings, False)
        schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        return stage(judged.mapInArrow(_cleaned(buckets, None), schema), "passages", keep=True)


def without_repeated_passages(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with the remaining text of each row; bytes of a character cut in two go as well."""
    with scratch(docs.sparkSession):
        source = _source(docs)
        judged, buckets = _judged(source, settings, len(source.columns) > 2)
        return stage(judged.mapInArrow(_cleaned(buckets, source.columns), source.schema), "passages-cut", keep=True)
