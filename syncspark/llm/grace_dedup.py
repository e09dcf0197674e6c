"""Exact deduplication by recursive hash partitioning (Grace hash).

Rows are first combined where they are read, so that a text held by a third of
all rows leaves each task once. The remaining texts are dealt by hash, and each
task puts its share into an open-addressing table that compares whole texts. A
share that does not fit is spilled to files by further digits of the hash, and
each file is treated the same way. Texts already in the table absorb their
copies without being spilled.

Spill files belong to the running task alone and end with it, like the spill
of a shuffle: a task that is run again writes its own.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from syncspark.llm.text import blocks, utf8
from syncspark.workspace import scratch, stage

TABLE_BYTES = 48 << 20
FAN_OUT = 16
_LAST_ID = (1 << 63) - 1


class TextTable:
    """Open-addressing table with linear probing from a text to its entry."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.bytes = 0

    def _slot(self, h: int, text: bytes) -> int:
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.texts[entry] == text:
                return at
            at = (at + 1) & mask
        return at

    def find(self, h: int, text: bytes) -> int:
        return self.slots[self._slot(h, text)]

    def add(self, h: int, text: bytes) -> int:
        """Entry of a text, made if it is new."""
        at = self._slot(h, text)
        if self.slots[at] >= 0:
            return self.slots[at]
        entry = self.slots[at] = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.bytes += len(text) + 200
        if 2 * len(self.texts) > len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of white space (``[\\x20\\x09-\\x0D]+``) of each text as one space."""
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    starts = offsets[:-1]
    keep[starts[starts < len(data)]] = True
    kept = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return np.where(blank, np.uint8(0x20), data)[keep], kept[offsets]


def grace_groups(
    records: Iterator[tuple[int, bytes, tuple[int, int, int], int, int]], budget: int = TABLE_BYTES, level: int = 0
) -> Iterator[tuple[bytes, tuple[int, int, int], int, list[int]]]:
    """Groups of equal texts among ``(hash, text, first row, rows, key)`` records.

    Gives ``(text, smallest first row, sum of rows, all keys)``. The table takes
    new texts up to ``budget`` bytes; other new texts go to one of ``FAN_OUT``
    spill files by the next digit of their hash.
    """
    table, firsts, sizes, keys = TextTable(), [], [], []
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        spills: dict[int, pickle.Pickler] = {}
        files = {}
        for record in records:
            h, text, first, rows, key = record
            entry = table.find(h, text)
            if entry < 0 and table.bytes > budget and level < 60:
                digit = (h >> (60 - level)) % FAN_OUT
                if digit not in spills:
                    files[digit] = open(f"{folder}/{digit}", "wb")  # noqa: SIM115
                    spills[digit] = pickle.Pickler(files[digit], pickle.HIGHEST_PROTOCOL)
                    spills[digit].fast = True
                spills[digit].dump(record)
                continue
            if entry < 0:
                table.add(h, text)
                firsts.append(first)
                sizes.append(rows)
                keys.append([key])
            else:
                firsts[entry] = min(firsts[entry], first)
                sizes[entry] += rows
                keys[entry].append(key)
        yield from zip(table.texts, firsts, sizes, keys, strict=True)
        del table, firsts, sizes, keys, spills
        for digit, file in files.items():
            file.close()
            with open(f"{folder}/{digit}", "rb") as spilled:
                yield from grace_groups(_unpickled(spilled), budget, level + 4)


def _unpickled(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _rows_schema() -> pa.Schema:
    return pa.schema([("doc_id", pa.int64()), ("task", pa.int64()), ("row", pa.int64()), ("raw", pa.int64()), ("grp", pa.int64()), ("rows", pa.int64()), ("hash", pa.int64()), ("sha", pa.string()), ("text", pa.binary())])


def _combine(budget: int):
    """Rows of a task, each with the number of its text; the text goes with the first row only."""

    def emit(ids, raws, groups, table, task, base, at):
        rep, count = {}, {}
        for i, g in enumerate(groups):
            count[g] = count.get(g, 0) + 1
            r = rep.get(g)
            if r is None or ids[i] < ids[r]:
                rep[g] = i
        lead = {i: g for g, i in rep.items()}
        texts = [table.texts[lead[i]] if i in lead else None for i in range(len(ids))]
        sha = [None if t is None else hashlib.sha256(t).digest() for t in texts]
        columns = [
            [None if d == _LAST_ID else d for d in ids],
            [task] * len(ids),
            range(at, at + len(ids)),
            raws,
            [(task << 33) + base + g for g in groups],
            [None if t is None else count[lead[i]] for i, t in enumerate(texts)],
            [None if s is None else int.from_bytes(s[:8], "little", signed=True) for s in sha],
            [None if s is None else s.hex() for s in sha],
            texts,
        ]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _rows_schema(), strict=True)], schema=_rows_schema())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        table, ids, raws, groups, base, at = TextTable(), [], [], [], 0, 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            doc_ids, raw = batch.column("doc_id").to_pylist(), batch.column("raw").to_pylist()
            for a, b in blocks(offsets):
                text, cut = normalised(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                text = text.tobytes()
                for i in range(b - a):
                    piece = text[cut[i] : cut[i + 1]]
                    groups.append(table.add(hash(piece) & 0xFFFFFFFFFFFFFFFF, piece))
                    ids.append(_LAST_ID if doc_ids[a + i] is None else doc_ids[a + i])
                raws.extend(raw[a:b])
                if table.bytes > budget or len(ids) > 100_000:
                    yield emit(ids, raws, groups, table, task, base, at)
                    base, at = base + len(table.texts), at + len(ids)
                    table, ids, raws, groups = TextTable(), [], [], []
        if ids:
            yield emit(ids, raws, groups, table, task, base, at)

    return run


def _merge(budget: int):
    """Groups of a share of the texts: each local number with the row that stays."""
    schema = pa.schema([("grp", pa.int64()), ("keep_id", pa.int64()), ("keep_task", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64()), ("text_sha256", pa.string())])

    def records(batches):
        for batch in batches:
            c = batch.to_pydict()
            for d, task, row, grp, rows, h, text in zip(*(c[n] for n in ("doc_id", "task", "row", "grp", "rows", "hash", "text")), strict=True):
                yield h & 0xFFFFFFFFFFFFFFFF, text, (_LAST_ID if d is None else d, task, row), rows, grp

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for text, (d, task, row), rows, keys in grace_groups(records(batches), budget):
            sha = hashlib.sha256(text).hexdigest()
            out.extend((k, None if d == _LAST_ID else d, task, row, rows, sha) for k in keys)
            if len(out) >= 10_000:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256, raw``.

    Texts are equal when they are identical after each run of white space is
    replaced by one space; null is an empty text, and all empty texts are equal.
    Of equal texts the row with the smallest ``doc_id`` stays (null comes last);
    of repeated rows that tie, exactly one stays. ``raw`` is the
    ``xxhash64`` of the text as it came. Other columns are not read. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    with scratch(spark):
        source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        source = source.withColumn("raw", F.xxhash64("text"))
        rows = stage(
            source.mapInArrow(_combine(table_bytes), "doc_id long, task long, row long, raw long, grp long, rows long, hash long, sha string, text binary"),
            "exact-rows",
        )
        share = rows.where(F.col("text").isNotNull()).select("doc_id", "task", "row", "grp", "rows", "hash", "text")
        groups = share.repartition("hash").mapInArrow(
            _merge(table_bytes), "grp long, keep_id long, keep_task long, keep_row long, group_size long, text_sha256 string"
        )
        found = rows.select("doc_id", "task", "row", "raw", "grp").join(groups, "grp")
        kept = (F.col("task") == F.col("keep_task")) & (F.col("row") == F.col("keep_row"))
        return stage(
            found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "raw"),
            "exact-result",
            keep=True,
        )

