"""Token ids in files, compressed shard by shard with a pair grammar (Re-Pair).

Documents are ordered by id over the whole table, encoded, and cut into shards
of whole documents. In each shard the frequent pairs of neighbouring ids are
replaced by new symbols again and again; a shard holds the rules, the length
each symbol expands to, and the remaining symbols, so any stretch of ids can be
decoded without the rest.

Layout of a shard, little endian: ``RPG1``, then nine unsigned 64-bit numbers
(bytes per symbol, first new symbol, rules, symbols, ids, documents, marks,
symbols between marks, 0), then the arrays: rules (two symbols each), ids each rule expands to (32 bits),
symbols, ids of each document (64 bits), ids before each mark (64 bits).
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from syncspark.llm.bpe import _texts, vocabulary
from syncspark.llm.pretokens import PieceEncoder
from syncspark.llm.text import blocks, ranges, utf8
from syncspark.workspace import scratch, stage

SHARD_IDS = 1 << 20
ROUNDS = None
PAIRS_A_ROUND = 4096
LEAST_COUNT = 16
MARK_EVERY = 4096
END_ID = 0
_MAGIC = b"RPG1"
_HEAD = struct.Struct("<4s9Q")
_SHARD_BITS = 33


def _frequent_pairs(pairs: np.ndarray, most: int, least: int) -> np.ndarray:
    """The most frequent pairs, of those seen ``least`` times."""
    if not len(pairs):
        return pairs
    ordered = np.sort(pairs)
    cuts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.append(cuts, len(ordered)))
    often = np.flatnonzero(counts >= least)
    if len(often) > most:
        often = often[np.argpartition(-counts[often], most)[:most]]
    return ordered[cuts[often]]


def compress(ids: np.ndarray, first_new: int, rounds: int | None = ROUNDS, pairs_a_round: int = PAIRS_A_ROUND, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """Rules (pairs of symbols) and the remaining symbols of a sequence of ids below ``first_new``.

    Each round counts all pairs and replaces the frequent ones from the left;
    of overlapping occurrences every second one waits for a later round. Without
    ``rounds`` it ends when no pair is seen ``least`` times. Symbols have 16 bits
    while that suffices, else 32.
    """
    sequence = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    made = settled = 0
    while (rounds is None or len(rules) < rounds) and len(sequence) > 1:
        short = first_new + made <= 1 << 16
        pair, shift = (np.uint32, 16) if short else (np.uint64, 32)
        # After a round that took all frequent pairs, others have one of its symbols.
        new = sequence >= settled
        where = np.flatnonzero(new[:-1] | new[1:])
        pairs = (sequence[where].astype(pair) << pair(shift)) | sequence[where + 1].astype(pair)
        most = min(pairs_a_round, (1 << 32) - first_new - made)
        chosen = np.sort(_frequent_pairs(pairs, most, least))
        if not len(chosen):
            break
        if len(chosen) < most:
            settled = first_new + made
        # Pairs that share a slot are looked up.
        slots = np.full(1 << 16, -1, np.int32)
        slots[_slots(chosen)] = np.arange(len(chosen))
        found = slots[_slots(pairs)]
        likely = np.flatnonzero(found >= 0)
        found, pairs = found[likely], pairs[likely]
        other = np.flatnonzero(chosen[found] != pairs)
        found[other] = np.minimum(np.searchsorted(chosen, pairs[other]), len(chosen) - 1)
        same = chosen[found] == pairs
        at, found = where[likely[same]], found[same]
        fresh = np.concatenate([[True], at[1:] != at[:-1] + 1])
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        first = (np.arange(len(at)) - run_start) % 2 == 0
        at, found = at[first], found[first]
        # Pairs that only overlapped others get no rule.
        used = np.bincount(found, minlength=len(chosen)) > 0
        keep = np.ones(len(sequence), bool)
        keep[at + 1] = False
        sequence[at] = (np.cumsum(used) - 1)[found] + (first_new + made)
        sequence, chosen = sequence[keep], chosen[used]
        rules.append(np.stack([chosen >> pair(shift), chosen & pair((1 << shift) - 1)], 1).astype(np.uint32))
        made += len(chosen)
    symbol = np.uint16 if first_new + made <= 1 << 16 else np.uint32
    return (np.concatenate(rules) if rules else np.zeros((0, 2))).astype(symbol), sequence.astype(symbol)


def _slots(pairs: np.ndarray) -> np.ndarray:
    return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)


class Grammar:
    """Expansions of all symbols: a rule only uses symbols before it."""

    def __init__(self, rules: np.ndarray, first_new: int):
        self.first_new = first_new
        self.sides = rules.astype(np.int64).reshape(-1, 2).T
        self.rule_lengths = np.zeros(len(rules), np.int64)
        # Rules whose symbols are known, wave by wave.
        self.waves: list[np.ndarray] = []
        left = np.arange(len(rules))
        while len(left):
            sizes = [self.lengths(side[left]) for side in self.sides]
            ready = (sizes[0] > 0) & (sizes[1] > 0)
            self.rule_lengths[left[ready]] = (sizes[0] + sizes[1])[ready]
            self.waves.append(left[ready])
            left = left[~ready]
        self.rule_firsts = np.cumsum(self.rule_lengths) - self.rule_lengths

    @cached_property
    def flat(self) -> np.ndarray:
        """Ids of all rules one after another."""
        out = np.zeros(int(self.rule_lengths.sum()), np.int64)
        for wave in self.waves:
            at = self.rule_firsts[wave].copy()
            for side in self.sides:
                symbol = side[wave]
                plain = symbol < self.first_new
                out[at[plain]] = symbol[plain]
                rule = symbol[~plain] - self.first_new
                lengths = self.rule_lengths[rule]
                out[ranges(at[~plain], lengths)] = out[ranges(self.rule_firsts[rule], lengths)]
                at += self.lengths(symbol)
        return out

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        new = symbols >= self.first_new
        out[new] = self.rule_lengths[symbols[new].astype(np.int64) - self.first_new]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        lengths = self.lengths(symbols)
        out = np.repeat(symbols.astype(np.int64), lengths)
        new = np.flatnonzero(symbols >= self.first_new)
        rule = symbols[new].astype(np.int64) - self.first_new
        starts = (np.cumsum(lengths) - lengths)[new]
        out[ranges(starts, self.rule_lengths[rule])] = self.flat[ranges(self.rule_firsts[rule], self.rule_lengths[rule])]
        return out


def write_shard(ids: np.ndarray, counts: np.ndarray, first_new: int, **settings: int) -> bytes:
    """A shard of documents with ``counts`` ids each."""
    rules, symbols = compress(ids, first_new, **settings)
    grammar = Grammar(rules, first_new)
    before = np.cumsum(grammar.lengths(symbols))
    marks = np.concatenate([[0], before[MARK_EVERY - 1 : len(symbols) - 1 : MARK_EVERY]]).astype("<u8")
    head = _HEAD.pack(_MAGIC, symbols.itemsize, first_new, len(rules), len(symbols), len(ids), len(counts), len(marks), MARK_EVERY, 0)
    return head + rules.tobytes() + grammar.rule_lengths.astype("<u4").tobytes() + symbols.tobytes() + counts.astype("<u8").tobytes() + marks.tobytes()


class Shard:
    """A shard as read back; ``ids`` decodes any stretch of it."""

    def __init__(self, payload: bytes):
        magic, width, first_new, n_rules, n_symbols, self.n_ids, n_docs, n_marks, self.every, _ = _HEAD.unpack_from(payload)
        if magic != _MAGIC:
            raise ValueError("not a shard of token ids")
        symbol, at = np.dtype(f"<u{width}"), _HEAD.size
        rules = np.frombuffer(payload, symbol, 2 * n_rules, at).reshape(-1, 2)
        at += 2 * n_rules * width + 4 * n_rules
        self.symbols = np.frombuffer(payload, symbol, n_symbols, at)
        at += n_symbols * width
        self.counts = np.frombuffer(payload, "<u8", n_docs, at).astype(np.int64)
        self.marks = np.frombuffer(payload, "<u8", n_marks, at + 8 * n_docs).astype(np.int64)
        self.grammar = Grammar(rules, first_new)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``: only the symbols between the nearest marks are expanded."""
        if stop <= start:
            return np.zeros(0, np.int64)
        a = int(np.searchsorted(self.marks, start, "right")) - 1
        b = int(np.searchsorted(self.marks, stop, "left"))
        part = self.grammar.expand(self.symbols[a * self.every : b * self.every])
        return part[start - self.marks[a] : stop - self.marks[a]]


@cache
def _library_encoder(path: str) -> tuple[PieceEncoder, int]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    strings = vocabulary(path).strings

    def encode(pieces: list[str]) -> list[list[int]]:
        """Ids of new pieces. Texts are their pieces one after another, so ids that decode to each piece decode to the text."""
        found = [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        for piece, ids in zip(pieces, found, strict=True):
            if b"".join([strings[i] for i in ids]) != piece.encode():
                raise ValueError(f"ids {ids} do not decode to {piece!r}")
        return found

    return PieceEncoder(encode, special), tokenizer.get_vocab_size(True)


def write_ids(docs: DataFrame, path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Table of shards in the order of ``doc_id`` (null first): ``part, shard, n_ids, crc32, doc_ids, payload``.

    The ids of each whole text are followed by ``end_id``; null counts as empty.
    A shard takes documents until it holds ``shard_ids`` ids; a document is never
    cut. ``part`` and ``shard`` give the order of shards, ``crc32`` is that of all
    ids of a shard. The table is written and read back from its files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = _library_encoder(path)
        part, shard = TaskContext.get().partitionId(), 0
        doc_ids, ids, counts, held = [], [], [], 0

        def full():
            whole = np.concatenate(ids)
            payload = write_shard(whole, np.concatenate(counts), size)
            names = pa.concat_arrays(doc_ids)
            listed = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
            return pa.record_batch([pa.array([part], pa.int64()), pa.array([shard], pa.int64()), pa.array([held], pa.int64()), pa.array([zlib.crc32(whole.astype("<u4"))], pa.int64()), listed, pa.array([payload], pa.binary())], ["part", "shard", "n_ids", "crc32", "doc_ids", "payload"])

        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in blocks(offsets):
                got, n = encoder.block(_texts(data, offsets, a, b))
                got = np.insert(got, np.cumsum(n), end_id)
                doc_ids.append(batch.column("doc_id")[a:b])
                ids.append(got.astype(np.int32))
                counts.append(n + 1)
                held += len(got)
                if held >= shard_ids:
                    yield full()
                    shard, doc_ids, ids, counts, held = shard + 1, [], [], [], 0
        if doc_ids:
            yield full()

    # Rows of one id, or without one, may fill several partitions.
    order = ["doc_id", F.xxhash64("text")]
    source = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(source.mapInArrow(run, "part long, shard long, n_ids long, crc32 long, doc_ids array<long>, payload binary"), "token-ids")


def read_ids(shards: DataFrame) -> DataFrame:
    """One row per document from the shards: ``part, shard, at, doc_id, ids`` (``at``: ids before it in its shard)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, doc_ids, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "shard", "doc_ids", "payload")), strict=True):
                shard = Shard(payload)
                ends = np.cumsum(shard.counts)
                n = len(doc_ids)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(shard.ids(0, shard.n_ids), pa.int32()))
                yield pa.record_batch([pa.array([part] * n, pa.int64()), pa.array([number] * n, pa.int64()), pa.array(ends - shard.counts, pa.int64()), pa.array(doc_ids, pa.int64()), ids], ["part", "shard", "at", "doc_id", "ids"])

    return shards.select("part", "shard", "doc_ids", "payload").mapInArrow(run, "part long, shard long, at long, doc_id long, ids array<int>")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, crc, doc_ids, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "shard", "crc32", "doc_ids", "payload")), strict=True):
            shard = Shard(payload)
            ends = np.cumsum(shard.counts)
            raw = shard.ids(0, shard.n_ids).astype("<u4").tobytes()
            if zlib.crc32(raw) != crc:
                raise ValueError(f"shard {number} of part {part} does not hold the ids that were written")
            starts = ends - shard.counts
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(doc_ids)
            yield pa.record_batch([pa.array([part] * n, pa.int64()), pa.array([number] * n, pa.int64()), pa.array(starts, pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(shard.counts), pa.array(crcs, pa.int64())], ["part", "shard", "at", "doc_id", "n_tokens", "ids_crc32"])


def shard_starts(shards: DataFrame) -> DataFrame:
    """Ids before each shard. A window runs over the shards of one part, and one over a row per part."""
    sizes = shards.select("part", "shard", "n_ids")
    earlier = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(parts), F.lit(0)).alias("before_part"))
    inside = sizes.select("part", "shard", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("before"))
    return inside.join(before, "part").select("part", "shard", (F.col("before") + F.col("before_part")).alias("before"))


def written_and_read(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """One row per row of ``docs`` from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it, in the order of
    ``doc_id``; null ids come first, and rows of one id in the order of a hash of
    their text. Null texts count as empty and hold the end id alone. Other
    columns are not read; an empty table gives an empty result.
    """
    with scratch(docs.sparkSession):
        shards = write_ids(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), path, shard_ids=shard_ids)
        read = shards.select("part", "shard", "crc32", "doc_ids", "payload").mapInArrow(_digests, "part long, shard long, at long, doc_id long, n_tokens long, ids_crc32 long")
        placed = read.join(shard_starts(shards), ["part", "shard"])
        return stage(placed.select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"), "token-digests", keep=True)
