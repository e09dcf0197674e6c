"""Byte-level BPE encoding with a queue of merge ranks, and decoding.

Encoding keeps the symbols of a piece in a doubly linked list and the possible
merges in a priority queue; entries whose symbols have changed meanwhile are
skipped when they come up. Decoding concatenates the byte strings of the ids.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from syncspark.llm.pretokens import PieceEncoder
from syncspark.llm.text import blocks, ranges, utf8


def _sign_bytes() -> dict[str, int]:
    """Byte of each sign of a byte-level vocabulary: printable Latin-1 stands for itself, other bytes follow from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Vocabulary, merges and special strings of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        signs = _sign_bytes()
        self.strings = [b""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, i in ids.items():
            if token not in self.special:
                self.strings[i] = bytes(signs[c] for c in token)
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.byte_ids = [ids[sign] for sign, _ in sorted(signs.items(), key=lambda x: x[1])]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(content["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[ids[left], ids[right]] = rank, ids[left + right]
        self.lengths = np.array([len(s) for s in self.strings], np.int64)
        self.firsts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(self.strings), np.uint8)
        digits = [str(i).encode() + b"," for i in range(len(self.strings))]
        self.decimal_lengths = np.array([len(d) for d in digits], np.int64)
        self.decimal_firsts = np.cumsum(self.decimal_lengths) - self.decimal_lengths
        self.decimals = np.frombuffer(b"".join(digits), np.uint8)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: the possible merge of least rank first, the leftmost of equals."""
        ids = [self.byte_ids[b] for b in piece]
        n, merges = len(ids), self.merges
        if n == 1:
            return ids
        queue = []
        for i in range(n - 1):
            found = merges.get((ids[i], ids[i + 1]))
            if found:
                queue.append((found[0], i, found[1], ids[i], ids[i + 1]))
        if not queue:
            return ids
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            _, i, joined, left, right = heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = joined, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = merges.get((joined, ids[k]))
                if found:
                    heappush(queue, (found[0], i, found[1], joined, ids[k]))
            h = before[i]
            if h >= 0:
                found = merges.get((ids[h], joined))
                if found:
                    heappush(queue, (found[0], h, found[1], ids[h], joined))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        return [self.merge(p.encode("utf-8", "surrogatepass")) for p in pieces]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of ids, their strings one after another."""
        return self.bytes[ranges(self.firsts[ids], self.lengths[ids])]

    def decimal(self, ids: np.ndarray) -> np.ndarray:
        """Ids as decimal text, each with a comma behind it."""
        return self.decimals[ranges(self.decimal_firsts[ids], self.decimal_lengths[ids])]


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker."""
    return Vocabulary(path)


@cache
def _encoder(path: str) -> PieceEncoder:
    own = vocabulary(path)
    return PieceEncoder(own.encode_pieces, own.special)


def _texts(data: np.ndarray, offsets: np.ndarray, a: int, b: int) -> list[str]:
    raw = data[offsets[a] : offsets[b]].tobytes()
    cut = (offsets[a : b + 1] - offsets[a]).tolist()
    return [raw[x:y].decode("utf-8", "replace") for x, y in zip(cut[:-1], cut[1:], strict=True)]


def _digest_block(path: str, texts: list[str]) -> tuple[np.ndarray, list[str], list[str]]:
    own = vocabulary(path)
    ids, counts = _encoder(path).block(texts)
    ends = np.cumsum(counts)
    decimal, decoded = own.decimal(ids).tobytes(), own.decode(ids).tobytes()
    edge = np.concatenate([[0], np.cumsum(own.decimal_lengths[ids])])
    decimal_at = edge[np.concatenate([[0], ends])].tolist()
    edge = np.concatenate([[0], np.cumsum(own.lengths[ids])])
    decoded_at = edge[np.concatenate([[0], ends])].tolist()
    ids_sha, text_sha = [], []
    for i, text in enumerate(texts):
        back = decoded[decoded_at[i] : decoded_at[i + 1]]
        if back != text.encode("utf-8", "surrogatepass"):
            raise ValueError("decoded text differs from the encoded one")
        ids_sha.append(hashlib.sha256(decimal[decimal_at[i] : max(decimal_at[i + 1] - 1, decimal_at[i])]).hexdigest())
        text_sha.append(hashlib.sha256(back.decode("utf-8", "replace").encode()).hexdigest())
    return counts, ids_sha, text_sha


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the ids of the whole text as an array; null and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in blocks(offsets):
                ids, counts = _encoder(path).block(_texts(data, offsets, a, b))
                cut = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                yield pa.record_batch([batch.column("doc_id")[a:b], pa.ListArray.from_arrays(cut, pa.array(ids, pa.int32()))], ["doc_id", "ids"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id`` and ``text`` of arrays of ids; bytes that are no UTF-8 become replacement signs, null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for batch in batches:
            texts = [None if x is None else own.decode(np.array(x, np.int64)).tobytes().decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    source = encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return source.mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Whole texts are encoded, decoded again and compared with the text; a
    difference fails the job. Null counts as empty, an empty text has no ids.
    Special strings in a text get their own ids. Repeated rows give repeated
    rows, an empty table an empty result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in blocks(offsets):
                counts, ids_sha, text_sha = _digest_block(path, _texts(data, offsets, a, b))
                yield pa.record_batch([batch.column("doc_id")[a:b], pa.array(counts), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
