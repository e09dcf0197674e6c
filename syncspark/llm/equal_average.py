"""Compression of vectors to codes of their parts, with equal-average search.

Every component becomes an integer, every vector four equal parts. Each part
position has a codebook, which some rounds of assigning and averaging improve.

The nearest entry of a part is searched in the order of component sums. By
Cauchy-Schwarz the squared gap of two sums, over the dimension, is at most the
squared distance: starting at the part's own sum, entries are looked at on both
sides until that bound strictly exceeds the best distance. So every entry as
near as the best has been seen, and of those the lowest index is taken.

All arithmetic is on integers. Sums of a round travel as digits of ``_DIGIT``
bits, so they are added by Spark without rounding or overflow.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from syncspark.llm.text import blocks
from syncspark.workspace import scratch, stage

_DIGIT = 40
# Components of a block that is searched at once.
_BLOCK = 1 << 18
# Entries looked at on each side in one step.
_STEP = 4
# Codebooks of each vector length: one array of entries for each part.
Codebooks = dict[int, list[np.ndarray]]


@dataclass(frozen=True)
class Settings:
    """``entries`` of a codebook (256 at most, a code has two digits), improved in ``rounds``; components are multiplied by ``scale``."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


def _whole(x: float, scale: int) -> int:
    # A very large number is whole already, and its product might be infinite.
    return int(x) * scale if abs(x) > 1e300 else math.floor(x * scale)


def integers(values: np.ndarray, settings: Settings) -> np.ndarray:
    """Floors of the scaled components: 64-bit numbers where squares of all sums fit, else Python's."""
    if not values.size or np.abs(values).max() * settings.scale < (1 << 29) / max(1, values.shape[1]):
        return np.floor(values * settings.scale).astype(np.int64)
    flat = [_whole(x, settings.scale) for x in values.ravel().tolist()]
    return np.array(flat, object).reshape(values.shape)


def cut(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    """Equal consecutive parts; zeros fill up a length that they do not divide."""
    width = -(-vectors.shape[1] // parts)
    filled = np.zeros((len(vectors), width * parts), vectors.dtype)
    filled[:, : vectors.shape[1]] = vectors
    return [filled[:, i * width : (i + 1) * width] for i in range(parts)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each part; of equally near ones the lowest index."""
    n, dimension = parts.shape
    kind = object if object in (parts.dtype, entries.dtype) else np.int64
    index, best = np.zeros(n, np.int64), np.zeros(n, kind)
    if not n or not dimension:
        return index, best
    order = np.argsort(entries.sum(1), kind="stable")
    ordered, sums = entries[order], entries.sum(1)[order]
    own = parts.sum(1)
    start = np.searchsorted(sums, own)
    found = np.zeros(n, bool)
    # Each side: the next place, and the rows that still look there.
    for first in range(0, len(order), _STEP):
        looked = False
        for side in (-1, 1):
            for k in range(first, min(first + _STEP, len(order))):
                place = start + k if side > 0 else start - 1 - k
                rows = np.flatnonzero((place >= 0) & (place < len(order)))
                at = place[rows]
                gap = own[rows] - sums[at]
                near = ~found[rows] | (gap * gap <= dimension * best[rows])
                rows, at = rows[near], at[near]
                if not len(rows):
                    break
                looked = True
                away = parts[rows] - ordered[at]
                distance = (away * away).sum(1)
                number = order[at]
                better = ~found[rows] | (distance < best[rows]) | ((distance == best[rows]) & (number < index[rows]))
                rows = rows[better]
                index[rows], best[rows], found[rows] = number[better], distance[better], True
        if not looked:
            break
    return index, best


def assign(vectors: np.ndarray, codebooks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the nearest entries by part, and the squared distances summed over the parts."""
    found = [nearest(part, entries) for part, entries in zip(cut(vectors, len(codebooks)), codebooks, strict=True)]
    return np.stack([i for i, _ in found], 1), sum(d for _, d in found)


def _matrices(batch: pa.RecordBatch, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer vectors of blocks of a batch, each of one vector length."""
    column = batch.column("embedding")
    cuts = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(cuts)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        for a, b in blocks(np.arange(len(rows) + 1) * max(1, int(size)), _BLOCK):
            some = rows[a:b]
            yield some, integers(flat[cuts[some][:, None] + np.arange(size)], settings)


def _digits(number: int) -> list[int]:
    """Digits of a number, the lowest first, all with its sign."""
    sign, number, out = (-1 if number < 0 else 1), abs(number), []
    while number or not out:
        out.append(sign * (number & ((1 << _DIGIT) - 1)))
        number >>= _DIGIT
    return out


def _summed(shared, settings: Settings):
    """Counts (position -1) and sums of the parts that fall to each entry, as digits; one row for each of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = {}, {}
        for batch in batches:
            for _, vectors in _matrices(batch, settings):
                length = vectors.shape[1]
                books = shared.value[length]
                indexes, _ = assign(vectors, books)
                for part, (entries, own) in enumerate(zip(books, cut(vectors, len(books)), strict=True)):
                    key = length, part
                    if key not in sums:
                        counts[key], sums[key] = np.zeros(len(entries), np.int64), np.zeros(entries.shape, object)
                    counts[key] += np.bincount(indexes[:, part], minlength=len(entries))
                    # A block's sums fit 64 bits wherever its components do.
                    block = np.zeros(entries.shape, own.dtype)
                    np.add.at(block, indexes[:, part], own)
                    sums[key] += block
        out = []
        for (length, part), count in counts.items():
            for entry in np.flatnonzero(count).tolist():
                out.append((length, part, entry, -1, 0, int(count[entry])))
                for place, value in enumerate(sums[length, part][entry].tolist()):
                    out.extend((length, part, entry, place, i, digit) for i, digit in enumerate(_digits(value)))
        columns = [list(x) for x in zip(*out, strict=True)] or [[]] * 6
        kinds = [pa.int32()] * 5 + [pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["length", "part", "entry", "place", "digit", "value"])

    return run


def _coded(shared, settings: Settings):
    """Code and error of every vector; null for an error that no 64-bit number holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, vectors in _matrices(batch, settings):
                indexes, errors = assign(vectors, shared.value[vectors.shape[1]])
                codes = [bytes(x).hex() for x in indexes.astype(np.uint8)]
                fit = [e if e < 1 << 63 else None for e in errors.tolist()]
                taken = pa.array(rows)
                yield pa.record_batch(
                    [batch.column("vec_id").take(taken), batch.column("label").take(taken), pa.array([vectors.shape[1]] * len(rows), pa.int32()), pa.array(codes, pa.string()), pa.array(fit, pa.int64())],
                    ["vec_id", "label", "length", "code", "error"],
                )

    return run


def _first_entries(kept: DataFrame, settings: Settings) -> Codebooks:
    """Codebooks of the vectors with the smallest ids: some of each task are ranked in 64 shares, then those of the shares."""
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    some = kept.select("vec_id", "embedding", F.size("embedding").alias("length"), (F.spark_partition_id() % 64).alias("share"))
    for keys in (["length", "share"], ["length"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        some = some.withColumn("rank", rank).where(F.col("rank") <= settings.entries)
    rows = {}
    for length, _, vector in sorted(map(tuple, some.select("length", "rank", "embedding").collect()), key=lambda r: r[:2]):
        rows.setdefault(length, []).append(vector)
    return {length: cut(integers(np.array(r, np.float64).reshape(len(r), length), settings), settings.parts) for length, r in rows.items()}


def _improved(books: Codebooks, totals: DataFrame) -> Codebooks:
    """Entries replaced by the floor of the mean of their parts; those without parts stay."""
    counts, sums = {}, {}
    for length, part, entry, place, digit, value in totals.toLocalIterator():
        if place < 0:
            counts[length, part, entry] = int(value)
        else:
            row = sums.setdefault((length, part, entry), {})
            row[place] = row.get(place, 0) + (int(value) << (_DIGIT * digit))
    out = {}
    for length, entries in books.items():
        out[length] = []
        for part, old in enumerate(entries):
            new = old.astype(object)
            for entry in range(len(old)):
                for place, value in sums.get((length, part, entry), {}).items():
                    new[entry, place] = value // counts[length, part, entry]
            small = not new.size or max(map(abs, new.ravel().tolist())) < (1 << 29) // max(1, length)
            out[length].append(new.astype(np.int64) if small else new)
    return out


def codebook_digest(entries: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimal text, joined by commas."""
    return hashlib.sha256(",".join(str(x) for part in entries for x in part.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", settings: Settings = Settings()) -> DataFrame:
    """One row per usable vector: ``vec_id, code, error, label_error, codebooks_sha256``.

    Rows whose vector is null or holds a null or a component that is not finite
    are dropped. A codebook starts as the parts of the ``entries`` smallest ids
    (null counts as largest, repeated ids each count, the smaller vector first);
    fewer rows make a smaller codebook. Vectors of each length have codebooks of
    their own, and zeros are added where the parts do not divide a length; an
    empty vector has empty parts, code 0 and error 0. Repeated rows give
    repeated rows. ``label_error`` is the sum over equal labels, nulls together.
    An error or a sum beyond 64 bits is null, as its label's sum is then.
    Other columns are not read; an empty table gives an empty result. Codebooks
    are what goes through the driver: ``entries`` vectors of each length.
    """
    spark = vectors.sparkSession
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    value = F.col(embedding)
    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), value.cast("array<double>").alias("embedding"))
    with scratch(spark):
        kept = stage(source.where(F.col("embedding").isNotNull() & F.forall("embedding", finite)), "vectors")
        books = _first_entries(kept, settings)
        for _ in range(settings.rounds):
            shared = spark.sparkContext.broadcast(books)
            summed = kept.select("embedding").mapInArrow(_summed(shared, settings), "length int, part int, entry int, place int, digit int, value long")
            keys = ["length", "part", "entry", "place", "digit"]
            books = _improved(books, summed.groupBy(*keys).agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")))
        shared = spark.sparkContext.broadcast(books)
        kinds = {f.name: f.dataType.simpleString() for f in kept.schema.fields}
        coded = stage(kept.mapInArrow(_coded(shared, settings), f"vec_id {kinds['vec_id']}, label {kinds['label']}, length int, code string, error long"), "codes")
        total = F.when(F.count("error") == F.count("*"), F.sum(F.col("error").cast("decimal(38,0)"))).try_cast("long")
        sums = stage(coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "of"), "label-errors")
        digest = F.lit(None).cast("string")
        for length, entries in books.items():
            digest = F.when(F.col("length") == length, codebook_digest(entries)).otherwise(digest)
        found = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
        return stage(found.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256")), "compressed", keep=True)
