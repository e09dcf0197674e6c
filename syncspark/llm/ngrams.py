"""Hashed word and character n-gram features of blocks of texts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from syncspark.llm.text import Rolling, code_points

# White space of the texts: ends of words and of character n-grams.
_BLANK = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x2028, 0x2029, 0x3000]
# Hash of the common word for repeated ones.
_REPEATED = np.uint64(0x5DEECE66D1CE4E5B)


class Features:
    """Features of the texts of a block, as numbers below ``2 ** bits``.

    Words are runs without white space. A character n-gram lies inside a word
    and may begin or end with the white space around it. With ``repeats`` a word
    that is the same as the one before it also counts as one common word, as
    such repetition says the same whatever the word is.
    """

    def __init__(self, texts: Sequence[str], bits: int, sizes: Sequence[int], repeats: bool = False):
        self.n, self.sizes, self.repeats = len(texts), sizes, repeats
        points = code_points("\n" + "\n".join(texts) + "\n")
        self.blank = np.isin(points, _BLANK) if len(points) < 64 else _blank(points)
        points = np.where(self.blank, np.uint32(0x20), points)
        lengths = np.fromiter(map(len, texts), np.int64, self.n)
        # The separator before a text counts with it, the one behind it does not.
        self.ends = np.cumsum(lengths + 1)
        self.starts = self.ends - lengths - 1
        self.rolling = Rolling(points)
        self.shift = np.uint64(64 - bits)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Feature and text of each word."""
        inside = ~self.blank
        starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        hashes, rows = self.rolling.slices(starts, ends), np.searchsorted(self.ends, starts, "right")
        if self.repeats:
            again = rows[1:][(hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])]
            hashes = np.concatenate([hashes, np.full(len(again), _REPEATED)])
            rows = np.concatenate([rows, again])
        return hashes >> self.shift, rows

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Feature of every window of ``size`` signs, and whether it is a character n-gram."""
        hashes = self.rolling.windows(size) >> self.shift
        blanks = np.zeros(len(self.blank) + 1, np.int32)
        np.cumsum(self.blank, out=blanks[1:])
        n = len(hashes)
        return hashes, blanks[size - 1 : size - 1 + n] == blanks[1 : 1 + n]

    def counts(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Different features of each text, and their shares of all its features."""
        codes = []
        feature, row = self.words()
        codes.append((row.astype(np.uint64) << np.uint64(32)) | feature)
        for size in self.sizes:
            hashes, valid = self.grams(size)
            at = np.flatnonzero(valid)
            row = np.searchsorted(self.ends, at, "right").astype(np.uint64)
            codes.append((row << np.uint64(32)) | hashes[at])
        code, count = np.unique(np.concatenate(codes), return_counts=True)
        cuts = np.searchsorted(code, np.arange(self.n + 1, dtype=np.uint64) << np.uint64(32))
        out = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            total = max(1, count[a:b].sum())
            out.append(((code[a:b] & np.uint64(0xFFFFFFFF)).astype(np.int64), (count[a:b] / total).astype(np.float32)))
        return out

    def means(self, table: np.ndarray) -> np.ndarray:
        """Mean of the rows of ``table`` over all features of each text; 0 without features."""
        table = table.reshape(len(table), -1)
        columns = table.shape[1]
        feature, row = self.words()
        total = np.bincount(row, minlength=self.n).astype(np.float64)
        sums = np.stack([np.bincount(row, table[feature, c], self.n) for c in range(columns)], 1)
        for size in self.sizes:
            hashes, valid = self.grams(size)
            n = len(hashes)
            a, b = np.minimum(self.starts, n), np.minimum(self.ends, n)
            seen = np.zeros(n + 1, np.int64)
            np.cumsum(valid, out=seen[1:])
            total += seen[b] - seen[a]
            where = hashes[valid]
            cut_a, cut_b = seen[a], seen[b]
            for c in range(columns):
                run = np.zeros(len(where) + 1)
                np.cumsum(table[where, c], out=run[1:])
                sums[:, c] += run[cut_b] - run[cut_a]
        return sums / np.maximum(total, 1)[:, None]


def _blank(points: np.ndarray) -> np.ndarray:
    blank = (points == 0x20) | ((points >= 0x09) & (points <= 0x0D))
    far = np.flatnonzero(points >= 0x85)
    blank[far] = np.isin(points[far], _BLANK)
    return blank


def remainder(doc_id: str, divisor: int):
    """``crc32`` of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % divisor


def bounded_sample(rows: DataFrame, label: str, key: str, per_label: int, labels: int, size: Column | None = None, total_size: int = 0) -> DataFrame:
    """About ``per_label`` rows of each label, chosen by a hash of ``key``; never more than twice that in all.

    Only the ``labels`` most frequent labels are taken, ties by the smaller one.
    With ``size``, each label also gets rows of about ``total_size / labels found``
    at most. Counts of these labels, one row each, go to the driver; the rows
    themselves are chosen where they are.
    """
    size = F.lit(0) if size is None else size
    counts = rows.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"), F.sum(size).alias("size"))
    counts = counts.orderBy(F.desc("n"), label).limit(labels).collect()
    share = F.lit(None).cast("double")
    for value, n, filled in counts:
        most = total_size / len(counts) / filled if filled else 1.0
        share = F.when(F.col(label) == value, F.lit(min(1.0, per_label / n, most))).otherwise(share)
    position = F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(position < share).limit(2 * per_label * max(1, len(counts)))
