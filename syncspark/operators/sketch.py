"""Differences of two frames found from a sketch of them.

Every row falls into three cells, which add up counts and hash bits: source rows
count up, sink rows down, so rows that both sides hold cancel out wherever they
are. A cell with one differing row shows its hash bits; taken out of its other
cells, it uncovers further ones. What is shuffled are the cells of each task,
whatever the number of rows; what is left to compare are the differing rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from syncspark.operators.reconcile import PIECE_BITS, row_digest, same_types

# Cells of each of the three parts: so many are still small enough for the driver.
MOST_CELLS = 1 << 18
_PARTS = 3
# Sums of 2^31 rows of one cell fit a long.
_CHECK = (1 << 31) - 1

Digest = tuple[int, ...]


def _check(p: list) -> object:
    """A number that sums of other digests do not have; of columns or of integers."""
    return (p[0] * p[1] + p[2] * p[3] + p[4] * p[4]) % _CHECK


def _cells(pieces: list, cells: int) -> list:
    """The three cells of a digest; of columns or of integers."""
    return [pieces[i] % cells + i * cells for i in range(_PARTS)]


def _sums(side: DataFrame, sign: int, pieces: list[Column], cells: int) -> DataFrame:
    values = [F.lit(1).cast("long"), *pieces, _check(pieces)]
    signed = [(value * sign).alias(f"_s{i}") for i, value in enumerate(values)]
    return side.select(F.explode(F.array(*_cells(pieces, cells))).alias("_cell"), *signed)


def peeled(table: Iterable[tuple[int, ...]], cells: int) -> dict[Digest, int] | None:
    """Digests of the differing rows with source less sink copies; None where the cells hold too many.

    ``table``: cell, count, sums of the pieces, sum of the check numbers.
    """
    left = {row[0]: list(row[1:]) for row in table}

    def single(cell: int) -> Digest | None:
        n, *sums, check = left[cell]
        if n == 0 or any(s % n for s in sums):
            return None
        digest = tuple(s // n for s in sums)
        fits = all(0 <= p < 1 << PIECE_BITS for p in digest) and check == n * _check(digest)
        return digest if fits and cell in _cells(digest, cells) else None

    found: dict[Digest, int] = {}
    queue = list(left)
    while queue:
        cell = queue.pop()
        digest = single(cell)
        if digest is None:
            continue
        n = left[cell][0]
        found[digest] = found.get(digest, 0) + n
        for other in _cells(digest, cells):
            if other not in left:
                return None
            left[other] = [a - n * b for a, b in zip(left[other], (1, *digest, _check(digest)))]
            queue.append(other)
    return None if any(any(values) for values in left.values()) else {d: n for d, n in found.items() if n}


def _keys(pieces: list) -> tuple:
    return pieces[0] + pieces[1] * (1 << 20) + pieces[2] * (1 << 40), pieces[3] + pieces[4] * (1 << 20)


def narrow_by_sketch(source: DataFrame, sink: DataFrame, cells: int = 1 << 14) -> tuple[DataFrame, DataFrame]:
    """Both sides without the rows of which they hold equally many copies.

    For sinks that lost or gained up to about twice ``cells`` different rows;
    with more, both frames come back as they are, for the whole comparison.
    Missing and extra rows are those of the whole frames, totals are not. Rows
    are told apart by 100 hash bits. At most ``3 * cells`` cells that are not zero
    go to the driver, and at most as many digests are broadcast.
    """
    if not 0 < cells <= MOST_CELLS:
        raise ValueError(f"cells must be between 1 and {MOST_CELLS}")
    sides = same_types(source, sink)
    names = source.columns
    _, pieces = row_digest(names, 1)
    both = _sums(sides[0], 1, pieces, cells).union(_sums(sides[1], -1, pieces, cells))
    columns = [f"_s{i}" for i in range(len(pieces) + 2)]
    summed = both.groupBy("_cell").agg(*(F.sum(c).alias(c) for c in columns))
    unequal = reduce(Column.__or__, [F.col(c) != 0 for c in columns])
    found = peeled((tuple(r) for r in summed.filter(unequal).collect()), cells)
    if found is None:
        return source, sink
    kinds = T.StructType([T.StructField(k, T.LongType()) for k in ("_first", "_second")])
    digests = F.broadcast(source.sparkSession.createDataFrame([_keys(d) for d in found], kinds))
    first, second = _keys(pieces)
    kept = [s.withColumn("_first", first).withColumn("_second", second).join(digests, ["_first", "_second"], "left_semi") for s in sides]
    return kept[0].select(*names), kept[1].select(*names)
