"""Arrow batches of texts as numpy arrays, and hashes of their pieces.

All functions work on blocks: some rows of a batch, whole texts, a bounded
number of bytes (a single longer text is a block of its own).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
# Any odd multiplier serves; it has an inverse modulo 2**64.
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another and their ``n + 1`` offsets; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if len(have) <= 4 * BLOCK_BYTES:
            _powers[int(base)] = have
    return have[:n]


def scramble(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values (murmur finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Rolling:
    """Hash of any slice of a block from one prefix sum."""

    def __init__(self, values: np.ndarray):
        """``values``: bytes or code points."""
        terms = values.astype(np.uint64)
        terms += np.uint64(1)
        terms *= _power(_BASE, len(terms))
        self.prefix = np.zeros(len(terms) + 1, np.uint64)
        np.cumsum(terms, out=self.prefix[1:])
        self.inverse = _power(_BASE_INVERSE, len(terms) + 1)

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = self.prefix[ends] - self.prefix[starts]
        h *= self.inverse[starts]
        h += (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return scramble(h)

    def windows(self, width: int) -> np.ndarray:
        """Hash of every slice of ``width`` values."""
        n = len(self.prefix) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = self.prefix[width:] - self.prefix[:n]
        h *= self.inverse[:n]
        return scramble(h)


# Longer slices are hashed one by one.
_LONGEST = 64
_MIX = np.uint64(0x9DDFEA08EB382D69)


# Masks of the lowest bytes of a word.
_LOW = np.concatenate([[np.uint64(0)], np.uint64((1 << 64) - 1) >> np.arange(56, -1, -8, dtype=np.uint64)])


def _eights(data: np.ndarray, room: int) -> np.ndarray:
    """The eight bytes from every place, with ``room`` zeros behind the last."""
    padded = np.zeros(len(data) + room + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))


def packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first eight and the next eight bytes of slices, as numbers; with the length they are a slice of up to 16 bytes."""
    eights = _eights(data, 16)
    low = eights[starts] & _LOW[np.minimum(lengths, 8)]
    high = eights[starts + 8] & _LOW[np.clip(lengths - 8, 0, 8)]
    return low, high


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of slices of bytes, which mixes eight bytes at a time.

    Unlike :class:`Rolling` it is no polynomial: a polynomial modulo a power of
    two has one value for certain words of two letters, whatever its base.
    """
    lengths = (ends - starts).astype(np.int64)
    eights = _eights(data, _LONGEST)
    out = scramble(lengths.astype(np.uint64) * _MIX)
    left = np.flatnonzero(lengths <= _LONGEST)
    for at in range(0, _LONGEST, 8):
        left = left[lengths[left] > at]
        if not len(left):
            break
        eight = eights[starts[left] + at] & _LOW[np.minimum(lengths[left] - at, 8)]
        out[left] = scramble((out[left] ^ eight) * _MIX)
    raw = memoryview(np.ascontiguousarray(data))
    for i in np.flatnonzero(lengths > _LONGEST).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the different shingles of ``size`` words of each text.

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z. A text with fewer words
    has its whole sequence as one shingle, without words it has none.
    """
    capital = (data >= 0x41) & (data <= 0x5A)
    starts, ends, rows = words(data, offsets)
    word = slice_hashes(np.where(capital, data + np.uint8(32), data), starts, ends)
    n = len(offsets) - 1
    first = np.searchsorted(rows, np.arange(n + 1))
    many = max(0, len(word) - size + 1)
    hashes = np.full(many, np.uint64(size))
    for i in range(size):
        hashes = scramble((hashes ^ word[i : i + many]) * _MIX)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(hashes[a : b - size + 1]))
        elif b > a:
            whole = np.full(1, np.uint64(b - a))
            for i in range(a, b):
                whole = scramble((whole ^ word[i : i + 1]) * _MIX)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``; words never cross rows."""
    inside = np.ones(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts + 1]
    last[cuts - 1] = inside[cuts]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all ranges one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
