"""Splitting texts into the pieces a byte-level vocabulary merges in, by arrays.

A byte-level tokenizer never merges across pieces, so the ids of a text are the
ids of its pieces one after another. A block of texts is split with array
operations, each different piece is encoded once, and a bounded cache keeps
the ids of pieces seen before.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np

from syncspark.llm.text import code_points, packed, ranges, scramble

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
# White_Space property of Unicode.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters of the contractions 's 't 'm 'd and 're 've 'll.
_ONE = np.array([ord(c) for c in "stmd"], np.uint32)
_TWO = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
CACHE_PIECES = 1_200_000


@cache
def classes() -> np.ndarray:
    """Kind of every code point: white space, letter, number or other."""
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[_WHITE] = _SPACE
    return table


def split(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places where a piece begins; ``starts`` are those of the texts.

    The pieces are contractions, letters, numbers or other signs with at most
    one space before them, and runs of white space. The last sign of such a run
    begins the next piece if it is a space and stands alone if it is not.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    text_start = np.zeros(n + 1, bool)
    text_start[starts] = True
    text_start[n] = True
    begins = text_start[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    after = np.flatnonzero((kind[1:] != _SPACE) & (kind[:-1] == _SPACE) & ~text_start[1:n]) + 1
    begins[after - 1] = True
    begins[after] = points[after - 1] != 0x20
    quote = np.flatnonzero(points == 0x27)
    quote = quote[begins[quote] & ~text_start[quote + 1]]
    first = points[quote + 1]
    one = np.isin(first, _ONE)
    long = quote[~one]
    long = long[~text_start[long + 2]] if len(long) else long
    two = np.zeros(len(long), bool)
    for a, b in _TWO:
        two |= (points[long + 1] == a) & (points[long + 2] == b)
    for at, size in ((quote[one], 1), (long[two], 2)):
        begins[at + 1] = False
        rest = at + 1 + size
        rest = rest[~text_start[rest]]
        begins[rest[kind[rest] == _LETTER]] = True
    return np.flatnonzero(begins)


def _spread(low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
    return scramble(scramble(low ^ size.astype(np.uint64)) + high * np.uint64(0x9DDFEA08EB382D69))


class _Pieces:
    """Known pieces with their ids, found by their bytes.

    A piece of up to 16 bytes is two numbers and a length, kept in arrays with
    an open-addressing table over them; longer ones are keys of a dictionary.
    """

    def __init__(self, limit: int):
        self.slots = np.full(1 << max(8, (2 * limit).bit_length()), -1, np.int32)
        self.mask = np.uint64(len(self.slots) - 1)
        self.low, self.high = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.size, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.first, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.long: dict[bytes, int] = {}

    def __len__(self) -> int:
        return len(self.first)

    def find(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Entry of each piece, -1 for unknown ones."""
        out = np.full(len(low), -1, np.int64)
        slot = _spread(low, high, size) & self.mask
        left = np.arange(len(low))
        while len(left):
            entry = self.slots[slot]
            held = entry >= 0
            left, slot, entry = left[held], slot[held], entry[held]
            same = (self.low[entry] == low[left]) & (self.high[entry] == high[left]) & (self.size[entry] == size[left])
            out[left[same]] = entry[same]
            left, slot = left[~same], (slot[~same] + np.uint64(1)) & self.mask
        return out

    def _append(self, low: np.ndarray, high: np.ndarray, size: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
        entries = np.arange(len(self), len(self) + len(low))
        firsts = len(self.ids) + np.cumsum(lengths) - lengths
        self.low, self.high, self.size = (np.concatenate(x) for x in ((self.low, low), (self.high, high), (self.size, size)))
        self.first, self.length, self.ids = (np.concatenate(x) for x in ((self.first, firsts), (self.length, lengths), (self.ids, ids)))
        return entries

    def add(self, low: np.ndarray, high: np.ndarray, size: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Entries of different unknown pieces, whose ids stand one after another."""
        if 2 * (len(self) + len(low)) > len(self.slots):
            self.slots = np.full(1 << (4 * (len(self) + len(low))).bit_length(), -1, np.int32)
            self.mask = np.uint64(len(self.slots) - 1)
            self._place(np.flatnonzero(self.size >= 0))
        entries = self._append(low, high, size, lengths, ids)
        self._place(entries)
        return entries

    def _place(self, entries: np.ndarray) -> None:
        """Give entries their slots; of several that want one, the last one written has it."""
        slot = _spread(self.low[entries], self.high[entries], self.size[entries]) & self.mask
        while len(entries):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = entries[free]
            waits = self.slots[slot] != entries
            entries, slot = entries[waits], (slot[waits] + np.uint64(1)) & self.mask

    def add_long(self, pieces: list[bytes], lengths: np.ndarray, ids: np.ndarray) -> None:
        none = np.zeros(len(pieces), np.uint64)
        entries = self._append(none, none, np.full(len(pieces), -1), lengths, ids)
        self.long.update(zip(pieces, entries.tolist(), strict=True))


class PieceEncoder:
    """Ids of texts by the ids of their pieces.

    ``encode`` gives the ids of each of a list of pieces; ``special`` are strings
    with an id of their own, cut out before the split. About ``cache_pieces``
    pieces are kept, in two generations: when the younger is full the older goes,
    and pieces found in the older join the younger, so those in use stay.
    """

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]], special: dict[str, int], cache_pieces: int = CACHE_PIECES):
        self.encode, self.special, self.limit = encode, special, max(1, cache_pieces // 2)
        self.young, self.old = _Pieces(self.limit), _Pieces(1)

    def _encoded(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.encode([p.decode("utf-8", "surrogatepass") for p in pieces])
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return lengths, np.fromiter((i for ids in found for i in ids), np.int32, int(lengths.sum()))

    def _entries(self, raw: bytes, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Entries in the young generation of pieces of ``raw``; unknown ones are encoded."""
        if len(self.young) > self.limit:
            self.young, self.old = _Pieces(self.limit), self.young
        young, old = self.young, self.old
        out = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(size <= 16)
        low, high = packed(np.frombuffer(raw, np.uint8), starts[short], size[short])
        out[short] = young.find(low, high, size[short])
        absent = np.flatnonzero(out[short] < 0)
        if len(absent):
            where, low, high = short[absent], low[absent], high[absent]
            order = np.lexsort((size[where], high, low))
            a, b = order[1:], order[:-1]
            new = np.concatenate([[True], (low[a] != low[b]) | (high[a] != high[b]) | (size[where[a]] != size[where[b]])])
            one = order[new]
            low, high, sizes, places = low[one], high[one], size[where[one]], where[one]
            known = old.find(low, high, sizes)
            entries = np.empty(len(one), np.int64)
            for some, held in ((np.flatnonzero(known >= 0), True), (np.flatnonzero(known < 0), False)):
                if not len(some):
                    continue
                if held:
                    lengths = old.length[known[some]]
                    ids = old.ids[ranges(old.first[known[some]], lengths)]
                else:
                    at = places[some]
                    lengths, ids = self._encoded([raw[x:y] for x, y in zip(starts[at].tolist(), (starts[at] + size[at]).tolist(), strict=True)])
                entries[some] = young.add(low[some], high[some], sizes[some], lengths, ids)
            out[where[order]] = entries[np.cumsum(new) - 1]
        longer = np.flatnonzero(size > 16)
        if len(longer):
            pieces = [raw[x:y] for x, y in zip(starts[longer].tolist(), (starts[longer] + size[longer]).tolist(), strict=True)]
            unknown = list(dict.fromkeys(p for p in pieces if p not in young.long))
            if unknown:
                young.add_long(unknown, *self._encoded(unknown))
            out[longer] = [young.long[p] for p in pieces]
        return out

    def _plain(self, text: str, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts joined to one string, and how many each has."""
        points = code_points(text)
        n = len(points)
        begins = split(points, starts[starts < n])
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(starts), np.int64)
        raw, at = text.encode("utf-8", "surrogatepass"), begins
        if len(raw) > n:
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            at = (np.cumsum(width) - width)[begins]
        entries = self._entries(raw, at, np.diff(np.append(at, len(raw))))
        lengths = self.young.length[entries]
        ids = self.young.ids[ranges(self.young.first[entries], lengths)]
        owner = np.searchsorted(starts, begins, "right") - 1
        return ids, np.bincount(owner, lengths, len(starts)).astype(np.int64)

    def block(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        parts = [self._cut(t) for t in texts]
        pieces = [p for cut in parts for p in cut[::2]]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids, counts = self._plain("".join(pieces), np.cumsum(sizes) - sizes)
        if len(pieces) == len(texts):
            return ids, counts
        marks = np.fromiter((len(cut) // 2 for cut in parts), np.int64, len(parts))
        last = np.cumsum(marks + 1) - 1
        follows = np.ones(len(pieces), bool)
        follows[last] = False
        between = [self.special[s] for cut in parts for s in cut[1::2]]
        ids = np.insert(ids, np.cumsum(counts)[follows], between)
        totals = np.add.reduceat(counts, last - marks) if len(texts) else counts
        return ids, totals + marks

    def _cut(self, text: str) -> list[str]:
        """Plain parts and special strings in turn, a plain part first and last."""
        out = [text]
        for s in self.special:
            if s in text:
                out = [x for i, part in enumerate(out) for x in ([part] if i % 2 else _interleaved(part.split(s), s))]
        return out


def _interleaved(parts: list[str], mark: str) -> Iterator[str]:
    for i, part in enumerate(parts):
        if i:
            yield mark
        yield part
