import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from syncspark.llm.text import Rolling, blocks, ranges, shingle_sets, slice_hashes, utf8, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\né😀", max_size=12)), max_size=8)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern_and_never_cross_texts(texts):
    data, offsets = utf8(pa.array(texts, pa.string()))
    starts, ends, rows = words(data, offsets)
    got = [(int(r), data[a:b].tobytes()) for a, b, r in zip(starts, ends, rows)]
    expected = [(i, w) for i, t in enumerate(texts) for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())]
    assert got == expected


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=30), st.integers(1, 200))
def test_blocks_cover_all_rows_in_order(sizes, limit):
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    found = list(blocks(offsets, limit))
    assert [x for a, b in found for x in range(a, b)] == list(range(len(sizes)))
    assert all(offsets[b] - offsets[a] <= limit or b == a + 1 for a, b in found)


def test_slices_hash_by_content_alone():
    data = np.frombuffer(b"abcabcab", np.uint8)
    rolling = Rolling(data)
    a, b, c = rolling.slices(np.array([0, 3, 1]), np.array([3, 6, 4]))
    assert a == b != c
    windows = rolling.windows(3)
    assert windows[0] == windows[3] and len(set(windows.tolist())) == 3


def test_sliced_arrays_keep_their_own_bytes():
    data, offsets = utf8(pa.array(["ab", None, "cde", "f"]).slice(1, 2))
    assert data.tobytes() == b"cde" and offsets.tolist() == [0, 0, 3]


def test_ranges_one_after_another():
    assert ranges(np.array([5, 0]), np.array([2, 3])).tolist() == [5, 6, 0, 1, 2]


def thue_morse(n):
    """A word of two letters and its complement, which many polynomial hashes cannot tell apart."""
    word = np.array([bin(i).count("1") & 1 for i in range(n)], np.uint8)
    return (word + 97).tobytes(), (98 - word).tobytes()


def test_slice_hashes_by_content_alone():
    random = np.random.default_rng(1)
    slices = [bytes(random.integers(97, 100, n, np.uint8)) for n in (0, 1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 200) for _ in range(6)]
    slices += [b"\x00" * n for n in range(20)] + [w for n in (32, 1024, 4096, 1 << 16) for w in thue_morse(n)]
    slices += slices[::-1]
    ends = np.cumsum([len(s) for s in slices])
    hashes = slice_hashes(np.frombuffer(b"".join(slices), np.uint8), np.append(0, ends[:-1]), ends)
    assert len({(s, int(h)) for s, h in zip(slices, hashes)}) == len(set(slices)) == len(set(hashes.tolist()))


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_shingles_of_the_words(texts):
    data, offsets = utf8(pa.array(texts, pa.string()))
    found = shingle_sets(data, offsets, 2)
    expected = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        expected.append({tuple(w[i : i + 2]) for i in range(len(w) - 1)} or ({tuple(w)} if w else set()))
    assert [len(s) for s in found] == [len(s) for s in expected]
    for i, a in enumerate(expected):
        for j, b in enumerate(expected):
            assert len(set(found[i].tolist()) & set(found[j].tolist())) == len(a & b)
