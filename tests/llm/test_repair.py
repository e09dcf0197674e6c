import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from syncspark.llm import repair
from syncspark.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=300), st.integers(1, 4), st.integers(2, 6))
def test_rules_expand_to_what_was_there(ids, rounds, least):
    rules, symbols = repair.compress(np.array(ids, np.int64), 5, rounds, 8, least)
    assert repair.Grammar(rules, 5).expand(symbols).tolist() == ids
    assert all(a < 5 + i and b < 5 + i for i, (a, b) in enumerate(rules.tolist()))


def test_frequent_pairs_shrink_the_sequence():
    ids = np.array([1, 2, 3, 4] * 5000)
    rules, symbols = repair.compress(ids, 50_000, rounds=4)
    assert len(symbols) <= len(ids) // 8 and len(rules) >= 3


def test_long_passages_become_one_symbol():
    passage = np.arange(512)
    ids = np.concatenate([np.append(passage, 1000 + i) for i in range(40)])
    rules, symbols = repair.compress(ids, 2000)
    assert len(symbols) <= 80 and repair.Grammar(rules, 2000).rule_lengths.max() == 512
    assert repair.Grammar(rules, 2000).expand(symbols).tolist() == ids.tolist()


@pytest.mark.parametrize("first_new, width", [(200, 2), (65_000, 4), (70_000, 4)])
def test_no_frequent_pair_is_left(first_new, width):
    """Also beyond 16 bits, and where pairs share a slot."""
    random = np.random.default_rng(3)
    ids = np.minimum(random.geometric(0.03, 400_000), 199)
    rules, symbols = repair.compress(ids, first_new)
    _, counts = np.unique(symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:], return_counts=True)
    assert counts.max() < repair.LEAST_COUNT and symbols.itemsize == rules.itemsize == width
    assert (repair.Grammar(rules, first_new).expand(symbols) == ids).all()


@pytest.mark.parametrize("first_new", [300, 70_000])
def test_any_stretch_of_a_shard(first_new):
    random = np.random.default_rng(1)
    ids = random.integers(0, 20, 50_000)
    counts = np.array([0, 7, 49_993], np.int64)
    shard = repair.Shard(repair.write_shard(ids, counts, first_new))
    assert shard.counts.tolist() == counts.tolist() and shard.n_ids == len(ids)
    for a, b in [(0, 0), (0, 1), (0, 50_000), (4095, 4097), (12_345, 45_678), (49_999, 50_000)]:
        assert shard.ids(a, b).tolist() == ids[a:b].tolist()


def test_a_file_of_another_kind_is_refused():
    with pytest.raises(ValueError, match="shard"):
        repair.Shard(b"x" * 200)


@pytest.mark.parametrize("shard_ids", [1 << 20, 40])
def test_hard_documents(hard_docs, local_rows, shard_ids):
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    rows = local_rows(repair.written_and_read(hard_docs, vocabulary_path(), shard_ids=shard_ids))
    assert len(rows) == hard_docs.count()
    rows.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    assert [r["start"] for r in rows] == (np.cumsum([r["n_tokens"] for r in rows]) - [r["n_tokens"] for r in rows]).tolist()
    expected = []
    for r in hard_docs.select("doc_id", "text").collect():
        own = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        expected.append((r.doc_id, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert sorted(map(repr, expected)) == sorted(repr((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in rows)


def test_ids_read_back(spark, local_rows):
    docs = spark.createDataFrame([(2, "two words"), (1, "one"), (3, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r["ids"] for r in local_rows(repair.read_ids(repair.write_ids(docs, vocabulary_path())))}
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    assert rows == {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in [(1, "one"), (2, "two words"), (3, "")]}


def test_words_that_polynomials_confuse_and_rows_of_one_id(spark, local_rows):
    words = ["".join("ab"[bin(i).count("1") & 1] for i in range(n)) for n in (1024, 4096)]
    texts = [t for w in words for t in (w, w.translate(str.maketrans("ab", "ba")))]
    docs = spark.createDataFrame([(1, t) for t in texts] + [(None, t) for t in texts], "doc_id long, text string")
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    rows = local_rows(repair.written_and_read(docs, vocabulary_path()))
    own = [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert sorted(r["ids_crc32"] for r in rows) == sorted(2 * [zlib.crc32(np.array(i, "<u4").tobytes()) for i in own])


def test_a_shard_of_other_ids_fails(spark):
    shards = repair.write_ids(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), vocabulary_path())
    batch = shards.toArrow().to_batches()[0]
    broken = batch.set_column(batch.schema.get_field_index("crc32"), "crc32", batch.column("doc_ids").flatten())
    assert len(list(repair._digests(iter([batch])))) == 1
    with pytest.raises(ValueError, match="does not hold"):
        list(repair._digests(iter([broken])))


def test_empty_table(no_docs):
    assert repair.written_and_read(no_docs, vocabulary_path()).count() == 0
