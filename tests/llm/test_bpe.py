import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from syncspark.llm import bpe
from syncspark.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")
TEXT = st.one_of(
    st.text(max_size=40),
    st.text(alphabet="ab'stmdrelv 12\t\n .!é \u0085　½²", max_size=40),
    st.lists(st.sampled_from(["the", " the", "'s", "'ll", "<|endoftext|>", "  ", "\n\n", "über", "12", "é", "😀", "'"]), max_size=12).map("".join),
)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, max_size=5))
def test_ids_of_the_library(texts):
    library = tokenizers.Tokenizer.from_file(vocabulary_path()) if not hasattr(test_ids_of_the_library, "own") else test_ids_of_the_library.own
    test_ids_of_the_library.own = library
    ids, counts = bpe._encoder(vocabulary_path()).block(texts)
    ends = np.cumsum(counts).astype(int)
    got = [ids[e - c : e].tolist() for e, c in zip(ends, counts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [15, 16, 17, 1024, 4096])
def test_words_that_polynomials_confuse(library, n):
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
    texts = [word, word.translate(str.maketrans("ab", "ba")), "\x00" * n, "\x00" * (n - 1), "é" * n]
    ids, counts = bpe._encoder(vocabulary_path()).block(texts)
    ends = np.cumsum(counts).astype(int)
    assert [ids[e - c : e].tolist() for e, c in zip(ends, counts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_cache_that_starts_again_changes_nothing():
    from syncspark.llm.pretokens import PieceEncoder

    own = bpe.vocabulary(vocabulary_path())
    small = PieceEncoder(own.encode_pieces, own.special, cache_pieces=3)
    texts = ["alpha beta gamma", "beta delta", "alpha alpha"] * 3
    for _ in range(3):
        assert small.block(texts)[0].tolist() == bpe._encoder(vocabulary_path()).block(texts)[0].tolist()


def test_round_trip_of_hard_documents(hard_docs, local_rows, library):
    rows = local_rows(bpe.round_trip(hard_docs, vocabulary_path()))
    expected = []
    for r in hard_docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r.values())) for r in rows)


def test_encode_then_decode(hard_docs, local_rows):
    encoded = bpe.encode(hard_docs, vocabulary_path())
    back = local_rows(bpe.decode(encoded, vocabulary_path()))
    expected = [(r.doc_id, r.text or "") for r in hard_docs.select("doc_id", "text").collect()]
    assert sorted(map(repr, expected)) == sorted(repr((r["doc_id"], r["text"])) for r in back)


def test_empty_table(no_docs):
    assert bpe.round_trip(no_docs, vocabulary_path()).count() == 0
    assert bpe.encode(no_docs, vocabulary_path()).count() == 0


def test_broken_bytes_become_replacement_signs():
    own = bpe.vocabulary(vocabulary_path())
    ids = own.encode_pieces(["é"])[0]
    half = [own.byte_ids[0xC3]]
    assert own.decode(np.array(ids)).tobytes().decode() == "é"
    assert own.decode(np.array(half)).tobytes().decode("utf-8", "replace") == "�"
