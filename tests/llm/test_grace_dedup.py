import hashlib
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from syncspark.llm.grace_dedup import TextTable, exact_duplicates, grace_groups


def expected(docs):
    groups = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")].append(r.doc_id)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out.extend((i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("budget", [48 << 20, 300])
def test_hard_documents_also_when_every_table_spills(hard_docs, local_rows, budget):
    rows = local_rows(exact_duplicates(hard_docs, table_bytes=budget))
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows), key=repr) == expected(hard_docs)
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in rows}) == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_empty_table(no_docs):
    assert exact_duplicates(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.binary(max_size=3)), max_size=60), st.sampled_from([0, 400, 10_000]))
def test_spilled_groups_equal_grouping(pairs, budget):
    """Hashes that collide do not join different texts."""
    records = [(h, text, (i, 0, 0), 1, i) for i, (h, text) in enumerate(pairs)]
    # One text has one hash.
    hashes = {}
    records = [(hashes.setdefault(text, h), text, *rest) for h, text, *rest in records]
    got = {text: (first, size, sorted(keys)) for text, first, size, keys in grace_groups(iter(records), budget)}
    want = defaultdict(list)
    for i, (_, text) in enumerate(pairs):
        want[text].append(i)
    assert got == {t: ((k[0], 0, 0), len(k), k) for t, k in want.items()}


def test_table_grows_and_finds():
    table = TextTable()
    entries = [table.add(i % 7, str(i).encode()) for i in range(2000)]
    assert entries == list(range(2000)) == [table.find(i % 7, str(i).encode()) for i in range(2000)]
    assert table.find(3, b"missing") == -1


def test_a_third_of_all_rows_leaves_each_task_once(spark, local_rows):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same  text', concat('text ', id)) AS text").repartition(5)
    rows = local_rows(exact_duplicates(docs))
    hot = [r for r in rows if r["group_size"] == 1000]
    assert len(rows) == 3000 and len(hot) == 1000 and {r["keep_id"] for r in hot} == {0} and sum(r["kept"] for r in hot) == 1
