import random

import pytest

from syncspark.llm import templates

WORDS = [a + b + c for a in "bdfgk" for b in "aeiou" for c in "lmnr"]


def left(docs, **settings):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in templates.drop_templates(docs, **settings).collect()}


def brute_force(rows, depth, similarity, least_docs, cohesion=0.5):
    """The same templates over local lines."""
    import math
    import re
    from collections import defaultdict

    tokens = lambda line: ["<*>" if re.search("[0-9]", t) else t for t in re.findall(r"[^\x20\x09-\x0D]+", line)]
    whole, leaves = defaultdict(list), defaultdict(list)
    for n, (_, text) in enumerate(rows):
        for at, line in enumerate((text or "").split("\n")):
            if t := tokens(line):
                whole[tuple(t)].append((n, at))
    dropped = [set() for _ in rows]

    def drop(places):
        for n, at in places:
            dropped[n].add(at)

    for t, places in whole.items():
        if len({n for n, _ in places}) >= least_docs:
            drop(places)
        else:
            leaves[len(t), t[:depth]] += [(n, at, t) for n, at in places]
    for own in leaves.values():
        docs = defaultdict(set)
        for n, _, t in own:
            for place in range(depth, len(t)):
                docs[place, t[place]].add(n)
        docs = {k: len(v) for k, v in docs.items() if len(v) >= least_docs}
        named = defaultdict(list)
        for n, at, t in own:
            known = [(place, t[place]) for place in range(depth, len(t)) if (place, t[place]) in docs]
            need = max(2, math.ceil(similarity * (len(t) - depth)))
            if len(known) >= need:
                bar = sorted((docs[k] for k in known), reverse=True)[need - 1]
                named[tuple(k for k in known if 2 * docs[k] >= bar)].append((n, at))
        for skeleton, places in named.items():
            found = len({n for n, _ in places})
            if found >= least_docs and found >= cohesion * min(docs[k] for k in skeleton):
                drop(places)
    out = {}
    for (doc_id, text), gone in zip(rows, dropped):
        lines = (text or "").split("\n")
        out[doc_id] = (len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def corpus():
    draw = random.Random(3)
    rows = []
    for i in range(60):
        lines = [f"Session {i} of user u{i % 7} opened at 10:{i:02d}", f"own line of text number {'abcdefgh'[i % 8]}{'xyz'[i % 3]}", ""]
        if i % 2:
            lines.insert(1, "  All rights reserved.")
        if i % 5 == 0:
            lines.append("the quick fox " + " ".join("pqrstu"[(i + k) % 6] * (1 + k % 2) for k in range(6)))
        if i % 4 == 0:
            lines.append("common words stay the same but " + "mnop"[i // 4 % 4])
        lines.append("a mixed line " + " ".join(draw.choice("ab") + draw.choice("xyz") for _ in range(4)))
        lines.append(f"a mixed line {draw.choice(WORDS)} said the {draw.choice(WORDS[:9])}")
        lines.append(f"a mixed line from the {draw.choice(WORDS)} {draw.choice(WORDS)}")
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("settings", [dict(depth=3, similarity=0.5, least_docs=5), dict(depth=1, similarity=0.8, least_docs=3), dict(depth=2, similarity=1.0, least_docs=9), dict(depth=1, similarity=0.3, cohesion=0.2, least_docs=3)])
def test_lines_of_brute_force(spark, settings):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert left(docs, **settings) == brute_force(rows, **settings)


def test_variable_fields_share_a_template(spark):
    rows = [(i, f"request {i} took {i * 3}ms on host h{i}\nkeep me {'abcdefghij'[i]}") for i in range(10)]
    found = left(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(found[i] == (2, 1, f"keep me {'abcdefghij'[i]}") for i in range(10))


def test_several_templates_of_one_leaf(spark):
    """Three templates of a third each, with two fields of words."""
    kinds = ["This page was written by {} on a {} morning", "This page was removed from {} for a {} reason", "This page was seen near {} under some {} tree"]
    rows = [(i, kinds[i % 3].format(WORDS[i % 89], WORDS[(7 * i + 1) % 97]) + f"\nown {WORDS[i % 100]} {WORDS[i // 3]}") for i in range(240)]
    found = left(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(found[i] == (2, 1, text.split("\n")[1]) for i, text in rows)


def test_frequent_words_are_no_template(spark):
    """Lines of independent words of one leaf: each word recurs often, no fixed tokens come together."""
    draw = random.Random(5)
    rows = [(i, "It is the " + " ".join(draw.choice(WORDS[:12]) for _ in range(9))) for i in range(400)]
    found = left(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(n for _, n, _ in found.values()) == 0


def test_templates_are_found_at_any_size(spark):
    """The share of dropped lines does not fall as a leaf grows and its fields repeat."""
    for size in (60, 600, 3000):
        rows = [(i, f"Posted by user {WORDS[i % 50]} in group {WORDS[i * i % 97]} at night") for i in range(size)]
        found = left(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
        assert all(n == 1 for _, n, _ in found.values())


def test_copies_in_one_document_count_once(spark):
    """A field that one document repeats is not fixed for that."""
    rows = [(i, f"Read more about {WORDS[i]} in our archive") for i in range(30)]
    rows.append((30, "\n".join(["Read more about nothing in our archive"] * 500)))
    found = left(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(n_lines == n for n_lines, n, _ in found.values())


def test_repeats_inside_one_document_are_not_recurring(spark):
    found = left(spark.createDataFrame([(1, "same line here\n" * 30)], "doc_id long, text string"))
    assert found[1][1] == 0


def test_hard_documents(hard_docs, no_docs):
    found = templates.drop_templates(hard_docs, least_docs=2).collect()
    assert len(found) == hard_docs.count()
    assert {(r.n_lines, r.n_dropped, r.text) for r in found if r.doc_id in (2, 3)} == {(1, 0, "")}
    assert all(r.n_dropped == 1 and r.text == "" for r in found if r.doc_id in (7, 8, 9))
    assert templates.drop_templates(no_docs).count() == 0


def test_no_python_in_the_plans(spark, monkeypatch):
    """Everything staged on the way and the result are DataFrame functions only."""
    plans = []
    real = templates.stage

    def seen(df, *args, **named):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *args, **named)

    monkeypatch.setattr(templates, "stage", seen)
    templates.drop_templates(spark.createDataFrame(corpus(), "doc_id long, text string")).count()
    assert len(plans) == 9 and not any(word in p for p in plans for word in ("Python", "Arrow", "Pandas"))
