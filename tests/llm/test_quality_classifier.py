import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from syncspark.llm import quality
from syncspark.llm.ngrams import Features

SETTINGS = quality.Settings(bits=12, sample=60, epochs=4)


def test_features_by_hand():
    """Words, and n-grams inside a word that may hold the white space around it."""
    texts = ["ab c", "", "abcd\n ab"]
    features = Features(texts, 20, (3,))
    name = {}
    for text, (feature, share) in zip(texts, features.counts()):
        padded = "\n" + text + "\n"
        grams = [g for g in (padded[i : i + 3].replace("\n", " ") for i in range(len(padded) - 2)) if g[1] != " "]
        own = text.split() + [f"gram {g}" for g in grams]
        assert round(sum(share) * max(1, len(own))) == len(own) and len(feature) == len(set(own))
        for f, s in zip(feature.tolist(), share.tolist()):
            name.setdefault(f, set()).add(round(s * len(own)))
    table = np.random.default_rng(0).normal(size=(1 << 20, 2)).astype(np.float32)
    means = features.means(table)
    for row, (feature, share) in enumerate(features.counts()):
        assert np.allclose(means[row], share @ table[feature] if len(feature) else 0, atol=1e-5)


def test_repeated_words_count_as_one_common_word():
    texts = ["a b b c", "b a", "a d d d"]
    plain, marked = (Features(texts, 20, (3,), repeats=r).words() for r in (False, True))
    assert len(marked[0]) == len(plain[0]) + 3 and marked[1][len(plain[0]) :].tolist() == [0, 2, 2]
    assert len(set(marked[0][len(plain[0]) :].tolist())) == 1


def corpus(spark, n=400):
    good = ["the meadow was calm", "a letter arrived late", "they walked along the shore", "music filled the hall"]
    rows = []
    for i in range(n):
        words = " ".join(good[(i + k) % 4] for k in range(3 + i % 5))
        rows.append((i, words if i % 3 else words.replace(" ", "$$$ %%% ").upper(), int(i % 3 > 0)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_held_out_accuracy_and_contract(spark, local_rows):
    data = corpus(spark)
    labels = data.select("doc_id", "quality")
    # Wrong labels of held-out rows must not matter.
    labels = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    rows = local_rows(quality.quality_scores(data, labels, SETTINGS))
    assert len(rows) == 400
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"]]
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 3 > 0) for r in held) >= 0.95 * len(held)


def test_same_rows_give_the_same_model(spark, local_rows):
    data = corpus(spark, 120)
    first, second = (sorted(map(tuple, quality.quality_scores(data.repartition(n), data, SETTINGS).collect())) for n in (2, 5))
    assert first == second


def test_hard_documents(spark, hard_docs, no_docs, local_rows):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (None, 1), (5, 7), (8, 0), (8, 1), (11, 1)], "doc_id long, quality int")
    rows = local_rows(quality.quality_scores(hard_docs, labels, SETTINGS))
    assert len(rows) == hard_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(not r["held_out"] for r in rows if r["doc_id"] is None)
    assert quality.quality_scores(no_docs, labels, SETTINGS).count() == 0
    kept = quality.good_documents(hard_docs, labels, SETTINGS)
    assert kept.columns == hard_docs.columns and kept.count() == sum(r["predicted"] for r in rows)


def test_without_labels_nothing_is_known(spark, hard_docs, local_rows):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = local_rows(quality.quality_scores(hard_docs, none, SETTINGS))
    assert {r["score"] for r in rows} == {0.5} and {r["predicted"] for r in rows} == {1}


@pytest.mark.parametrize("classes", [2, 3])
def test_softmax_of_more_classes(classes):
    texts = [w * 3 for w in ("alpha ", "beta ", "gamma ")[:classes]] * 20
    labels = list(range(classes)) * 20
    model = quality.train(texts, labels, classes, SETTINGS)
    means = Features(texts[:classes], SETTINGS.bits, SETTINGS.sizes, repeats=True).means(model.table()) + model.bias
    assert means.argmax(1).tolist() == list(range(classes))


def test_scores_by_hand(spark, local_rows):
    """Mean vector, output and softmax in plain loops."""
    import math

    texts = ["the meadow was calm", "BUY $$$ now now now", "music filled the hall", "%%% CHEAP $$$"]
    model = quality.train(texts * 5, [1, 0, 1, 0] * 5, 2, SETTINGS)
    asked = ["calm music", "$$$ the hall", "", "now now"]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: r["_scores"] for r in local_rows(quality.score(docs, model, SETTINGS.bits))}
    for i, (feature, share) in enumerate(Features(asked, SETTINGS.bits, SETTINGS.sizes, repeats=True).counts()):
        mean = [sum(float(s) * float(model.vectors[f, d]) for f, s in zip(feature, share)) for d in range(model.vectors.shape[1])]
        logits = [sum(float(w) * m for w, m in zip(row, mean)) + float(b) for row, b in zip(model.output, model.bias)]
        top = [math.exp(x - max(logits)) for x in logits]
        assert all(abs(p - q / sum(top)) < 1e-4 for p, q in zip(found[i], top))
