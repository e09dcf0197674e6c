import zlib

from syncspark.llm import language

SETTINGS = language.Settings(bits=12, sample=60, epochs=4)
WORDS = {
    "en": "the house and this water with that when they were going through",
    "de": "das haus und dieses wasser mit welchem wenn sie gegangen durch nicht",
    "fr": "la maison et cette eau avec celle quand ils étaient allés pour",
    "es": "la casa y esta agua con aquella cuando ellos estaban yendo para",
    "fi": "talo ja tämä vesi jonka kanssa silloin menivät läpi kaikki hyvin",
}


def corpus(spark, n=600):
    rows = []
    names = list(WORDS)
    for i in range(n):
        lang = names[i % len(names)]
        words = WORDS[lang].split()
        text = " ".join(words[(i * 7 + k * k) % len(words)] for k in range(12 + i % 9))
        wrong = zlib.crc32(str(i).encode()) % 4 == 2
        rows.append((i, text, "en" if wrong else (lang if i % 50 else None), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")


def test_held_out_accuracy_and_contract(spark, local_rows):
    data = corpus(spark)
    truth = {r.doc_id: r.truth for r in data.collect()}
    rows = local_rows(language.identify(data, SETTINGS))
    assert len(rows) == 600
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["lang_pred"] in WORDS and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_levels_of_the_model():
    texts = [t for t in WORDS.values() for _ in range(10)]
    model = language.train(texts, [x for x in WORDS for _ in range(10)], SETTINGS)
    assert sorted(model.families) == [("de", "en"), ("es", "fr"), ("fi",)]
    assert len(model.pairs) == 2 and model.columns.shape[1] == 5
    assert language.predict(list(WORDS.values()), model)[0] == list(WORDS)


def test_families():
    assert language.family_of("de-AT") == language.family_of("EN") == "Germanic"
    assert language.family_of("xx") == "xx"


def test_hard_documents(hard_docs, no_docs, local_rows):
    rows = local_rows(language.identify(hard_docs, SETTINGS))
    texts = {r.doc_id: r.text for r in hard_docs.select("doc_id", "text").collect()}
    assert len(rows) == hard_docs.count()
    for r in rows:
        text = texts[r["doc_id"]]
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (text is None or not any(c.isalpha() for c in text))
            assert (r["score"] == 0) == (r["lang_pred"] == "und")
        else:
            assert not r["held_out"]
    assert language.identify(no_docs, SETTINGS).count() == 0


def test_without_languages_all_is_undetermined(spark, local_rows):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in local_rows(language.identify(docs, SETTINGS))} == {("und", 0.0)}


def test_predictions_by_hand():
    """Families and duels of a model in plain loops."""
    import math

    from syncspark.llm.ngrams import Features

    texts = [t for t in WORDS.values() for _ in range(10)]
    model = language.train(texts, [x for x in WORDS for _ in range(10)], SETTINGS)
    asked = ["the maison und agua talo", "die Wasser were casa esta", "jonka with ils yendo", "x", "", "12 34"]
    chance = lambda margin: 1 / (1 + math.exp(-2 * margin))
    expected = []
    for text, (feature, share) in zip(asked, Features(asked, SETTINGS.bits, SETTINGS.sizes).counts()):
        margins = [sum(float(s) * float(model.columns[f, c]) for f, s in zip(feature, share)) + model.bias[c] for c in range(model.columns.shape[1])]
        own = max(range(len(model.families)), key=lambda k: margins[k])
        duels = {(a, b): chance(margins[len(model.families) + c]) for c, (k, a, b) in enumerate(model.pairs) if k == own}
        best = 0 if all(p >= 0.5 for (a, _), p in duels.items() if a == 0) else 1
        worst = min([p if a == best else 1 - p for (a, b), p in duels.items() if best in (a, b)], default=1.0)
        seen = any(c.isalpha() for c in text)
        expected.append((model.families[own][best], chance(margins[own]) * worst) if seen else ("und", 0.0))
    names, scores = language.predict(asked, model)
    assert names == [n for n, _ in expected]
    assert all(abs(s - t) < 1e-4 for s, (_, t) in zip(scores, expected))


def test_dirty_languages_stay_bounded(spark):
    """Thousands of values of ``lang``: the most frequent ones are learned from, within all signs allowed."""
    from pyspark.sql import functions as F

    from syncspark.llm.ngrams import bounded_sample

    rows = [(i, "w" * 100, ["en", "de", f"noise {i}"][i % 3]) for i in range(6000)]
    data = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    chosen = bounded_sample(data, "lang", "doc_id", 200, 2).groupBy("lang").count().collect()
    assert {r["lang"] for r in chosen} == {"de", "en"} and all(140 <= r["count"] <= 260 for r in chosen)
    chosen = bounded_sample(data, "lang", "doc_id", 1000, 2, F.length("text"), 40_000).groupBy("lang").count().collect()
    assert all(140 <= r["count"] <= 260 for r in chosen)
