"""Language identification in two levels: the family first, then the language in it.

Linear support vector machines over hashed words and character n-grams, learned
by stochastic gradient descent: one against the rest for families, one against
one for the languages of a family.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from syncspark.llm.bpe import _texts
from syncspark.llm.ngrams import Features, bounded_sample, remainder
from syncspark.llm.text import blocks, utf8

UNDETERMINED = "und"
# Families of closely related languages by code; a language not listed is a family of its own.
FAMILIES = {
    "Germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "Romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "Slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "Baltic": ("lt", "lv"),
    "Finnic": ("fi", "et"),
    "Turkic": ("tr", "az", "kk"),
    "Iranian": ("fa", "ku"),
    "Indic": ("hi", "bn", "ur", "mr", "pa"),
}
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Settings:
    """``sample`` documents of each of the ``languages`` most frequent languages are learned from.

    Texts have up to ``sample_chars`` signs, all of them together about ``total_chars``.
    """

    bits: int = 16
    sizes: tuple[int, ...] = (3, 4)
    sample: int = 800
    sample_chars: int = 200_000
    languages: int = 128
    total_chars: int = 100_000_000
    epochs: int = 5
    penalty: float = 1e-4
    seed: int = 11


@dataclass(frozen=True)
class LanguageModel:
    """``columns``: weights of the families and then of each pair of languages of a family."""

    families: tuple[tuple[str, ...], ...]
    pairs: tuple[tuple[int, int, int], ...]
    columns: np.ndarray
    bias: np.ndarray
    settings: Settings


def family_of(language: str, families: dict[str, tuple[str, ...]] = FAMILIES) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in families.items() if code in codes), language)


def _machine(documents: list, signs: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias of one machine: hinge loss with a squared penalty, averaged over the last half."""
    weights = np.zeros(1 << settings.bits, np.float64)
    mean, bias, bias_mean, used, scale = np.zeros_like(weights), 0.0, 0.0, 0, 1.0
    random = np.random.default_rng(settings.seed)
    total, turn = settings.epochs * len(documents), 0
    sides = [np.flatnonzero(signs > 0), np.flatnonzero(signs < 0)]
    for _ in range(settings.epochs):
        # Both sides weigh the same, however many documents they have.
        half = len(documents) // 2 + 1
        order = np.stack([random.choice(s, half) for s in sides], 1).ravel()
        for i in order:
            feature, share = documents[i]
            rate = 1.0 / (1 + 4 * turn / total)
            turn += 1
            scale *= 1 - rate * settings.penalty
            margin = signs[i] * (scale * (share @ weights[feature]) + bias)
            if margin < 1:
                step = rate * signs[i] * min(1.0, (1 - margin))
                weights[feature] += step / scale * (share / (share @ share))
                bias += 0.05 * step
        mean += scale * weights
        bias_mean += bias
        used += 1
    return (mean / used), bias_mean / used


def train(texts: Sequence[str], languages: Sequence[str], settings: Settings = Settings(), families: dict[str, tuple[str, ...]] = FAMILIES) -> LanguageModel:
    documents = []
    for i in range(0, len(texts), 200):
        documents.extend(Features(texts[i : i + 200], settings.bits, settings.sizes).counts())
    known = [i for i, (feature, _) in enumerate(documents) if len(feature)]
    names = np.array([languages[i] for i in known], object)
    documents = [documents[i] for i in known]
    groups: dict[str, list[str]] = {}
    for language in sorted(set(names)):
        groups.setdefault(family_of(language, families), []).append(language)
    kinds = tuple(tuple(g) for g in groups.values())
    columns, bias, pairs = [], [], []
    for group in kinds:
        if len(kinds) == 1:
            columns.append(np.zeros(1 << settings.bits))
            bias.append(1.0)
            continue
        w, b = _machine(documents, np.where(np.isin(names, group), 1.0, -1.0), settings)
        columns.append(w)
        bias.append(b)
    for k, group in enumerate(kinds):
        for a, b in combinations(range(len(group)), 2):
            some = [i for i, x in enumerate(names) if x in (group[a], group[b])]
            w, c = _machine([documents[i] for i in some], np.where(names[some] == group[a], 1.0, -1.0), settings)
            columns.append(w)
            bias.append(c)
            pairs.append((k, a, b))
    table = np.stack(columns, 1).astype(np.float32) if columns else np.zeros((1 << settings.bits, 0), np.float32)
    return LanguageModel(kinds, tuple(pairs), table, np.array(bias), settings)


def predict(texts: Sequence[str], model: LanguageModel) -> tuple[list[str], list[float]]:
    """Language and score (0 to 1) of each text; texts without a letter are undetermined with score 0."""
    lettered = [bool(_LETTER.search(t)) for t in texts]
    if not model.families:
        return [UNDETERMINED] * len(texts), [0.0] * len(texts)
    settings = model.settings
    margins = Features(texts, settings.bits, settings.sizes).means(model.columns) + model.bias
    n_families = len(model.families)
    family = margins[:, :n_families].argmax(1)
    sure = 1 / (1 + np.exp(-2 * np.clip(margins[np.arange(len(texts)), family], -30, 30)))
    wins = [np.zeros((len(texts), len(g))) for g in model.families]
    for column, (k, a, b) in enumerate(model.pairs, n_families):
        chance = 1 / (1 + np.exp(-2 * np.clip(margins[:, column], -30, 30)))
        # A won duel counts one, the chance decides between equal numbers.
        wins[k][:, a] += (chance >= 0.5) + 0.01 * chance
        wins[k][:, b] += (chance < 0.5) + 0.01 * (1 - chance)
    best = [w.argmax(1) for w in wins]
    worst = np.ones(len(texts))
    for column, (k, a, b) in enumerate(model.pairs, n_families):
        chance = 1 / (1 + np.exp(-2 * np.clip(margins[:, column], -30, 30)))
        for mine, value in ((a, chance), (b, 1 - chance)):
            at = (family == k) & (best[k] == mine)
            worst[at] = np.minimum(worst[at], value[at])
    names, scores = [], []
    for i, seen in enumerate(lettered):
        k = family[i]
        names.append(model.families[k][best[k][i]] if seen else UNDETERMINED)
        scores.append(float(sure[i] * worst[i]) if seen else 0.0)
    return names, scores


def identify(docs: DataFrame, settings: Settings = Settings(), families: dict[str, tuple[str, ...]] = FAMILIES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score``.

    Learned from texts and languages (of a bounded sample, see :class:`Settings`) of rows with a language whose
    ``crc32(doc_id as text) mod 4`` is not 2; only the text enters a prediction.
    ``held_out`` is that remainder being 2, false for a null id. Null texts and
    texts without a letter are ``und`` with score 0, as is everything if no row
    can be learned from. Repeated rows give repeated rows, an empty table an
    empty result; other columns are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where((remainder("doc_id", 4) != 2) & F.col("lang").isNotNull())
    usable = known.where(F.length("text").between(1, settings.sample_chars))
    learned = bounded_sample(usable, "lang", "doc_id", settings.sample, settings.languages, F.length("text"), settings.total_chars).select("lang", "text").toPandas().sort_values(["lang", "text"], kind="stable")
    model = train(learned["text"].tolist(), learned["lang"].tolist(), settings, families)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in blocks(offsets):
                names, scores = predict(_texts(data, offsets, a, b), shared.value)
                yield pa.record_batch([batch.column("doc_id")[a:b], pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    predicted = source.mapInArrow(run, "doc_id long, lang_pred string, score double")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
