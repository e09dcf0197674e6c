"""Quality classifier: vectors of hashed words and character n-grams, averaged, then softmax.

The vectors and the output layer are learned with stochastic gradient descent
on a bounded sample of labelled documents. As the softmax is taken of a linear
function of the mean vector, a learned vector enters a score only through its
products with the output rows: those products are the table used for scoring.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from syncspark.llm.bpe import _texts
from syncspark.llm.ngrams import Features, bounded_sample, remainder
from syncspark.llm.text import blocks, utf8

KEEP_FROM = 0.3


@dataclass(frozen=True)
class Settings:
    """About ``sample`` labelled documents of each class are learned from, of texts up to ``sample_chars`` signs."""

    bits: int = 17
    dimension: int = 8
    sizes: tuple[int, ...] = (3, 4, 5)
    sample: int = 1500
    sample_chars: int = 200_000
    epochs: int = 12
    rate: float = 1.0
    seed: int = 7


@dataclass(frozen=True)
class SubwordModel:
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    sizes: tuple[int, ...]

    def table(self) -> np.ndarray:
        """Products of each feature's vector with each output row."""
        return (self.vectors @ self.output.T).astype(np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(texts: Sequence[str], labels: Sequence[int], classes: int, settings: Settings = Settings()) -> SubwordModel:
    """Learn from texts whose labels are below ``classes``; without texts all classes are equally likely."""
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1, 1, (1 << settings.bits, settings.dimension)).astype(np.float32) / settings.dimension
    output = np.zeros((classes, settings.dimension), np.float32)
    bias = np.zeros(classes, np.float32)
    documents = []
    step = 200
    for i in range(0, len(texts), step):
        documents.extend(Features(texts[i : i + step], settings.bits, settings.sizes, repeats=True).counts())
    known = [i for i, (feature, _) in enumerate(documents) if len(feature)]
    total = max(1, settings.epochs * len(known))
    for turn, i in enumerate(np.concatenate([random.permutation(known) for _ in range(settings.epochs)]) if known else ()):
        feature, share = documents[i]
        rate = settings.rate * (1 - turn / total)
        hidden = share @ vectors[feature]
        error = _softmax(output @ hidden + bias)
        error[labels[i]] -= 1
        back = error @ output
        output -= rate * np.outer(error, hidden)
        bias -= 0.1 * rate * error
        # A step of the mean vector, whatever the number of features.
        vectors[feature] -= rate * np.outer(share / (share @ share), back)
    return SubwordModel(vectors, output, bias, settings.sizes)


def score(docs: DataFrame, model: SubwordModel, bits: int) -> DataFrame:
    """``docs`` with ``_scores``, the probabilities of all classes for the whole ``text``; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast((model.table(), model.bias, model.sizes, bits))
    names = [*docs.columns, "_scores"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias, sizes, width = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in blocks(offsets):
                means = Features(_texts(data, offsets, a, b), width, sizes, repeats=True).means(table)
                probabilities = _softmax(means + bias)
                cut = pa.array(np.arange(0, probabilities.size + 1, probabilities.shape[1]), pa.int32())
                scores = pa.ListArray.from_arrays(cut, pa.array(probabilities.ravel(), pa.float64()))
                yield pa.record_batch([*batch.slice(a, b - a).columns, scores], names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_scores", T.ArrayType(T.DoubleType()))]))


def learned(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> SubwordModel:
    """Model of ``labels.quality`` (0 or 1; other values and null are left out) for texts of ``docs``.

    Only ids whose ``crc32(doc_id as text) mod 5`` is not 0 are learned from; an
    id with both labels counts as 0.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where((remainder("doc_id", 5) != 0) & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = bounded_sample(known, "quality", "doc_id", settings.sample, 2)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most four samples of ids: small enough to broadcast whatever the size of the corpus.
    rows = source.where(F.length("text") <= settings.sample_chars).join(F.broadcast(chosen), "doc_id").select("text", "quality").limit(4 * settings.sample).toPandas()
    rows = rows.sort_values(["quality", "text"], kind="stable")
    return train(rows["text"].tolist(), rows["quality"].tolist(), 2, settings)


def quality_scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), keep_from: float = KEEP_FROM) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Learned as :func:`learned` says; only the text enters a score. ``held_out``
    is ``crc32(doc_id as text) mod 5`` being 0, false for a null id. Null and empty texts get the score of no
    features; without any label every score is 0.5. Repeated rows give repeated
    rows, an empty table an empty result; other columns are not read.
    """
    model = learned(docs, labels, settings)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    value = F.col("_scores")[1]
    return score(source, model, settings.bits).select("doc_id", held_out.alias("held_out"), value.alias("score"), (value >= keep_from).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), keep_from: float = KEEP_FROM) -> DataFrame:
    """Rows of ``docs``, all columns, whose score is at least ``keep_from``."""
    scored = score(docs, learned(docs, labels, settings), settings.bits)
    return scored.where(F.col("_scores")[1] >= keep_from).select(*docs.columns)
