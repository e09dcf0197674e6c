"""Source divergence audit: how the word use of a source differs from other sources, and from its language.

Words are counted per language and source. A language keeps the words that
occur in enough of its documents; every group and every language gives each of
them a probability in billionths, and two probabilities differ by
``(p - q)^2 / q``. All arithmetic is on whole numbers.

Terms of a group: of two terms, the one with the higher count in the group, the
lower count in the language and the earlier name cannot rank behind the other.
So each partition drops the terms that ``ranks`` others dominate (the rest is
its skyband), partitions are merged, and only what is left is ranked.

Pairs of sources: a partition holds some terms of a language for all its
sources, and adds up the differences of all pairs over them at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from syncspark.llm.text import utf8
from syncspark.workspace import scratch, stage

BILLION = 1_000_000_000
# Small letters for capitals, blanks for all other signs of ASCII; bytes of other signs stay.
_TABLE = bytes(i + 32 if 0x41 <= i <= 0x5A else i if 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256))
# Bytes of a text that are split at once.
_SEGMENT = 1 << 21
# Differences that are held at once.
_CELLS = 1 << 21


@dataclass(frozen=True)
class Settings:
    """A term is kept from ``documents`` documents on, and reported up to ``ranks``; a partition has about ``rows`` counts, a task holds ``held`` terms."""

    documents: int = 3
    ranks: int = 200
    rows: int = 200_000
    held: int = 300_000


def _segments(raw: bytes) -> Iterator[list[bytes]]:
    """Words of a text, some after others."""
    plain, at = raw.translate(_TABLE), 0
    while at < len(plain):
        end = plain.find(b" ", at + _SEGMENT) if len(plain) - at > _SEGMENT else -1
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def _counted(settings: Settings):
    """``lang, source, term, n, docs`` of the rows a task sees, in parts; a row without term for each group."""

    def batch_of(found: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
        langs, sources, terms, n, docs = [], [], [], [], []
        for (lang, source), (counts, in_docs) in found.items():
            size = len(counts) + 1
            langs += [lang] * size
            sources += [source] * size
            terms += [None, *counts]
            n += [0, *counts.values()]
            docs += [0, *(in_docs[t] for t in counts)]
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip((langs, sources, terms, n, docs), kinds, strict=True)], ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            raw, cuts = memoryview(np.ascontiguousarray(data)), offsets.tolist()
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for i, group in enumerate(groups):
                if group not in found:
                    found[group] = Counter(), Counter()
                counts, in_docs = found[group]
                before, seen = len(counts), set()
                for words in _segments(bytes(raw[cuts[i] : cuts[i + 1]])):
                    counts.update(words)
                    seen.update(words)
                in_docs.update(seen)
                held += len(counts) - before
                if held > settings.held:
                    yield batch_of(found)
                    found, held = {}, 0
        yield batch_of(found)

    return run


def skyband(group_counts: np.ndarray, lang_counts: np.ndarray, names: pa.Array, k: int) -> np.ndarray:
    """Places of the terms that fewer than ``k`` others dominate.

    A term dominates another with a group count at least as high, a count in the
    language at most as high and an earlier name. Terms of equal counts are a
    cell; in the order of cells, dominators come first, and of a cell only an
    early part of its names can stay.
    """
    name = np.empty(len(names), np.int64)
    name[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
    order = np.lexsort((name, lang_counts, -group_counts))
    high, low, name = group_counts[order], lang_counts[order], name[order]
    cuts = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1]), [True]])) if len(order) else [0]
    # What is kept: counts in the language and names.
    lows, kept_names, places, used = np.empty(0, np.int64), np.empty(0, np.int64), [], 0
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        mine = name[a : min(b, a + k)]
        over = kept_names[:used][lows[:used] <= low[a]]
        if len(over) >= k:
            # No name behind the k-th one can stay.
            limit = np.partition(over, k - 1)[k - 1]
            mine = mine[: np.searchsorted(mine, limit, "right")]
        stays = np.searchsorted(np.sort(over), mine) + np.arange(len(mine)) < k
        n = int(stays.sum())
        if not n:
            continue
        if used + n > len(lows):
            lows, kept_names = (np.concatenate([x[:used], np.empty(used + n + 1024, np.int64)]) for x in (lows, kept_names))
        lows[used : used + n], kept_names[used : used + n] = low[a], mine[:n]
        places.append(order[a : a + n])
        used += n
    return np.concatenate(places) if places else np.zeros(0, np.int64)


def _skybands(k: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names = table.column("term").cast(pa.binary()).combine_chunks()
        names = names if isinstance(names, pa.Array) else pa.concat_arrays(names.chunks)
        n, m = (table.column(c).to_numpy() for c in ("n", "m"))
        return table.take(pa.array(skyband(n, m, names, k)))

    return run


def pair_sums(p: np.ndarray) -> np.ndarray:
    """Sums of ``floor((p - q)^2 / q)`` over the rows (terms) of every pair of columns (groups): p of the first, q of the second."""
    terms, groups = p.shape
    out = np.zeros((groups, groups), np.int64)
    step = max(1, _CELLS // max(1, groups))
    for a in range(0, terms, step):
        some = p[a : a + step]
        for g in range(groups):
            gap = some[:, g, None] - some
            out[g] += (gap * gap // some).sum(0)
    return out


def _pair_sums(shared):
    """Sums of a partition's terms, for each group of the language over all its groups in the order of their names."""

    def run(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        sources, base = shared.value[lang]
        term = table.column("term").combine_chunks().dictionary_encode()
        term = term.combine_chunks() if isinstance(term, pa.ChunkedArray) else term
        number = {s: i for i, s in enumerate(sources)}
        column = np.array([number[s] for s in table.column("source").to_pylist()], np.int64)
        p = np.tile(np.array(base, np.int64), (len(term.dictionary), 1))
        p[term.indices.to_numpy(zero_copy_only=False), column] = table.column("p").to_numpy()
        sums = pair_sums(p)
        return pa.table({"lang": pa.array([lang] * len(sources), pa.string()), "source": pa.array(sources, pa.string()), "sums": pa.array(sums.tolist(), pa.list_(pa.int64()))})

    return run


def _share(count: str, total: str) -> F.Column:
    """A probability in billionths, from 1."""
    return F.expr(f"1L + (CAST({BILLION} AS DECIMAL(20,0)) * CAST({count} + 1 AS DECIMAL(18,0))) div CAST({total} AS DECIMAL(19,0))")


def _difference(p: str, q: str) -> F.Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", settings: Settings = Settings()) -> DataFrame:
    """``lang, source, part, item, value, rank`` of every group of a language and a source.

    Part ``pair`` ranks all other sources of the language by the differences of
    all kept terms, part ``term`` the terms that the group uses more than its
    language, up to ``settings.ranks``; ties go to the earlier item in the order of
    UTF-8 bytes. Null text, lang and source count as empty; every row is a document
    of its own, repeated ones too. A group without kept terms still has its
    pairs, with value 0 where its language keeps no term; a source alone in its
    language has none. Other columns are not read; an empty table gives an empty result.

    Sent to all tasks is one number for each group: the result has a row for each pair of them.
    """
    spark = docs.sparkSession
    last = ["lang", "source"]
    with scratch(spark):
        rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((text, "text"), (lang, "lang"), (source, "source"))))
        found = rows.mapInArrow(_counted(settings), "lang string, source string, term binary, n long, docs long")
        counts = stage(found.groupBy(*last, F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
        kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("m"), F.sum("docs").alias("docs"))
        kept = stage(kept.where(F.col("docs") >= settings.documents).drop("docs"), "kept")
        used = stage(counts.where("term IS NOT NULL").drop("docs").join(kept, ["lang", "term"]), "used")
        in_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("m").alias("all"))
        sizes = used.groupBy("lang").agg(F.count("*").alias("size"))
        in_group = used.groupBy(*last).agg(F.sum("n").alias("own"))
        groups = counts.where("term IS NULL").select(*last).join(in_group, last, "left").join(in_lang, "lang", "left").join(sizes, "lang", "left")
        groups = stage(groups.fillna(0, ["own", "v", "all", "size"]), "groups")
        shares = used.join(groups, last).select(
            *last, "term", "n", "m", _share("n", "(own + v)").alias("p"), _share("m", "(all + v)").alias("q"),
            F.pmod(F.xxhash64("term"), F.ceil(F.col("size") / settings.rows).cast("long")).alias("bucket"),
        )
        shares = stage(shares, "shares")
        bases = {}
        for one in groups.where("v > 0").select(*last, _share("0L", "(own + v)").alias("p")).orderBy(*last).toLocalIterator():
            names, base = bases.setdefault(one.lang, ([], []))
            names.append(one.source)
            base.append(one.p)
        shared = spark.sparkContext.broadcast(bases)
        sums = shares.select(*last, "term", "p", "bucket").groupBy("lang", "bucket").applyInArrow(_pair_sums(shared), "lang string, source string, sums array<long>")
        sums = sums.select(*last, F.posexplode("sums").alias("at", "value")).groupBy(*last, "at").agg(F.sum("value").alias("value"))
        place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        others = groups.select("lang", F.col("source").alias("item"), place.alias("at"))
        pairs = groups.select(*last).join(others, "lang").where("source <> item").join(sums, [*last, "at"], "left")
        pairs = pairs.select(*last, F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
        order = Window.partitionBy(*last).orderBy(F.desc("value"), "item")
        pairs = stage(pairs.withColumn("rank", F.row_number().over(order)), "pairs", keep=True)
        bands = shares.where("p > q")
        for keys in ([*last, "bucket"], [*last, F.floor(F.col("bucket") / 64).alias("merged")]):
            bands = bands.groupBy(*keys).applyInArrow(_skybands(settings.ranks), shares.schema)
        terms = bands.select(*last, F.lit("term").alias("part"), F.col("term").alias("item"), _difference("p", "q").alias("value"))
        terms = stage(terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.ranks), "terms", keep=True)
    return pairs.unionByName(terms)
