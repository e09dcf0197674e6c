"""Line deduplication with a tree of log templates, in DataFrame functions only.

The tree has a fixed depth: the number of tokens of a line, then its leading
tokens, with tokens that hold a digit as a wildcard. A leaf holds any number of
templates. Lines that recur as they stand are templates of their own. In each
other line the tokens behind the leading ones are fixed or variable by the
documents of the leaf that have them at their place: the fixed tokens of a
template are found together, so they are about equally frequent, and a variable
field is not. Templates found in many documents are dropped wherever they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from syncspark.workspace import scratch, stage

DEPTH = 3
SIMILARITY = 0.5
COHESION = 0.5
LEAST_DOCS = 5
# A template with a variable field has at least so many fixed tokens behind the leading ones.
_LEAST_FIXED = 2
_BLANKS = r"[\x20\x09-\x0D]+"
# A token with a digit, found from its beginning only.
_VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
_WILDCARD = "<*>"
# Keys are first looked up in so many bits, broadcast as at most 2**17 words of 64 bits.
_BITS = 1 << 23


def line_tokens(line: Column) -> Column:
    """Tokens of a line, variable ones as the wildcard; a blank line has one empty token."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _VARIABLE, _WILDCARD)).otherwise(line)
    return F.split(F.regexp_replace(masked, rf"^{_BLANKS}|{_BLANKS}$", ""), _BLANKS)


def _leaf(tokens: Column, depth: int) -> Column:
    return F.when(F.get(tokens, 0) != "", F.xxhash64(F.size(tokens), F.slice(tokens, 1, depth)))


def _likely(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not among ``keys``, filtered where they are read.

    The more keys there are, the fewer rows it holds back; what it lets through
    is decided by a join.
    """
    slot = F.pmod(F.col(key), F.lit(_BITS))
    word, bit = F.shiftright(slot, 6), slot.bitwiseAND(F.lit(63)).cast("int")
    words = keys.select(word.alias("word"), bit.alias("bit")).withColumn("one", F.expr("shiftleft(1L, bit)"))
    words = words.groupBy("word").agg(F.bit_or("one").alias("ones"))
    found = rows.withColumn("word", word).withColumn("bit", bit).join(F.broadcast(words), "word")
    return found.where(F.getbit("ones", "bit") == 1).select(*rows.columns)


def _spots(depth: int) -> Column:
    """A hash of leaf, place and token for each token behind the leading ones."""
    behind = F.slice("tokens", depth + 1, F.greatest(F.size("tokens") - depth, F.lit(0)))
    return F.transform(behind, lambda token, at: F.xxhash64("leaf", at, token))


def _skeletons(lines: DataFrame, similarity: float, least_docs: int) -> DataFrame:
    """``row, at, leaf, skeleton, least`` of the ``lines`` that have enough fixed tokens.

    ``lines`` has ``row, at, leaf, spots``. ``least`` is the number of documents
    that have the rarest fixed token in its place.
    """
    need = F.greatest(F.lit(_LEAST_FIXED), F.ceil(F.lit(similarity) * F.size("spots"))).cast("int")
    each = lines.select("row", "at", "leaf", need.alias("need"), F.posexplode("spots").alias("place", "spot"))
    docs = each.select("spot", "row").distinct().groupBy("spot").agg(F.count("*").alias("docs"))
    docs = stage(docs.where(F.col("docs") >= least_docs), "spots")
    found = _likely(each, docs, "spot").join(docs, "spot").groupBy("row", "at", "leaf", "need")
    found = found.agg(F.array_sort(F.collect_list(F.struct("place", "spot", "docs"))).alias("x")).where(F.size("x") >= F.col("need"))
    bar = F.get(F.sort_array(F.transform("x", lambda x: x["docs"]), asc=False), F.col("need") - 1)
    fixed = found.withColumn("bar", bar).withColumn("x", F.filter("x", lambda x: 2 * x["docs"] >= F.col("bar")))
    return fixed.select(
        "row", "at", "leaf",
        F.xxhash64(F.transform("x", lambda x: x["spot"])).alias("skeleton"),
        F.array_min(F.transform("x", lambda x: x["docs"])).alias("least"),
    )


def drop_templates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, similarity: float = SIMILARITY, cohesion: float = COHESION, least_docs: int = LEAST_DOCS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_lines, n_dropped, text``.

    ``text`` is what is left: the lines whose template occurs in fewer than
    ``least_docs`` rows of ``docs``, joined by line feeds as they were. Blank
    lines always stay. A line whose tokens recur in ``least_docs`` documents is
    dropped. Of the other lines, a token behind the leading ones counts as fixed
    if ``least_docs`` documents have it in its place of the leaf, and at least
    half as many as have the line's ``need``-th most frequent one; ``need`` is
    the share ``similarity`` of these tokens, at least 2, and lines with fewer
    stay. Lines of a leaf with the same fixed tokens share a template. It is dropped if it
    occurs in ``least_docs`` documents and in the share ``cohesion`` of those that have its
    rarest fixed token: words that merely are frequent seldom come together.

    Null counts as an empty text, which has one blank line; repeated rows count
    as documents of their own; other columns are not read; an empty table gives
    an empty result. Only lines of leaves found in ``least_docs`` documents are
    looked at closer: no other line can belong to a recurring template. Lines
    are told apart by 64 bits of their own and 64 of their leaf.
    """
    with scratch(docs.sparkSession):
        lines = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")
        split = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), lines.alias("lines"))
        leaves = F.transform(F.transform("lines", line_tokens), lambda t: _leaf(t, depth))
        split = stage(split.withColumn("leaves", leaves), "lines")
        often = split.select("row", F.explode("leaves").alias("leaf")).where("leaf IS NOT NULL").distinct()
        # Tables of their own on the other side of a join let adaptive execution split a hot leaf.
        often = stage(often.groupBy("leaf").count().where(F.col("count") >= least_docs).select("leaf"), "leaves")
        each = split.select("row", F.posexplode(F.arrays_zip("lines", "leaves")).alias("at", "x"))
        each = each.select("row", "at", F.col("x.leaves").alias("leaf"), F.col("x.lines").alias("line"))
        each = _likely(each.where("leaf IS NOT NULL"), often, "leaf").join(often, "leaf")
        tokens = line_tokens(F.col("line"))
        seen = stage(each.select("row", "at", "leaf", tokens.alias("tokens")).withColumn("line", F.xxhash64("tokens")), "recurring-leaves")
        whole = seen.select("leaf", "line", "row").distinct().groupBy("leaf", "line").count().where(F.col("count") >= least_docs)
        whole = stage(whole.select("leaf", "line"), "whole-lines")
        same = seen.select("row", "at", "leaf", "line").join(whole, ["leaf", "line"]).select("row", "at")
        others = seen.where(F.size("tokens") >= depth + _LEAST_FIXED).join(whole, ["leaf", "line"], "left_anti")
        others = stage(others.select("row", "at", "leaf", _spots(depth).alias("spots")), "other-lines")
        named = stage(_skeletons(others, similarity, least_docs), "skeletons")
        recurring = named.groupBy("leaf", "skeleton", "row").agg(F.min("least").alias("least"))
        recurring = recurring.groupBy("leaf", "skeleton").agg(F.count("*").alias("docs"), F.min("least").alias("least"))
        recurring = recurring.where((F.col("docs") >= least_docs) & (F.col("docs") >= cohesion * F.col("least")))
        recurring = stage(recurring.select("leaf", "skeleton"), "recurring")
        dropped = same.unionByName(named.join(recurring, ["leaf", "skeleton"]).select("row", "at"))
        dropped = dropped.groupBy("row").agg(F.collect_set("at").alias("dropped"))
        # The difference of two arrays hashes its elements, so the cost is linear in the lines of a document.
        stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
        left = F.transform(stay, lambda at: F.get(F.col("lines"), at))
        rest = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(left)
        return stage(
            split.select("row", "doc_id", "lines").join(dropped, "row", "left").select(
                "doc_id",
                F.size("lines").cast("long").alias("n_lines"),
                F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                F.array_join(rest, "\n").alias("text"),
            ),
            "lines-left",
            keep=True,
        )
