"""Registered queries of this folder, with production parameters, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncspark.llm import bpe, crosspolytope, divergence, equal_average, jaccard_join, language, lsh_forest, packing, quality, repair, suffix_dedup, templates
from syncspark.llm.grace_dedup import exact_duplicates
from syncspark.llm.ship import with_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def add(function: Query) -> Query:
        function = QUERIES[function.__name__] = with_package(function)
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    r"""
    WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, sha256(s) AS text_sha256
    FROM t WINDOW g AS (PARTITION BY s)
    """
)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("raw")


def vocabulary_path() -> str:
    """File of the byte-level vocabulary; the environment can name another one."""
    if "SYNCSPARK_BYTE_BPE" in os.environ:
        return os.environ["SYNCSPARK_BYTE_BPE"]
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary_path())


@query()
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query()
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.written_and_read(table(spark, sf_dir, "documents"), vocabulary_path())


@query()
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.search(table(spark, sf_dir, "embeddings"))


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query(
    r"""
    WITH split AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_at FROM documents),
    tokens AS (SELECT *, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'),
                                        lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS t FROM split),
    filled AS (SELECT doc_id, line_at, t, {'n': len(t), 'first': t[1 : 3]} AS leaf FROM tokens WHERE len(t) > 0),
    whole AS (SELECT t FROM filled GROUP BY t HAVING count(DISTINCT doc_id) >= 5),
    others AS (SELECT * FROM filled ANTI JOIN whole USING (t)),
    each AS (SELECT doc_id, line_at, leaf, unnest(t) AS token, generate_subscripts(t, 1) AS place FROM others),
    spots AS (SELECT leaf, place, token, count(DISTINCT doc_id) AS docs FROM each WHERE place > 3 GROUP BY 1, 2, 3 HAVING docs >= 5),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line_at ORDER BY docs DESC, place) AS nth FROM each JOIN spots USING (leaf, place, token)),
    bars AS (SELECT doc_id, line_at, docs AS bar FROM ranked WHERE nth = greatest(2, (leaf.n - 2) // 2)),
    skeletons AS (SELECT doc_id, line_at, leaf, list({'place': place, 'token': token} ORDER BY place) AS skeleton, min(docs) AS least
                  FROM ranked JOIN bars USING (doc_id, line_at) WHERE 2 * docs >= bar GROUP BY 1, 2, 3),
    recurring AS (SELECT leaf, skeleton FROM skeletons GROUP BY leaf, skeleton
                  HAVING count(DISTINCT doc_id) >= 5 AND 2 * count(DISTINCT doc_id) >= min(least)),
    dropped AS (SELECT doc_id, line_at FROM filled JOIN whole USING (t)
                UNION ALL SELECT doc_id, line_at FROM skeletons JOIN recurring USING (leaf, skeleton))
    SELECT split.doc_id, count(*) AS n_lines, count(dropped.doc_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY line_at) FILTER (dropped.doc_id IS NULL), '')) AS kept_sha256
    FROM split LEFT JOIN dropped USING (doc_id, line_at) GROUP BY split.doc_id
    """
)
def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = templates.drop_templates(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _near_sql(percent: int, columns: str) -> str:
    """Near copies by comparing all sets that share a shingle, then following links."""
    return rf"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                              ELSE list_distinct([array_to_string(ws[i : i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END AS g FROM w),
    n AS (SELECT doc_id, len(g) AS n FROM s),
    e AS (SELECT doc_id, unnest(g) AS g FROM s),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have FROM e a JOIN e b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * both_have >= {percent} * (nx.n + ny.n - both_have)),
    reach(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
    SELECT {columns} FROM n JOIN reach ON reach.x = n.doc_id GROUP BY n.doc_id, n.n
    """


@query(_near_sql(75, "n.doc_id, n.n AS n_shingles, min(y) AS component_id, n.doc_id = min(y) AS kept"))
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents")).drop("raw")


# Texts as hexadecimal digits, two for each byte.
@query(
    """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS g
                FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d)),
    least AS (SELECT g, min(doc_id) AS first_doc FROM strings GROUP BY g),
    gone AS (SELECT doc_id, i FROM strings JOIN least USING (g) WHERE doc_id > first_doc),
    begins AS (SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50, -1) AS new FROM gone),
    numbered AS (SELECT doc_id, i, sum(CASE WHEN new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM begins),
    spans AS (SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY 1, 2),
    cuts AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
             UNION ALL SELECT d.doc_id, coalesce(max(spans.b), 0), any_value(length(h)) // 2 FROM d LEFT JOIN spans USING (doc_id) GROUP BY 1),
    kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a, b) AS h FROM cuts JOIN d USING (doc_id) GROUP BY 1),
    counted AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY 1)
    SELECT d.doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(kept.h)) AS kept_sha256
    FROM d JOIN kept USING (doc_id) LEFT JOIN counted USING (doc_id)
    """
)
def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def _codebook_sql(rounds: int) -> str:
    """Codes by comparing every part with every entry; each round builds on the codebooks of the one before."""
    assigned = """
    a{r} AS (SELECT part, id, arg_min(entry, {{'d': d, 'e': entry}}) AS entry, min(d) AS d
             FROM (SELECT p.part, p.id, b.entry, sum(CAST(x - y AS HUGEINT) * (x - y)) AS d
                   FROM parts p JOIN b{r} b ON p.part = b.part AND p.place = b.place GROUP BY 1, 2, 3) GROUP BY 1, 2),"""
    improved = """
    b{n} AS (SELECT b.part, b.entry, b.place, coalesce(m.y, b.y) AS y FROM b{r} b LEFT JOIN (
                 SELECT p.part, a.entry, p.place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS y
                 FROM parts p JOIN a{r} a USING (part, id) GROUP BY 1, 2, 3) m USING (part, entry, place)),"""
    steps = "".join((assigned + improved).format(r=r, n=r + 1) for r in range(rounds)) + assigned.format(r=rounds)
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS id, vec_id, label, embedding, len(embedding) // 4 AS width FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    each AS (SELECT id, width, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM kept),
    parts AS MATERIALIZED (SELECT id, i // width AS part, i % width AS place, CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT) AS x FROM each),
    b0 AS (SELECT part, id AS entry, place, CAST(x AS HUGEINT) AS y FROM parts WHERE id < 256),{steps.replace(" AS (", " AS MATERIALIZED (")}
    codes AS (SELECT id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY id),
    digest AS (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY part, entry, place)) AS h FROM b{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
    FROM kept JOIN codes USING (id) CROSS JOIN digest
    """


@query(_codebook_sql(equal_average.Settings().rounds))
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return equal_average.compress(table(spark, sf_dir, "embeddings"))


@query(
    r"""
    WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s FROM documents),
    w AS (SELECT id, lang, source, unnest(regexp_extract_all(s, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM w GROUP BY 1, 2, 3),
    k AS (SELECT lang, term, sum(n) AS m FROM c GROUP BY 1, 2 HAVING sum(docs) >= 3),
    l AS (SELECT lang, count(*) AS v, sum(m) AS total FROM k GROUP BY 1),
    g AS (SELECT DISTINCT lang, source FROM d),
    o AS (SELECT lang, source, sum(n) AS own FROM c JOIN k USING (lang, term) GROUP BY 1, 2),
    x AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                 1 + (1000000000 * CAST(coalesce(c.n, 0) + 1 AS HUGEINT)) // (coalesce(o.own, 0) + l.v) AS p,
                 1 + (1000000000 * CAST(k.m + 1 AS HUGEINT)) // (l.total + l.v) AS q
          FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN o USING (lang, source) LEFT JOIN c USING (lang, source, term)),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
             FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM x WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
               FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR place <= 200
    """
)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


@query(_near_sql(jaccard_join.Settings().percent, "n.doc_id, n.n AS n_shingles, min(y) AS component_id"))
def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
