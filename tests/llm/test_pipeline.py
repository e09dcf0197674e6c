import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from syncspark.llm import lsh_forest, queries

ROOT = Path(__file__).resolve().parents[2]


def test_one_query_for_each_operator():
    names = sorted(queries.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 11)]
    assert set(queries.SQL) <= set(queries.QUERIES)


def test_entry_registers_them():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert "pipeline" not in entry.oracle_sql()


def test_entry_without_the_folder(tmp_path):
    for name in ("__spark_entry__.py", "syncspark"):
        (tmp_path / name).symlink_to(ROOT / name) if name != "syncspark" else None
    package = tmp_path / "syncspark"
    package.mkdir()
    for path in (ROOT / "syncspark").iterdir():
        if path.name not in ("llm", "__pycache__"):
            (package / path.name).symlink_to(path)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus: bad, repeated, nearly repeated and clean documents, and a shared passage."""
    path = str(tmp_path_factory.mktemp("corpus"))
    clean = lambda i, n=40: " ".join(f"{'abcdefghijklmnopqrstuvwxyz'[(i * k) % 26]}ord{(i * 31 + k * k) % 97}" for k in range(1, n))
    passage = "this passage is found in several documents and is surely longer than fifty bytes"
    rows, labels = [], []
    for i in range(60):
        rows.append((i, clean(i)))
        labels.append((i, 1))
    for i in range(60, 90):
        rows.append((i, clean(i).replace(" ", " $$$%%% ")))
        labels.append((i, 0))
    rows += [(100, clean(5).replace(" ", "  ")), (101, clean(7, 200)), (102, clean(7, 200) + " tail"), (103, clean(201) + " " + passage), (104, clean(202) + " " + passage)]
    rows += [(105, clean(203)), (105, clean(203)), (None, clean(204))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_and_run(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "passages", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    schema, seen = docs.schema, {}
    for name, function in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(function(spark, docs, folder), name)
        seen[name] = docs
        if name != "packing":
            assert docs.schema.simpleString() == schema.simpleString()
    ids = {name: sorted((r.doc_id for r in df.collect()), key=repr) for name, df in seen.items() if name != "packing"}
    clean = [*range(60), 100, 101, 102, 103, 104, 105, 105, None]
    assert ids["quality"] == sorted(clean, key=repr)
    assert ids["exact"] == sorted(set(clean) - {100}, key=repr)
    assert ids["near"] == sorted(set(clean) - {100, 102}, key=repr) == ids["passages"]
    texts = {r.doc_id: r for r in seen["passages"].where("doc_id IN (103, 104)").collect()}
    assert "several documents" in texts[103].text and "several documents" not in texts[104].text
    assert texts[104].n_chars == len(texts[104].text)
    words = seen["passages"].select(F.sum(F.size(F.split(F.trim("text"), " +")))).first()[0]
    assert seen["packing"].agg(F.sum("n_tokens")).first()[0] == words
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, seen["packing"].collect()), key=repr)


def test_kept_rows_of_near_duplicates(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (None, None), (None, "a b c d e f"), (2, "")], "doc_id long, text string")
    kept = corpus_pipeline.kept_rows(docs, lsh_forest.near_duplicates(docs))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(1, "a b c d e f"), (None, None), (2, "")], key=repr)


def test_near_stage_keeps_one_of_each_group(spark):
    """Groups without an id, and different texts under the smallest id of their group."""
    text = lambda word, *ends: " ".join([f"{word}{i}" for i in range(60)] + list(ends))
    rows = [(None, text("a")), (None, text("a", "end")), (None, text("a", "x", "y")), (None, text("b")), (None, text("b", "end"))]
    rows += [(5, text("c")), (5, text("c", "end")), (6, text("c", "x")), (7, text("d")), (None, text("d", "end")), (None, None), (8, " "), (9, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [(r.doc_id, r.text[:1] if r.text else None) for r in corpus_pipeline.near_stage(spark, docs, "").collect()]
    assert sorted(kept, key=repr) == sorted([(None, "a"), (None, "b"), (5, "c"), (7, "d"), (None, None), (8, " "), (9, " ")], key=repr)


def test_workers_of_a_job_started_elsewhere(tmp_path):
    """Neither the working folder nor the path of the workers has the package."""
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
import __spark_entry__ as e
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", {str(tmp_path)!r}).config("spark.sql.shuffle.partitions", "2").getOrCreate())
assert e.queries()["op6_exact_dedup"](spark, "/root/testdata/sf0.001").count() == 200
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=env)
