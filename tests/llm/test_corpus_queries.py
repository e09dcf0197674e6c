"""Every corpus query over the smallest tables: its columns, and its SQL where there is one."""

from pathlib import Path

import duckdb
import pytest

from syncspark.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")

# Columns and rows (of which table) that each query has.
CONTRACT = {
    "op1_packing": ("doc_id piece n_tokens bucket_length batch slot", None),
    "op2_quality": ("doc_id held_out score predicted", "documents"),
    "op3_repeated_passages": ("doc_id n_bytes n_removed n_spans kept_sha256", "documents"),
    "op4_near_duplicates": ("doc_id n_shingles component_id kept", "documents"),
    "op5_bpe": ("doc_id n_tokens ids_sha256 decoded_sha256", "documents"),
    "op6_exact_dedup": ("doc_id keep_id group_size kept text_sha256", "documents"),
    "op7_language": ("doc_id held_out lang_pred score", "documents"),
    "op8_token_files": ("doc_id start n_tokens ids_crc32", "documents"),
    "op9_line_templates": ("doc_id n_lines n_dropped kept_sha256", "documents"),
    "op10_neighbours": ("query_id rank vec_id score", None),
    "op11_vector_codes": ("vec_id code error label_error codebooks_sha256", None),
    "op12_jaccard_join": ("doc_id n_shingles component_id", "documents"),
    "op13_source_divergence": ("lang source part item value rank", None),
}


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns_rows_and_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    columns, table = CONTRACT[name]
    assert frame.columns == columns.split()
    rows = [tuple(r) for r in frame.collect()]
    assert rows and (table is None or len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count())
    if name in SQL:
        connection = duckdb.connect()
        for name_ in ("documents", "embeddings"):
            connection.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{SF}/{name_}.parquet'")
        result = connection.execute(SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == sorted(frame.columns)
        order = [names.index(c) for c in frame.columns]
        assert sorted(rows) == sorted(tuple(row[i] for i in order) for row in result.fetchall())
