"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from syncspark.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


# Operators that pair all rows with all rows, or leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    frame = QUERIES[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in UNWANTED if operator in plan]
    ours = _canonical([tuple(r) for r in frame.collect()], frame.columns)
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert ours == _canonical(result.fetchall(), columns)


def test_entry(spark):
    assert spark_entry.entry(spark).first().status == "differs"
