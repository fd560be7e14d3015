import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from broadsheet.plans.oracle import oracle  # noqa: E402
from broadsheet.plans.queries import QUERIES  # noqa: E402

SQL = oracle()


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(r[i] for i in order)) for r in rows)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= queries().keys() and SQL.keys() <= oracle_sql().keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    want = duck.execute(SQL[name])
    columns = [d[0] for d in want.description]
    got = canonical(df.columns, df.collect())
    assert got == canonical(columns, want.fetchall())
    assert got[1], "a check on no rows proves nothing"


@pytest.mark.parametrize("name", QUERIES)
def test_plan_has_no_cross_join(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark, sf):
    def scan(name):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "FileScan" in line]

    assert all("ReadSchema: struct<>" in s for s in scan("dataset_counts"))
    assert all("ReadSchema: struct<text:string,source:string>" in s for s in scan("collection_stats"))
    assert all("ReadSchema: struct<ts:timestamp" in s and "props" not in s for s in scan("hourly_collection"))
    assert all("html" not in s for s in scan("corpus_tokens"))
    assert any("IsNotNull(quality)" in s for s in scan("labelled_corpus"))
    tokenised = QUERIES["corpus_lemmas"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any("split" in line for line in tokenised.splitlines() if " Filter " in line)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["source", "n_rows", "n_unique"] and df.count() == 20
