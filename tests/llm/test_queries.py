"""The registered queries of the subpackage: all there, and equal to their SQL twins where they have one."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, digest
from yearweave.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) == sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert "pipeline" in entry.queries() and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert digest(got.columns, [tuple(r) for r in got.collect()])[0] == digest(columns, want.fetchall())[0]


@pytest.mark.parametrize("name", ["op4_simhash", "op6_line_dedup", "op9_decontamination", "op10_kd_sharding"])
def test_native_queries_run_no_python_and_keep_every_row(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    if name in ("op6_line_dedup", "op10_kd_sharding"):
        assert "InArrow" not in df._jdf.queryExecution().executedPlan().toString()
