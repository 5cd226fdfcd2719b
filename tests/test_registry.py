"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SMOKE_DIR, final_plan

import __spark_entry__ as entry_module
from lakestar.verification.oracle import ORACLES
from lakestar.verification.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SQL_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SMOKE_DIR}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = entry_module.queries()[name](spark, SMOKE_DIR)
    columns = sorted(df.columns)
    plan = final_plan(df)
    got = sorted(tuple(repr(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(entry_module.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(types) == columns
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in df.schema} == types
    order = [list(types).index(c) for c in columns]
    assert got == sorted(tuple(repr(row[i]) for i in order) for row in result.fetchall())
    # Nothing leaves the JVM.
    assert not any(op in plan for op in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"))
