"""Every query against its SQL, whole tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry_module  # noqa: E402
from pagetally import queries as base_queries  # noqa: E402
from pagetally import queries_sql  # noqa: E402

SF_DIR = Path("/root/testdata/sf0.01")
QUERIES, ORACLE = base_queries.QUERIES, queries_sql.ORACLE


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        con.sql(f"create view {file.stem} as select * from '{file}'")
    return con


KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, str(SF_DIR))
    want = duck.sql(ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    types = dict(zip(want.columns, [str(t) for t in want.types]))
    assert {c: KINDS[t] for c, t in got.dtypes} == types
    got_rows = sorted(map(repr, (tuple(r) for r in got.select(*columns).collect())))
    want_rows = sorted(map(repr, want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()))
    assert got_rows
    assert got_rows == want_rows


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
