"""Every query with SQL gives what DuckDB gives on the same files."""

import os
from pathlib import Path

import pytest

from tidemark.plans import catalog

duckdb = pytest.importorskip("duckdb")
SF = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def rows_of(names, rows):
    return sorted(repr(tuple(float(v) if isinstance(v, float) else v for v in r)) for r in ([r[names.index(n)] for n in sorted(names)] for r in rows))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, str(SF))
    want = duck.execute(catalog.SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(names, want.fetchall())


def test_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and set(catalog.QUERIES) <= set(e.queries())
    assert set(catalog.SQL) == set(catalog.QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
