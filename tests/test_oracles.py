"""Every registered query with SQL against DuckDB on the smallest tables."""

import glob
import math
import os

import pytest

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")

import __spark_entry__ as entry  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def rows(names, found):
    return sorted(tuple(plain(v) for v in r) for r in found)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    names = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({entry.oracle_sql()[name]})").fetchall()
    got = [tuple(r) for r in df.select(*names).collect()]
    assert rows(names, got) == rows(names, want)


@pytest.mark.parametrize("name", sorted(n for n in set(entry.queries()) - set(entry.oracle_sql()) if not n.startswith(("op", "llm_")) and n != "pipeline"))
def test_query_without_sql_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["source", "target", "n", "probability"]
