"""Every registered query against its DuckDB oracle (the driver's check)."""

import math

import duckdb
import pytest
from conftest import SF01

import __spark_entry__ as entry
from tessera.plans import registry
from tessera.session import TABLES

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.ORACLE) == set(registry.QUERIES)
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["line", "n", "first_doc_id", "first_line_no", "first_seen_rank"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF01)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(rel.columns, want)
