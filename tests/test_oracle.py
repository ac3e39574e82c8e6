"""Every registered query against its DuckDB oracle on the smallest fixture."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from costcurves.plans import oracle_sql, registry

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_oracle():
    """All of this package's own queries; the optional ones are tested in tests/llm."""
    assert set(registry.queries()) == set(oracle_sql.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, sf_dir, name):
    df = E.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(rel.columns, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["PROJECT_NUMBER", "STAGE", "SUB_STAGE", "DATE", "VALUE", "TYPE"]
    types = {r.TYPE for r in df.select("TYPE").distinct().collect()}
    assert types == {"ACTUAL", "PLANNED", "FORECAST"}
