"""Differential: every registered query against its SQL twin in DuckDB."""

import hashlib
import math

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from emberline.sources.tables import TABLES

SQL = E.oracle_sql()
NAMES = sorted(n for n in SQL if not n.startswith(("op", "pipeline")))


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted("|".join(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_is_registered():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert {q for q in set(qs) - set(SQL) if not q.startswith(("op", "pipeline"))} == set()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert hashlib.sha256("\n".join(_rows(got)).encode()).digest() == \
        hashlib.sha256("\n".join(_rows(want)).encode()).digest()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "risk_probability" in df.columns
