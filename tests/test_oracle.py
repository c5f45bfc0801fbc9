"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

import hashlib
import math
import os

import duckdb
import pytest

from conftest import SF001

import __spark_entry__ as E

TABLES = ["pages", "documents", "embeddings", "conversations", "labels", "benchmark"]
QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], hashlib.md5("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle_or_is_listed():
    from crawlsieve.plans.registry import QUERIES as CORE
    assert set(CORE) - set(ORACLE) == {"tokenize_documents"}
    assert set(CORE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    s_cols, s_hash = _digest(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(ORACLE[name])
    d_cols, d_hash = _digest(rel.columns, rel.fetchall())
    assert s_cols == d_cols
    assert s_hash == d_hash
