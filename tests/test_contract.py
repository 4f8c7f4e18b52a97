"""The driver contract: every registered query equals its DuckDB oracle (smallest tables)."""

from __future__ import annotations

import importlib
import math
import os

import duckdb
import pytest
from conftest import SF_SMALL

entry = importlib.import_module("__spark_entry__")


def normalise(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return repr(v)


def rows_by_name(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return sorted(tuple(normalise(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(f for f in os.listdir(SF_SMALL) if f.endswith(".parquet")):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS "
                    f"SELECT * FROM read_parquet('{os.path.join(SF_SMALL, file)}')")
    return con


def test_every_query_is_registered_once():
    names = list(entry.queries())
    assert len(names) == len(set(names)) >= 17
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    expected = cur.fetchall()
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in ocols)
    assert rows_by_name(got, df.columns) == rows_by_name(expected, ocols)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
