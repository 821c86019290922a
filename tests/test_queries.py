"""Each registered query against its SQL, on the same Parquet tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = Path(os.environ.get("PODIUM_SF_DIR", "/root/testdata/sf0.01"))


def comparable(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(comparable(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(contract.queries().keys() - contract.LLM_QUERIES.keys()))
def test_query_equals_sql(spark, duck, name):
    got = contract.queries()[name](spark, str(SF_DIR))
    want = duck.sql(contract.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = rows_of(got.columns, [tuple(r) for r in got.collect()])
    assert rows, "no rows"
    assert rows == rows_of(want.columns, want.fetchall())


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0
