"""Every registered query against its SQL, on whole tables, in DuckDB."""

from __future__ import annotations

import os

import duckdb
import pytest
from oracle import compare

import __spark_entry__ as entry
from ledgerlake.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toArrow()
    sql = ORACLES.get(name)
    if sql is None:
        assert got.num_rows > 0
    else:
        assert compare(got, duck.execute(sql).to_arrow_table()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
