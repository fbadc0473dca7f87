"""Every registered query against its SQL in another engine, on the smallest given tables."""

from __future__ import annotations

import os
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
import __spark_entry__ as entry  # noqa: E402
from ledgerloom.queries.registry import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
#: Here products without a barcode are in the feed.
LARGER = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def connected(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module")
def other_engine():
    return connected(SF_DIR)


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    return round(value, 9) + 0.0 if isinstance(value, float) else value


def rows(records, order):
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, other_engine, name):
    compare(spark, other_engine, SF_DIR, name)


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables here")
@pytest.mark.parametrize("name", ["dim_product", "model_checks"])
def test_products_without_a_barcode(spark, name):
    compare(spark, connected(LARGER), LARGER, name)


def compare(spark, engine, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    result = engine.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = rows(result.fetchall(), range(len(columns)))
    assert expected
    assert rows(df.collect(), [df.columns.index(c) for c in columns]) == expected


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(QUERIES) & set(entry.oracle_sql())


def test_flagship(spark):
    got = {(r.category, r.status): r.n for r in entry.entry(spark).collect()}
    assert got == {
        ("colour", "mapped"): 13, ("device", "mapped"): 44, ("hardware", "mapped"): 42,
        ("machine", "mapped"): 33, ("other", "mapped"): 17, ("other", "no_categories"): 18,
        ("other", "unmapped"): 33,
    }
