"""Registered queries of the operators against their SQL, on the smallest given tables."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from test_queries import SF_DIR, other_engine, rows  # noqa: E402, F401

from ledgerloom.llm.queries import QUERIES, SQL  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, other_engine, name):  # noqa: F811
    df = QUERIES[name](spark, SF_DIR)
    result = other_engine.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = rows(result.fetchall(), range(len(columns)))
    assert expected and rows(df.collect(), [df.columns.index(c) for c in columns]) == expected
