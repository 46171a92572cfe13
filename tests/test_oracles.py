"""Every registered query of the library against its SQL, on the small tables."""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from tests.conftest import SMALL
from tillflow.plans.oracle import ORACLES
from tillflow.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SMALL):
        pytest.skip("the given tables are not here")
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in Path(SMALL).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SMALL)
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    assert sorted(found.columns) == sorted(names)
    rows = Counter(tuple(r) for r in found.select(*names).collect())
    assert rows == Counter(expected.fetchall())
    assert rows


def test_entry(spark, small_dir):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
