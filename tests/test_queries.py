"""Every registered query against DuckDB on the driver's tables, as multisets."""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return float(value) if isinstance(value, Decimal) else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_PAIRS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


# Queries for training text are tested with their operators, those with SQL here too.
_OWN = {name for name in driver.queries() if not re.match(r"op\d+_|pipeline$", name)}


@pytest.mark.parametrize("name", list(driver.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    found = driver.queries()[name](spark, SF_DIR)
    wanted = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in wanted.description]
    types = {d[0]: str(d[1]) for d in wanted.description}
    rows = wanted.fetchall()
    assert {f.name: _PAIRS[f.dataType.simpleString()] for f in found.schema} == {
        n: t if t in _PAIRS.values() else t.upper() for n, t in types.items()
    }
    got = _rows(found.columns, found.collect())
    assert rows
    assert got == _rows(names, rows)


def test_every_query_has_its_sql():
    assert _OWN <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_has_rows(spark):
    if not Path("/root/testdata/sf0.001").is_dir():
        pytest.skip("no driver tables")
    assert driver.entry(spark).columns == ["c_name", "ts", "num_transactions"]
    assert not driver.entry(spark).isEmpty()
