"""Every registered query against its SQL answer on the smallest shared tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from oracle.queries import ORACLES
from tariffloom.plans.registry import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ANSWERS = ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ANSWERS)
    assert set(QUERIES) <= set(driver.queries()) and set(ANSWERS) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(str, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    cur = duck.execute(ANSWERS[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted(tuple(str(r[i]) for i in at) for r in cur.fetchall())
    assert got == want


def test_entry_runs(spark):
    assert driver.entry(spark).columns == [
        "cnct_id", "file_id", "room_type", "characteristic", "board", "sbprice", "sbbprice", "pbprice", "pbbprice",
        "total_price",
    ]
