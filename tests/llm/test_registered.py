"""Registered queries on the smallest shared tables: SQL answers where there are any, and the pipeline."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tariffloom.llm.oracle import ORACLES
from tariffloom.llm.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables are not here")


def test_all_are_registered():
    names = {n.split("_")[0] for n in QUERIES}
    assert names == {"pipeline", *(f"op{k}" for k in range(1, 14))}
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_answers(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    got = sorted(tuple(map(str, r)) for r in df.select(*cols).collect())
    assert got == sorted(tuple(str(r[names.index(c)]) for c in cols) for r in cur.fetchall())


def test_pipeline(spark, odd, none, labels, tmp_path, odd_texts):
    """Each stage against its operator's rule on its own input, on odd documents."""
    bench = spark.createDataFrame([(1, odd_texts[11][1])], "item_id long, text string")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (odd, none):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            before, columns = docs, docs.columns
            stage(spark, docs, str(tmp_path)).write.mode("overwrite").parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            if name in ("toxicity", "near_duplicates", "decontamination"):
                assert docs.columns == columns and docs.exceptAll(before).count() == 0
            if name == "secrets":
                assert docs.columns == columns
            if name in ("secrets", "packing"):
                assert docs.count() == before.count()


def test_run_reads_documents(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "bucket", "batch", "slot", "padding"} <= set(rows.columns) and 0 < rows.count() < 200
