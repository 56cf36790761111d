"""Contract tables loaded once: numbers of rules, buckets, pruned scans."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tariffloom import schemas
from tariffloom.operators import rules
from tariffloom.params import FAMILY
from tariffloom.search import search
from tariffloom.sources import load
from tariffloom.sources.derived import DerivedContracts
from tariffloom.sources.load import CHUNK, COPY, bucket_count, contract_rows, load_contracts, numbered
from tariffloom.sources.stored import conform

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables are not here")


class Frames:
    def __init__(self, **frames):
        self.frames = frames

    def table(self, name):
        return self.frames[name]


def board_rules(spark):
    """A third of all rows is one rule of one contract; some rows have no contract."""
    rows = [("hot", "HB", 1.0)] * 400 + [(f"c{k % 37:02}", "FB", float(k % 5)) for k in range(780)] + [(None, "BB", 2.0)] * 20
    return conform(spark.createDataFrame(rows, "file_id string, board_code string, amount double").repartition(7), "cnsr")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_are_dense_ordered_and_the_same_again(spark):
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            found.append(sorted(tuple(r) for r in numbered(board_rules(spark)).select(
                "rule_id", F.coalesce("file_id", F.lit("")), "board_code", F.col("amount").cast("double"), COPY).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = found[0]
    assert found[0] == found[1] and [r[0] for r in rows] == list(range(1, 1201))
    assert [r[1] for r in rows] == sorted(r[1] for r in rows)
    copies = {}
    for r in rows:
        copies[r[1:4]] = copies.get(r[1:4], 0) + 1
        assert r[4] == copies[r[1:4]]
    assert copies["hot", "HB", 1.0] == 400 and copies["", "BB", 2.0] == 20
    empty = numbered(board_rules(spark).limit(0))
    assert empty.count() == 0 and empty.columns == [*schemas.CNSR.fieldNames(), "rule_id", COPY]


def test_buckets_join_without_a_shuffle_unless_a_contract_is_crowded(spark, tmp_path):
    heads = conform(spark.createDataFrame([(f"c{k:02}",) for k in range(37)] + [("hot",)], "file_id string"), "ccon")
    made = Frames(cnsr=board_rules(spark), ccon=heads)
    want = sorted((f"c{k % 37:02}", "FB") for k in range(780)) + [("hot", "HB")] * 400
    for per_bucket, shuffles in ((500, False), (100, True)):
        prefix = f"load{per_bucket}"
        held = load_contracts(made, spark, prefix, ("ccon", "cnsr"), str(tmp_path / prefix), per_bucket)
        joined = held.table("ccon").hint("merge").join(held.table("cnsr"), "file_id").select("file_id", "board_code")
        assert ("Exchange" in plan(joined)) == shuffles
        assert sorted(map(tuple, joined.collect())) == want
        for name in ("ccon", "cnsr"):
            spark.sql(f"DROP TABLE {prefix}_{name}")
    assert [bucket_count([spark.range(n)], 100) for n in (0, 100, 101, 1000)] == [1, 1, 2, 16]


def test_rules_in_buckets_are_dealt_once_and_numbered_alike(spark, tmp_path):
    """The numbers of the tables in buckets are those of the crowded one; a rule of more copies than a chunk."""
    cngr = conform(spark.createDataFrame([(f"c{k % 41:02}", k % 3) for k in range(500)], "file_id string, frees int"), "cngr")
    made = Frames(cngr=cngr, cnsr=board_rules(spark), cnsu=conform(spark.createDataFrame([], "file_id string"), "cnsu"))
    shuffled = lambda name: sum(
        "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line for line in plan(name).splitlines())
    found = []
    for per_bucket in (500, 10):
        held = load_contracts(made, spark, f"alike{per_bucket}", ("cngr", "cnsr", "cnsu"), str(tmp_path / str(per_bucket)), per_bucket)
        found.append({name: sorted(map(tuple, held.loaded(name).select("rule_id", F.coalesce("file_id", F.lit("")), COPY, F.to_json(
            F.struct(*made.frames[name].columns))).collect())) for name in made.frames})
        for name in made.frames:
            spark.sql(f"DROP TABLE alike{per_bucket}_{name}")
    assert found[0] == found[1] and not found[0]["cnsu"]
    for name in ("cngr", "cnsr"):
        assert [r[0] for r in found[0][name]] == list(range(1, made.frames[name].count() + 1))
    counted = contract_rows({"cngr": cngr, "cnsr": made.frames["cnsr"]}).collect()
    assert sum(r["_n"] for r in counted) == 1700 and sorted(r["_before"] for r in counted)[0] == 0
    rows = made.frames["cnsr"]
    earlier = spark.createDataFrame([("hot", 800)], "file_id string, _offset long")
    assert shuffled(load.numbered_in_buckets(rows, earlier, 4)) == 2  # the rows and the offsets; before: rows of all columns four times
    many = conform(spark.range(2 * CHUNK + 5).selectExpr("'hot' as file_id", "'HB' as board_code"), "cnsr")
    r = numbered(many).agg(F.count(F.lit(1)), F.countDistinct("rule_id"), F.countDistinct(COPY), F.max("rule_id"), F.max(COPY)).first()
    assert set(r) == {2 * CHUNK + 5}


@here
def test_loaded_contracts_are_searched_alike_and_scans_are_pruned(spark, tmp_path):
    made = DerivedContracts(spark, SF)
    names = ("ccon", "cnct", "cnha", "cnsr", "cnsu", "cngr", "cnoe", "cnem", "hotel_supplier")
    held = load_contracts(made, spark, "loaded", names[:-1], str(tmp_path))
    held.table = lambda name, table=held.table: made.table(name) if name == "hotel_supplier" else table(name)
    bookable = rules.bookable(held.table("cnsu"), FAMILY).select("file_id", "rule_id", "code")
    read = plan(bookable).split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(c.split(":")[0] for c in read.split(",")) == [
        "application_final_date", "application_initial_date", "file_id", "rule_id", "supplement_or_discount_code"]
    total = lambda t: sorted((r.cnct_id, round(r.total_price, 4)) for r in search(t, FAMILY).collect())
    want = total(made)
    assert len(want) > 10 and total(held) == want
    for name in names[:-1]:
        spark.sql(f"DROP TABLE loaded_{name}")
