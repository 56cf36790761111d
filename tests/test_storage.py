"""Stored contract tables in, cache and tables out."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tariffloom import schemas
from tariffloom.plans.common import COUPLE, FAMILY
from tariffloom.session import tune
from tariffloom.search import discounts_for_stay, search, search_cache, search_cache_rules
from tariffloom.operators.availability import nightly_rows
from tariffloom.operators.cache import build_cache, build_nightly_cache
from tariffloom.sources import sinks
from tariffloom.sources.derived import DerivedContracts
from tariffloom.sources.stored import StoredContracts, conform, key_violations, parse_text_dates


def test_parquet_and_csv(spark, tmp_path):
    rows = spark.createDataFrame([("F", 1, "D1", "", "Y"), ("G", None, "D2", "D3", "N")], schemas.CNOE)
    rows.write.parquet(str(tmp_path / "p" / "cnoe"))
    rows.write.option("header", "true").csv(str(tmp_path / "c" / "cnoe"))
    want = sorted(map(tuple, rows.collect()))
    for fmt, root in (("parquet", "p"), ("csv", "c")):
        df = StoredContracts(spark, str(tmp_path / root), fmt).table("cnoe")
        assert df.schema.simpleString() == schemas.CNOE.simpleString()
        assert sorted(map(tuple, df.collect())) == want


def test_text_dates(spark, tmp_path):
    text = spark.createDataFrame([("F", "19980820", "n/a"), ("G", None, "19981332")], "file_id string, initial_date string, end_date string")
    conform_free = parse_text_dates(text, schemas.CCON).collect()
    assert [str(r.initial_date) for r in conform_free] == ["1998-08-20", "None"]
    assert [r.end_date for r in conform_free] == [None, None]


def test_conform_adds_columns_and_defaults(spark):
    df = conform(spark.createDataFrame([("F", "HB")], "file_id string, board_code string"), "cnsr")
    assert df.schema.simpleString() == schemas.CNSR.simpleString()
    row = df.first()
    assert (row.amount, row.percentage, row.room_type, row.min_age) == (0, 0, "", None)


def test_key_violations(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "file_id string")
    assert {(r.file_id, r.n) for r in key_violations(df, ("file_id",)).collect()} == {("a", 2), (None, 1)}


def test_table_lifecycle(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "code string, n int")
    sinks.create_table_as(rows, "lifecycle")
    # delete by key, replacing the table the query reads
    doomed = spark.createDataFrame([("a",)], "code string")
    sinks.replace_table(spark, sinks.delete_matching(spark.table("lifecycle"), doomed, ["code"]), "lifecycle")
    assert {r.n for r in spark.table("lifecycle").collect()} == {2, 3}
    sinks.truncate_insert(spark.createDataFrame([(9, "z")], "n int, code string"), "lifecycle")
    assert [tuple(r) for r in spark.table("lifecycle").select("code", "n").collect()] == [("z", 9)]
    sinks.empty_table(spark, "lifecycle")
    assert spark.table("lifecycle").count() == 0
    assert spark.table("lifecycle").columns == ["code", "n"]
    spark.sql("DROP TABLE lifecycle")


def test_cache_layout_prunes(spark, tmp_path):
    cols = "file_id string, room_type string, characteristic string, country_code string, city_code string, lo date, amount double"
    df = spark.createDataFrame([("F", "R", "A", c, f"{c}_1", None, 1.0) for c in ("X", "Y")], cols)
    path = str(tmp_path / "cache")
    sinks.write_cache(df, path)
    assert dict(sinks.read_cache(spark, path).dtypes)["country_code"] == "string"
    assert sorted(d for d in os.listdir(path) if d.startswith("country")) == ["country_code=X", "country_code=Y"]
    found = spark.read.parquet(path).filter(F.col("city_code").startswith("X"))
    assert found.count() == 1
    assert "PartitionFilters: [isnotnull(city_code" in found._jdf.queryExecution().executedPlan().toString()


def test_stored_respects_the_shared_folder(spark, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    df = sinks.stored(spark.range(5).selectExpr("id", "id * 2 as twice"))
    assert df.columns == ["id", "twice"] and df.count() == 5
    used = spark.sparkContext.getCheckpointDir()
    assert used and (before is None or used == before)
    assert used.removeprefix("file:") in df.inputFiles()[0].removeprefix("file://")


def test_settings_of_the_owner_stay(spark):
    other, key = spark.newSession(), "spark.sql.adaptive.skewJoin.enabled"
    other.conf.set(key, "false")
    other.conf.unset("spark.sql.requireAllClusterKeysForDistribution")
    tune(other)
    assert other.conf.get(key) == "false" and other.conf.get("spark.sql.requireAllClusterKeysForDistribution") == "true"
    assert spark.conf.get(key) == "true"


def test_nights_of_rows_without_a_named_day(spark):
    rows = [("a", "1998-01-01", "1998-01-04", None), ("b", "1998-01-01", "1998-01-04", 2), ("c", "1998-01-04", "1998-01-04", None),
            ("d", "1998-01-09", "1998-01-04", None)]
    df = spark.createDataFrame([(r, lo, hi, d) for r, lo, hi, d in rows], "room_type string, lo string, hi string, days int").selectExpr(
        "'F' as file_id", "1 as hotel_id", "cast(lo as date) as initial_date", "cast(hi as date) as final_date", "room_type",
        "'A' as characteristic", "'1' as generic_rate", "'N' as is_price_per_pax", "null as specific_rate", "'BB' as base_board",
        "1.0 as amount", "days")
    got = sorted((r.room_type, str(r.initial_date)[-2:]) for r in nightly_rows(df).collect())
    assert got == [("a", "01"), ("a", "02"), ("a", "03"), ("b", "03")]


def test_search_runs_on_stored_contracts(spark, tmp_path):
    """The same operators over tables written with the declared schemas."""
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    made = DerivedContracts(spark, sf)
    for name in ("ccon", "cnct", "cnha", "cnsr", "cnsu", "cngr", "cnoe", "cnem", "hotel_supplier"):
        df = made.table(name)
        if name == "cnsu":
            df = df.withColumnRenamed("code", "supplement_or_discount_code")
        conform(df, name).write.parquet(str(tmp_path / name))
    held = StoredContracts(spark, str(tmp_path))
    ids = {r.cnct_id for r in search(made, FAMILY).collect()}
    rows = search(held, FAMILY).collect()
    assert ids and {r.cnct_id for r in rows} == ids and len(rows) == len(ids)
    assert all(r.total_price is not None for r in rows)
    from_made, from_held = build_cache(made), build_cache(held)
    assert from_held.count() == from_made.count()
    price = lambda c: sorted(round(r.price, 6) for r in search_cache(c, COUPLE).collect())
    assert price(from_held) == price(from_made)
    sinks.write_cache(from_held, str(tmp_path / "cache"))
    assert price(sinks.read_cache(spark, str(tmp_path / "cache"))) == price(from_made)
    nights = lambda t: sorted(map(str, build_nightly_cache(t).select("rt_id", "lo", "amount", "min_nights").collect()))
    assert nights(held) == nights(made)
    cached = sinks.read_cache(spark, str(tmp_path / "cache"))
    assert sorted(r.cnct_id for r in search_cache_rules(cached, held, FAMILY).select("cnct_id").collect()) == sorted(
        r.cnct_id for r in search_cache_rules(from_made, made, FAMILY).select("cnct_id").collect())
    stay = (FAMILY.check_in, FAMILY.check_out)
    assert discounts_for_stay(held, *stay).count() == discounts_for_stay(made, *stay).count()
