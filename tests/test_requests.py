"""A table of stays against one search per stay, order of the list, the entry without the text operators, partial refresh."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tariffloom.operators import availability as av
from tariffloom.operators.cache import build_cache
from tariffloom.params import Stay
from tariffloom.plans.registry import QUERIES
from tariffloom.search import search_requests
from tariffloom.sources import sinks
from tariffloom.sources.derived import DerivedContracts

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DAY = dt.date(2018, 1, 1)
here = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables are not here")


class Hotel:
    def __init__(self, spark):
        rng = random.Random(3)
        prices = []
        for i in range(500):
            lo = DAY + dt.timedelta(days=rng.randint(0, 300))
            prices.append((rng.choice(["hot", "hot", "hot", "b", "c"]), rng.choice("RS"), "A", "BB", rng.choice(["Y", "N"]), lo,
                           lo + dt.timedelta(days=rng.choice([0, 1, 3, 20, 90, -5])), float(rng.randint(1, 99))))
        self.cnct = spark.createDataFrame(prices, "file_id string, room_type string, characteristic string, base_board string, is_price_per_pax string, "
                                          "initial_date date, final_date date, amount double")
        self.cnha = spark.createDataFrame([(f, r, "A", 1, m, 2) for f in ("hot", "b", "c") for r, m in (("R", 4), ("S", 2))],
                                          "file_id string, room_type string, characteristic string, hotel_id int, max_pax int, max_children int")
        self.ccon = spark.createDataFrame([(f, f, 1, f, "C", "EUR", 2, 11) for f in ("hot", "b", "c")],
                                          "file_id string, hotel_code string, contract_number int, contract_name string, company_code string, currency string, "
                                          "minimum_child_age int, maximum_child_age int")
        self.hotel_supplier = spark.createDataFrame([("hot", 5, "ES", "X"), ("b", 5, "ES", "Y"), ("c", 6, "ES", "Z")],
                                                    "supplier_hotel_code string, supplier_id int, country_code string, city_code string")

    def table(self, name):
        return getattr(self, name)


def test_requests_are_searched_like_single_stays(spark):
    t, rng = Hotel(spark), random.Random(5)
    asked = []
    for i in range(25):
        lo = DAY + dt.timedelta(days=rng.randint(0, 300))
        asked.append((i, rng.choice(["hot", "hot", "b", "c"]), lo, lo + dt.timedelta(days=rng.choice([1, 2, 7, 61, 62, 63, 130])), rng.choice([[30, 30], [30, 5, 1], [1], [30, 30, 30]])))
    asked += [asked[0], (1, "hot", DAY, DAY + dt.timedelta(days=2), [30]), (90, "hot", DAY, DAY, [30]), (91, "nowhere", DAY, DAY + dt.timedelta(days=1), [30])]
    df = spark.createDataFrame(asked, "request_id long, file_id string, check_in date, check_out date, ages array<int>").repartition(3)
    got = sorted((r.request_id, r.file_id, r.room_type, r.is_price_per_pax, r.sum_nights, float(r.stay_amount), r.paxes, round(r.price, 6))
                 for r in search_requests(t, df).collect())
    want = []
    for request, file_id, lo, hi, ages in {(*r[:4], tuple(r[4])) for r in asked}:
        if lo == hi or file_id not in ("hot", "b"):
            continue
        infants, childes = sum(a < 2 for a in ages), sum(2 <= a <= 11 for a in ages)
        paxes = len(ages) - infants
        for r in av.sold_rooms(t.cnct.filter(F.col("file_id") == file_id), Stay(lo, hi, ages, lo)).collect():
            if 0 < paxes <= {"R": 4, "S": 2}[r.room_type] and childes <= 2:
                nightly = float(r.stay_amount) / r.sum_nights * (hi - lo).days
                want.append((request, file_id, r.room_type, r.is_price_per_pax, r.sum_nights, float(r.stay_amount), paxes,
                             round(nightly * (paxes if r.is_price_per_pax == "Y" else 1), 6)))
    assert len(want) > 10 and got == sorted(want)


def test_a_request_meets_a_room_in_one_row(spark):
    """Short, long and very long stays and prices, dirty dates, prices without an amount, many prices of equal dates: against plain sums, with
    and without rows of equal dates summed up first. What is found isn't gathered again."""
    rng = random.Random(8)
    prices = [("hot", "R", "A", "BB", "Y", DAY, DAY + dt.timedelta(days=9), 7.0)] * 300
    for i in range(400):
        lo = DAY + dt.timedelta(days=rng.choice([rng.randint(-90, 90), rng.randint(-9_000, 9_000)]))
        hi = rng.choice([lo + dt.timedelta(days=rng.choice([0, -4, 1, 5, 60, 400, 3000])), dt.date(9999, 12, 31), None])
        prices.append((rng.choice(["hot", "b", None]), rng.choice(["R", "S", None]), "A", "BB", rng.choice("YN"), lo, hi, rng.choice([None, 1.0, 2.5])))
    asked = [(i, rng.choice(["hot", "b"]), lo, lo + dt.timedelta(days=rng.choice([1, 3, 9, 64, 65, 1024, 1025, 9000, 0])))
             for i in range(60) for lo in [DAY + dt.timedelta(days=rng.randint(-600, 600))]]
    asked += [(60, "hot", dt.date(1, 1, 1), dt.date(9999, 12, 31)), (61, "hot", dt.date(9990, 1, 1), dt.date(9990, 1, 4)), (62, None, DAY, DAY + dt.timedelta(days=1)), (63, "b", None, DAY)]
    cnct = spark.createDataFrame(prices, "file_id string, room_type string, characteristic string, base_board string, is_price_per_pax string, "
                                 "initial_date date, final_date date, amount double").repartition(3)
    requests = spark.createDataFrame(asked, "request_id long, file_id string, check_in date, check_out date")
    want = []
    for i, f, ci, co in asked:
        for room in {p[:5] for p in prices if f and ci and p[0] == f}:
            met = [(max(ci, p[5]), min(co, p[6]), p[7]) for p in prices if p[:5] == room and p[6] and max(ci, p[5]) < min(co, p[6])]
            day = ci
            for lo, hi, _ in sorted(met, key=lambda m: m[:2]):
                day = max(day, hi) if lo <= day else day
            if met and day >= co:
                known = [(hi - lo).days * a for lo, hi, a in met if a is not None]
                want.append((i, *map(str, room), (co - ci).days, sum((hi - lo).days for lo, hi, _ in met), sum(known) if known else None))
    assert len(want) > 40
    for crowded_over in (0, av.CROWDED):
        found = av.rooms_for_requests(cnct, requests, crowded_over=crowded_over)
        got = [(r.request_id, *map(str, [r[c] for c in av.ROOM_KEY]), r.stay_nights, r.sum_nights, None if r.stay_amount is None else float(r.stay_amount))
               for r in found.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    held = av.room_windows(cnct, av.asked_windows(requests), crowded_over=0)
    assert held.agg(F.max(F.size("_held"))).first()[0] < 300  # before: a row a price
    assert av.rooms_for_requests(cnct, requests.limit(0)).count() == 0


@here
def test_list_comes_in_pricing_order(spark):
    rows = QUERIES["rule_order"](spark, SF).collect()
    key = lambda r: (r.cnct_id, r.order == -1, r.order, r.sad_code == "", r.sad_code, r.rule_id == -1, r.rule_id)
    assert len(rows) > 100 and [key(r) for r in rows] == sorted(map(key, rows))


@pytest.mark.parametrize("missing", ["zstandard", "public_tokenizers", "corpus_pipeline", "tariffloom.llm"])
def test_entry_without_the_text_operators(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; from tariffloom.plans.registry import QUERIES; "
            "assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) >= set(QUERIES); print(len(e.queries()))")
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr[-500:]
    assert int(run.stdout) == len(QUERIES)


def files(path):
    return {os.path.relpath(f, path): os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@here
def test_a_changed_contract_rewrites_its_city_only(spark, tmp_path):
    path = str(tmp_path / "cache")
    full = build_cache(DerivedContracts(spark, SF)).persist()
    sinks.write_cache(full, path)
    before = files(path)
    one = full.select("file_id", "country_code", "city_code").distinct().orderBy("file_id").first()
    changed = spark.createDataFrame([(one.file_id,)], "file_id string")
    fresh = full.filter(F.col("file_id") == one.file_id).withColumn("amount", F.col("amount") + 1)
    sinks.refresh_cache(spark, fresh, path, changed)
    want = full.filter(F.col("file_id") != one.file_id).unionByName(fresh).select(*sinks.read_cache(spark, path).columns)
    got = sinks.read_cache(spark, path)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    here_only = f"country_code={one.country_code}/city_code={one.city_code}/"
    after = files(path)
    assert {f: t for f, t in before.items() if here_only not in f} == {f: t for f, t in after.items() if here_only not in f}
    # a contract that is gone: its rows go, and a city without another one goes with them
    sinks.refresh_cache(spark, fresh.limit(0), path, changed)
    assert sinks.read_cache(spark, path).filter(F.col("file_id") == one.file_id).count() == 0
    assert sinks.read_cache(spark, path).count() == full.filter(F.col("file_id") != one.file_id).count()
    full.unpersist()
