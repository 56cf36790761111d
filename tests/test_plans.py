"""Shape of the physical plans: what is pushed down, what is scanned, what never appears."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from tariffloom.operators import availability as av
from tariffloom.operators import rules
from tariffloom.operators.cache import build_cache
from tariffloom.plans.common import FAMILY
from tariffloom.plans.registry import QUERIES
from tariffloom.sources.derived import DerivedContracts
from tariffloom.sources.stored import StoredContracts, conform

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables are not here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def held(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("contracts")
    made = DerivedContracts(spark, SF)
    for name in ("cnct", "cnsu"):
        df = made.table(name)
        if name == "cnsu":
            df = df.withColumnRenamed("code", "supplement_or_discount_code")
        conform(df, name).write.parquet(str(root / name))
    return StoredContracts(spark, str(root))


def test_stay_dates_reach_the_price_scan(held):
    text = plan(av.available_rooms(held.table("cnct"), FAMILY))
    pushed, read = re.search(r"PushedFilters: \[(.*?)\], ReadSchema: struct<(.*?)>", text).groups()
    assert "LessThan(initial_date" in pushed and "GreaterThan(final_date" in pushed
    # of fifteen columns only those of key, dates and amount are read
    assert {c.split(":")[0] for c in read.split(",")} >= {"file_id", "initial_date", "amount"}
    assert "market_price" not in read and "generic_rate" not in read


def test_rule_dates_reach_the_rule_scan(held):
    text = plan(rules.discount_candidates(held.table("cnsu"), FAMILY))
    assert "LessThanOrEqual(initial_date" in text and "GreaterThanOrEqual(final_date" in text
    assert "LessThan(application_initial_date" in re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)


def test_sums_are_combined_before_the_shuffle(spark):
    text = plan(av.available_rooms(DerivedContracts(spark, SF).table("cnct"), FAMILY))
    assert "partial_sum" in text
    assert len(re.findall("Exchange hashpartitioning", text)) == 1


def test_cache_reads_the_prices_once(spark):
    tables = DerivedContracts(spark, SF)
    text = plan(build_cache(tables))
    priced = [s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", text) if "l_extendedprice" in s]
    assert len(priced) == 1


@pytest.mark.parametrize("name", ["price_fold", "rule_union", "running_price", "board_rules", "superseded_rules",
                                  "or_join", "room_types", "cache_build", "pax_classify", "reconcile_prices"])
def test_no_python_and_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("NestedLoop", "Cartesian", "Python", "Arrow", "MapInPandas"):
        assert bad not in text, bad


def test_no_join_is_forced_and_no_local_folder_used():
    """Joins become broadcasts by measured sizes only; intermediate data goes to the shared folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    hits = []
    for folder, _, files in os.walk(os.path.join(root, "tariffloom")):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as src:
                    hits += [f for line in src if "F.broadcast(" in line or "tempfile" in line]
    assert not hits


def test_whole_list_is_one_shuffle_key_away(spark):
    """The first step of the fold is keyed by offer and piece, never by offer alone."""
    text = plan(QUERIES["price_fold"](spark, SF))
    assert "rangepartitioning(cnct_id" in text
    assert re.search(r"hashpartitioning\(cnct_id#\d+, piece#\d+", text)


def test_literal_ages_are_checked_without_guest_rows(spark):
    text = plan(av.with_party(DerivedContracts(spark, SF).table("ccon"), F.array(F.lit(30), F.lit(5))))
    assert "Generate" not in text and "Window" not in text


def test_left_rule_joins_read_the_offers_once(spark):
    text = plan(QUERIES["board_rules"](spark, SF)).split("Initial Plan")[-1]
    assert text.count("FileScan") <= 15 and text.count("Exchange ") <= 25
