"""Supplier files: broken lines, dates, defaults; the chain of rule families on a hand-made offer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tariffloom import schemas
from tariffloom.operators import chain
from tariffloom.operators import reconcile as rec
from tariffloom.params import Stay
from tariffloom.sources import answers
from tariffloom.sources.sinks import release, stored_root

NAMES = [f.name for f in schemas.API]


def line(**values):
    return ",".join(str(values.get(n, "")) for n in NAMES)


def test_broken_lines_are_kept_apart(spark, tmp_path):
    whole = line(req_id=1, contract_number="7", check_in="20180820", check_out="20180826", amount="12.50", room_type="R", adults=2)
    lines = [
        whole, whole, whole[: len(whole) // 2], whole + ",more", line(req_id="x", amount="1"), line(req_id=2, amount="on request"),
        line(req_id=3, check_in="2018", amount="9"), line(req_id=4, hotel_id="", room_type='"a, b"', amount="-1"), "nonsense",
    ]
    (tmp_path / "a.csv").write_text("\n".join(lines[:4]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join(lines[4:]))
    good, bad = answers.read_answers(spark, str(tmp_path))
    rows = {r.req_id: r for r in good.collect()}
    assert sorted(r.line for r in bad.collect()) == sorted([lines[2], lines[3], lines[4], lines[5], "nonsense"])
    assert good.count() == 4 and set(rows) == {1, 3, 4}
    assert (rows[1].check_in, rows[1].amount, rows[1].contract_number) == (dt.date(2018, 8, 20), 12.5, "7")
    assert rows[3].check_in is None and rows[4].room_type == "a, b"
    # the same lines whatever is read of them
    assert good.select("req_id").count() == good.select("amount", "adults").count() == 4 and bad.select(F.lit(1)).count() == 5
    assert [f.name for f in good.schema] == NAMES


def test_lines_written_are_read_back(spark):
    df = spark.createDataFrame([(1, "R", 3.25, False), (2, "S", 1.0, True)], "id int, room string, amount double, cut boolean")
    sql = answers.answer_line({"req_id": "id", "room_type": "room", "amount": "amount", "children": "'5 1'"}, "cut")
    good, bad = answers.read_answers(spark, answers.write_lines(df.selectExpr(f"{sql} as value")))
    assert [(r.req_id, r.room_type, r.amount, r.children) for r in good.collect()] == [(1, "R", 3.25, "5 1")]
    assert len(bad.collect()) == 1
    assert rec.answers_for(good, dt.date(2018, 1, 1), dt.date(2018, 1, 2)).count() == 0


STAY = Stay(dt.date(2018, 8, 20), dt.date(2018, 8, 26), (30, 30), dt.date(2018, 8, 1))


class Crowded:
    """One offer with 60 board rules, 50 discounts, 40 free nights and 30 stay rules of three bounds: 3.6 million combinations."""

    def __init__(self, spark):
        on = [f"'Y' as {d}" for d in ("on_sunday", "on_monday", "on_tuesday", "on_wednesday", "on_thursday", "on_friday", "on_saturday")]
        rule = ["'f' as file_id", "cast(id as bigint) as rule_id", "'' as room_type", "cast(null as string) as characteristic", "cast(null as string) as board",
                "date'2018-01-01' as initial_date", "date'2018-12-31' as final_date", "cast(null as date) as application_initial_date",
                "cast(null as date) as application_final_date", *on]
        none = ["cast(null as int) as min_age", "cast(null as int) as max_age"]
        self.cnsr = spark.range(60).selectExpr(*rule, "if(id % 2 = 0, 'HB', 'FB') as board_code", "'N' as is_per_pax", "1.5D as amount",
                                               "cast(null as double) as percentage", "cast(null as string) as rate", *none)
        self.cnsu = spark.range(50).selectExpr(*rule, "concat('D', id % 5) as code", "1 as `order`", "'B' as type", "'B' as application_type", "2D as amount",
                                               "cast(null as double) as percentage", "'N' as is_per_pax", "'N' as is_cumulative", "cast(null as int) as adults",
                                               "1 as pax_order", *none)
        self.cngr = spark.range(40).selectExpr(*rule, "1 as min_days", "20 as max_days", "1 as frees", "'F' as free_code", "100D as discount",
                                               *[f"'N' as application_{k}_type" for k in ("base", "board", "discount", "stay")])
        self.cnem = spark.range(30).selectExpr(*rule, "cast(null as date) as application_date", "cast(id % 3 + 5 as int) as minimum_days", "9 as maximum_days")

    def table(self, name):
        return getattr(self, name)


def test_families_are_not_multiplied(spark):
    offers = spark.sql("""SELECT 'o' AS cnct_id, 'f' AS file_id, 1 AS contract_number, 'c' AS contract_name, 'R' AS room_type, 'A' AS characteristic,
        'BB' AS base_board, 'N' AS is_price_per_pax, 100D AS amount, 2 AS standard_capacity, 2 AS paxes, 2 AS adults, 0 AS childes, 0 AS infants,
        array(named_struct('pax_id', 1, 'age', 30, 'child_id', cast(null as int), 'infant_id', cast(null as int)),
              named_struct('pax_id', 2, 'age', 30, 'child_id', cast(null as int), 'infant_id', cast(null as int))) AS guests""")
    rows = chain.priced_chain(offers, Crowded(spark), STAY).collect()
    assert {(r.board, r.minimum_days) for r in rows} == {(b, m) for b in ("BB", "HB", "FB") for m in (5, 6)} and len(rows) == 6
    for r in rows:
        assert (r.n_discounts, r.n_frees) == (50, 40) and r.cnsu_sad.count("type") == 2
        assert r.n_terms == (0 if r.board == "BB" else 30)
        assert r.board_price == (0 if r.board == "BB" else 45) and r.price == (100 + r.board_price) * 6
    forbidden = Stay(dt.date(2018, 8, 20), dt.date(2018, 9, 2), (30, 30), dt.date(2018, 8, 1))
    assert chain.priced_chain(offers, Crowded(spark), forbidden).collect() == []


def test_release_removes_what_was_stored(spark):
    answers.write_lines(spark.createDataFrame([("x",)], "value string"))
    root = spark._jvm.org.apache.hadoop.fs.Path(stored_root(spark))
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    assert fs.exists(root)
    release(spark)
    assert not fs.exists(root)
