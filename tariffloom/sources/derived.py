"""Contract tables derived from the shared star-schema tables.

The shared data holds no contracts, so each contract table is a fixed projection of a shared one: suppliers are
contracts, line items are dated room prices and rules, orders are board rules, and so on. Every derivation is a
plain projection (plus a join to a dimension), so filters on its plain columns, such as the first date, still reach the
Parquet scan; those on computed ones, such as the last date, don't. Amounts are whole cents, so both engines see the same doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffloom.functions.pricing import GENERAL_TYPES, GUEST_TYPES
from tariffloom.functions.weekdays import DAY_FLAGS
from tariffloom.sources.answers import answer_line

# fixed values of the derivation
ROOM_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
CAPACITY = {"ECONOMY": 1, "SMALL": 2, "STANDARD": 2, "PROMO": 2, "MEDIUM": 3, "LARGE": 4}
CHARACTERISTICS = ("A", "N", "R")
CURRENCY = {"AFRICA": "ZAR", "AMERICA": "USD", "ASIA": "JPY", "EUROPE": "EUR", "MIDDLE EAST": "AED"}
BOARD_CODES = {"F": "HB", "O": "FB", "P": "BB"}
APPLICATIONS = ("B", "N", "T", "U", "R", "A", "M")
RULE_TYPES = GUEST_TYPES + GENERAL_TYPES
# fixed values: columns of the shared tables; declared, so opening a table starts no inference job
SHARED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _pick(values: tuple[str, ...], index: str) -> str:
    return f"element_at(array({_list(values)}), cast({index} as int) + 1)"


def _lookup(col: str, table: dict) -> str:
    branches = " ".join(f"when '{k}' then {v!r}" for k, v in table.items())
    return f"case {col} {branches} end"


def _room_wildcard(k: str) -> str:
    """Blank, NULL or a room type in turn: both forms of "any", and a name."""
    return f"case {k} % 3 when 0 then '' when 2 then {_pick(ROOM_TYPES, f'{k} div 3 % 6')} end as room_type"


def _characteristic_wildcard(k: str) -> str:
    named = _pick(CHARACTERISTICS, f"{k} div 21 % 3")
    return f"case {k} div 7 % 3 when 0 then '' when 2 then {named} end as characteristic"


def _board_wildcard(k: str) -> str:
    return f"case {k} div 5 % 4 when 1 then '' when 2 then 'BB' when 3 then 'RO' end as board"


def _weekday_flags(k: str) -> list[str]:
    return [f"if(({k} + {i}) % 5 = 0, 'N', 'Y') as {flag}" for i, flag in enumerate(DAY_FLAGS)]


class DerivedContracts:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def shared(self, name: str) -> DataFrame:
        return self.spark.read.schema(SHARED[name]).parquet(f"{self.dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def _with_contract_count(self, df: DataFrame) -> DataFrame:
        """The number of contracts as a column ``n``: a scalar subquery, not a driver action."""
        return df.withColumn("n", self.shared("supplier").selectExpr("count(1) as n").scalar())

    # --- headers and dimensions -------------------------------------------------------------------------------

    def ccon(self) -> DataFrame:
        s, nation, region = self.shared("supplier"), self.shared("nation"), self.shared("region")
        located = s.join(nation, s.s_nationkey == nation.n_nationkey).join(
            region, nation.n_regionkey == region.r_regionkey
        )
        return located.selectExpr(
            "concat('S', s_suppkey) as file_id",
            "cast(s_suppkey as string) as hotel_code",
            "cast(s_suppkey as int) as contract_number",
            "s_name as contract_name",
            "concat('C', s_suppkey % 3) as company_code",
            f"{_lookup('r_name', CURRENCY)} as currency",
            "2 as minimum_child_age",
            "cast(s_suppkey % 4 + 10 as int) as maximum_child_age",
        )

    def hotel_supplier(self) -> DataFrame:
        s, nation = self.shared("supplier"), self.shared("nation")
        return s.join(nation, s.s_nationkey == nation.n_nationkey).selectExpr(
            "cast(s_suppkey as string) as supplier_hotel_code",
            "if(s_suppkey % 10 = 0, 6, 5) as supplier_id",
            "n_name as country_code",
            "concat(n_name, '_', s_suppkey % 4) as city_code",
        )

    # --- facts ------------------------------------------------------------------------------------------------

    def cnct(self) -> DataFrame:
        item, part = self.shared("lineitem"), self.shared("part")
        return item.join(part, item.l_partkey == part.p_partkey).selectExpr(
            "concat('S', l_suppkey) as file_id",
            "cast(l_suppkey as int) as hotel_id",
            "l_orderkey * 10 + l_linenumber as id",
            "cast(l_shipdate as date) as initial_date",
            "date_add(cast(l_shipdate as date), cast(l_quantity as int) + 30) as final_date",
            "l_linenumber as days",
            "p_type as room_type",
            "l_returnflag as characteristic",
            "if(l_linenumber % 2 = 1, cast(l_linenumber as string), null) as generic_rate",
            "if(l_linenumber % 2 = 0, cast(l_linenumber as string), null) as specific_rate",
            "if(l_returnflag = 'A', 'Y', 'N') as is_price_per_pax",
            "if(l_returnflag = 'N', 'BB', 'RO') as base_board",
            "floor(round(l_extendedprice * 100) / (l_quantity * 10)) / 100D as amount",
        )

    def cnha(self) -> DataFrame:
        rooms = self.cnct().select("file_id", "hotel_id", "room_type", "characteristic").distinct()
        return rooms.selectExpr("*", f"{_lookup('room_type', CAPACITY)} as standard_capacity").selectExpr(
            "*", "1 as min_pax", "standard_capacity + 2 as max_pax", "greatest(2, standard_capacity) as max_adult",
            "2 as max_children", "1 as max_infant", "1 as min_adult", "0 as min_children",
        )

    # --- rules ------------------------------------------------------------------------------------------------

    def cnsr(self) -> DataFrame:
        k, cust = "o_orderkey", "o_custkey"
        return self._with_contract_count(self.shared("orders")).selectExpr(
            f"concat('S', {k} % n) as file_id",
            f"{k} as rule_id",
            "cast(o_orderdate as date) as initial_date",
            "date_add(cast(o_orderdate as date), 180) as final_date",
            f"{_lookup('o_orderstatus', BOARD_CODES)} as board_code",
            "if(substring(o_orderpriority, 1, 1) in ('1', '2'), 'Y', 'N') as is_per_pax",
            f"if({cust} % 4 <> 0, floor(round(o_totalprice * 100) / 10000) / 100D, null) as amount",
            f"if({cust} % 4 = 0, 5D, null) as percentage",
            f"if({k} div 4 % 3 <> 0, cast({k} % 7 + 1 as int), null) as rate",
            _room_wildcard(k), _characteristic_wildcard(k),
            f"case {cust} % 3 when 1 then 0 when 2 then 13 end as min_age",
            f"case {cust} % 3 when 1 then 12 when 2 then 99 end as max_age",
            *_weekday_flags(cust),
        )

    def _item_rules(self, line: int) -> DataFrame:
        """Line items of one number as dated rules with booking window, wildcards and weekdays."""
        k = "l_orderkey"
        return self.shared("lineitem").filter(f"l_linenumber = {line}").selectExpr(
            "*",
            "concat('S', l_suppkey) as file_id",
            f"{k} as rule_id",
            "cast(l_shipdate as date) as initial_date",
            "date_add(cast(l_shipdate as date), 120) as final_date",
            f"if({k} % 4 <> 0, date_sub(cast(l_shipdate as date), 90), null) as application_initial_date",
            f"if({k} % 4 <> 0, date_add(cast(l_shipdate as date), 30), null) as application_final_date",
            _room_wildcard(k), _characteristic_wildcard(k), _board_wildcard(k), *_weekday_flags(k),
        )

    _RULE = ("file_id", "rule_id", "initial_date", "final_date", "application_initial_date", "application_final_date",
             "room_type", "characteristic", "board", *DAY_FLAGS)

    def cnsu(self) -> DataFrame:
        k, part = "l_orderkey", "l_partkey"
        return self._item_rules(1).selectExpr(
            *self._RULE,
            f"concat('D', {part} % 20) as code",
            f"{_pick(RULE_TYPES, f'{part} % 13')} as type",
            f"if({k} div 8 % 2 = 0, 'Y', 'N') as is_per_pax",
            f"if({k} % 17 <> 0, cast(l_quantity as int), null) as order",
            f"{_pick(APPLICATIONS, f'{k} % 7')} as application_type",
            "if(round(l_discount * 100) <= 5, round(l_tax * 100) - 3D, null) as amount",
            "if(round(l_discount * 100) > 5, 0D - round(l_discount * 100), null) as percentage",
            f"if({k} div 16 % 2 = 0, 'Y', 'N') as is_cumulative",
            f"if({k} div 2 % 3 <> 0, cast({k} div 2 % 3 as int), null) as adults",
            f"cast({k} % 2 + 1 as int) as pax_order",
            f"if({k} % 3 = 0, 0, 13) as min_age",
            f"if({k} % 3 = 0, 12, 99) as max_age",
        )

    def cngr(self) -> DataFrame:
        part = "l_partkey"
        return self._item_rules(2).selectExpr(
            *self._RULE,
            "3 as min_days",
            "cast(l_quantity as int) % 20 + 5 as max_days",
            f"cast({part} % 2 + 1 as int) as frees",
            f"concat('F', {part} % 5) as free_code",
            "100D as discount",
            f"{_pick(('N', 'B'), f'{part} % 2')} as application_base_type",
            f"{_pick(('N', 'R'), f'{part} div 2 % 2')} as application_board_type",
            f"{_pick(('N', 'D'), f'{part} div 4 % 2')} as application_discount_type",
            f"{_pick(('A', 'B', 'C'), f'{part} % 3')} as application_stay_type",
        )

    def cnoe(self) -> DataFrame:
        k = "p_partkey"
        return self._with_contract_count(self.shared("part")).selectExpr(
            f"concat('S', {k} % n) as file_id",
            "concat('D', p_size % 20) as code1",
            f"concat('D', (p_size * 7 + {k} div n) % 20) as code2",
            f"if({k} div n % 2 = 0, 'Y', 'N') as is_included",
        )

    def cnem(self) -> DataFrame:
        """Stay rules with wildcards and names, some that don't cover the year, some announced after the search."""
        k = "c_custkey"
        return self._with_contract_count(self.shared("customer")).selectExpr(
            "concat('S', c_custkey % n) as file_id",
            "c_custkey as rule_id",
            f"case {k} % 4 when 1 then date'1998-07-15' when 2 then date'1998-08-15' end as application_date",
            f"if({k} % 5 = 4, date'1998-08-22', date'1998-01-01') as initial_date",
            f"if({k} % 11 = 0, date'1998-08-24', date'1998-12-31') as final_date",
            _room_wildcard(k), _characteristic_wildcard(k), _board_wildcard(k),
            "cast(c_nationkey % 8 as int) as minimum_days",
            "cast(c_nationkey + 7 as int) as maximum_days",
        )

    # --- supplier answers -------------------------------------------------------------------------------------------

    def answer_lines(self, check_in: str, check_out: str) -> DataFrame:
        """Lines of the supplier's export about one stay of two parties, two adults and a family: the price of the first night, for
        every night, with the own board and with half board. Nothing of it comes from this library's prices. One supplier in seven
        doesn't answer; every answer comes twice; some of the second copies are cut, and some amounts are no numbers."""
        nights = f"datediff(date'{check_out}', date'{check_in}')"
        first = self.shared("lineitem").filter(
            f"l_suppkey % 7 <> 0 and l_shipdate < date'{check_in}' + interval 1 day "
            f"and date_add(cast(l_shipdate as date), cast(l_quantity as int) + 30) > date'{check_in}'")
        part, s, nation = self.shared("part"), self.shared("supplier"), self.shared("nation")
        priced = first.join(part, first.l_partkey == part.p_partkey).groupBy("l_suppkey", "p_type", "l_returnflag").agg(
            F.min(F.expr("cast(floor(round(l_extendedprice * 100) / (l_quantity * 10)) as bigint)")).alias("cents"))
        located = priced.join(s, priced.l_suppkey == s.s_suppkey).join(nation, s.s_nationkey == nation.n_nationkey)
        asked = located.selectExpr("*", "inline(array(struct('' as children, 2 as guests), struct('5 1' as children, 3 as guests)))").selectExpr(
            "*", "inline(array(struct(if(l_returnflag = 'N', 'BB', 'RO') as board, 0 as extra), struct('HB' as board, 500 as extra)))").selectExpr(
            "*", f"(cents * if(l_returnflag = 'A', guests, 1) + extra) * {nights} as total", "explode(array(1, 2)) as copy")
        values = {
            "req_id": "l_suppkey", "destination_code": "concat(n_name, '_', l_suppkey % 4)", "hotel_id": "l_suppkey",
            "contract_number": "l_suppkey", "contract_name": "s_name", "check_in": f"'{check_in.replace('-', '')}'",
            "check_out": f"'{check_out.replace('-', '')}'", "adults": "'2'", "children": "children", "room_type": "p_type",
            "characteristic": "l_returnflag", "board": "board", "min_pax": "1",
            "amount": "if((l_suppkey + cents) % 17 = 0, 'on request', concat(total div 100, '.', lpad(total % 100, 2, '0')))",
        }
        return asked.selectExpr(f"{answer_line(values, 'copy = 2 and (l_suppkey + cents) % 11 = 0')} as value")

    # --- room dictionary --------------------------------------------------------------------------------------

    def rt_dic(self) -> DataFrame:
        rooms = self.cnct().select("room_type", "characteristic").distinct()
        first_part = self.shared("part").groupBy(F.col("p_type").alias("room_type")).agg(
            F.upper(F.min_by("p_name", "p_partkey")).alias("first_name")
        )
        return rooms.join(first_part, "room_type").selectExpr(
            "room_type", "characteristic", "if(characteristic in ('A', 'R'), first_name, null) as title",
            "concat(room_type, ' ROOM') as rt_title",
        )

    def room_type_names(self) -> DataFrame:
        return self.shared("part").selectExpr("substring_index(p_name, ' ', 1) as name_en").distinct()

    # --- booking requests: one party and stay per order ---------------------------------------------------------

    def requests(self) -> DataFrame:
        k = "o_orderkey"
        return self._with_contract_count(self.shared("orders")).selectExpr(
            f"{k} as request_id",
            "concat('S', o_custkey % n) as file_id",
            "cast(o_orderdate as date) as check_in",
            f"date_add(cast(o_orderdate as date), cast({k} % 14 + 1 as int)) as check_out",
            f"array(30, 30, cast(o_custkey % 18 as int), cast({k} div 14 % 6 as int)) as ages",
        )
