"""The contract tables as SQL common table expressions over the shared tables."""

from __future__ import annotations

DAYS = ("on_sunday", "on_monday", "on_tuesday", "on_wednesday", "on_thursday", "on_friday", "on_saturday")


def _flags(k: str) -> str:
    return ", ".join(f"CASE WHEN ({k} + {i}) % 5 = 0 THEN 'N' ELSE 'Y' END AS {d}" for i, d in enumerate(DAYS))


def _room(k: str) -> str:
    return (
        f"CASE {k} % 3 WHEN 0 THEN '' WHEN 2 THEN "
        f"CASE ({k} // 3) % 6 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'LARGE' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'PROMO' "
        f"WHEN 4 THEN 'SMALL' ELSE 'STANDARD' END END"
    )


def _characteristic(k: str) -> str:
    return (
        f"CASE ({k} // 7) % 3 WHEN 0 THEN '' WHEN 2 THEN "
        f"CASE ({k} // 21) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END END"
    )


def _board(k: str) -> str:
    return f"CASE ({k} // 5) % 4 WHEN 1 THEN '' WHEN 2 THEN 'BB' WHEN 3 THEN 'RO' END"


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "n_contracts": ((), "SELECT count(*) AS n FROM supplier"),
    "ccon": ((), """
SELECT 'S' || s_suppkey AS file_id, CAST(s_suppkey AS VARCHAR) AS hotel_code, CAST(s_suppkey AS INTEGER) AS contract_number,
       s_name AS contract_name, 'C' || (s_suppkey % 3) AS company_code,
       CASE r_name WHEN 'AFRICA' THEN 'ZAR' WHEN 'AMERICA' THEN 'USD' WHEN 'ASIA' THEN 'JPY' WHEN 'EUROPE' THEN 'EUR'
                   WHEN 'MIDDLE EAST' THEN 'AED' END AS currency,
       2 AS minimum_child_age, CAST(10 + s_suppkey % 4 AS INTEGER) AS maximum_child_age
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "hotel_supplier": ((), """
SELECT CAST(s_suppkey AS VARCHAR) AS supplier_hotel_code, CASE WHEN s_suppkey % 10 = 0 THEN 6 ELSE 5 END AS supplier_id,
       n_name AS country_code, n_name || '_' || (s_suppkey % 4) AS city_code
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    "cnct": ((), """
SELECT 'S' || l_suppkey AS file_id, CAST(l_suppkey AS INTEGER) AS hotel_id, l_orderkey * 10 + l_linenumber AS id,
       CAST(l_shipdate AS DATE) AS initial_date,
       CAST(l_shipdate AS DATE) + (30 + CAST(l_quantity AS INTEGER)) AS final_date,
       l_linenumber AS days, p_type AS room_type, l_returnflag AS characteristic,
       CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_linenumber AS VARCHAR) END AS generic_rate,
       CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber AS VARCHAR) END AS specific_rate,
       CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS is_price_per_pax,
       CASE WHEN l_returnflag = 'N' THEN 'BB' ELSE 'RO' END AS base_board,
       floor(round(l_extendedprice * 100) / (l_quantity * 10)) / 100.0::DOUBLE AS amount
FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "cnha": (("cnct",), """
SELECT file_id, hotel_id, room_type, characteristic, standard_capacity, 1 AS min_pax, standard_capacity + 2 AS max_pax,
       greatest(2, standard_capacity) AS max_adult, 2 AS max_children, 1 AS max_infant, 1 AS min_adult, 0 AS min_children
FROM (SELECT DISTINCT file_id, hotel_id, room_type, characteristic,
             CASE room_type WHEN 'ECONOMY' THEN 1 WHEN 'MEDIUM' THEN 3 WHEN 'LARGE' THEN 4 ELSE 2 END AS standard_capacity
      FROM cnct)"""),
    "cnsr": (("n_contracts",), f"""
SELECT 'S' || (o_orderkey % n) AS file_id, o_orderkey AS rule_id, CAST(o_orderdate AS DATE) AS initial_date,
       CAST(o_orderdate AS DATE) + 180 AS final_date,
       CASE o_orderstatus WHEN 'F' THEN 'HB' WHEN 'O' THEN 'FB' WHEN 'P' THEN 'BB' END AS board_code,
       CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'Y' ELSE 'N' END AS is_per_pax,
       CASE WHEN o_custkey % 4 <> 0 THEN floor(round(o_totalprice * 100) / 10000) / 100.0::DOUBLE END AS amount,
       CASE WHEN o_custkey % 4 = 0 THEN 5.0::DOUBLE END AS percentage,
       CASE WHEN (o_orderkey // 4) % 3 <> 0 THEN CAST(o_orderkey % 7 + 1 AS INTEGER) END AS rate,
       {_room('o_orderkey')} AS room_type, {_characteristic('o_orderkey')} AS characteristic,
       CASE o_custkey % 3 WHEN 1 THEN 0 WHEN 2 THEN 13 END AS min_age,
       CASE o_custkey % 3 WHEN 1 THEN 12 WHEN 2 THEN 99 END AS max_age,
       {_flags('o_custkey')}
FROM orders CROSS JOIN n_contracts"""),
    "cnsu": ((), f"""
SELECT 'S' || l_suppkey AS file_id, l_orderkey AS rule_id, CAST(l_shipdate AS DATE) AS initial_date,
       CAST(l_shipdate AS DATE) + 120 AS final_date,
       CASE WHEN l_orderkey % 4 <> 0 THEN CAST(l_shipdate AS DATE) - 90 END AS application_initial_date,
       CASE WHEN l_orderkey % 4 <> 0 THEN CAST(l_shipdate AS DATE) + 30 END AS application_final_date,
       'D' || (l_partkey % 20) AS code, substr('NCIFBKULMOEVG', CAST(l_partkey % 13 + 1 AS INTEGER), 1) AS type,
       CASE WHEN (l_orderkey // 8) % 2 = 0 THEN 'Y' ELSE 'N' END AS is_per_pax,
       CASE WHEN l_orderkey % 17 <> 0 THEN CAST(l_quantity AS INTEGER) END AS "order",
       substr('BNTURAM', CAST(l_orderkey % 7 + 1 AS INTEGER), 1) AS application_type,
       CASE WHEN round(l_discount * 100) <= 5 THEN round(l_tax * 100) - 3.0::DOUBLE END AS amount,
       CASE WHEN round(l_discount * 100) > 5 THEN 0.0::DOUBLE - round(l_discount * 100) END AS percentage,
       CASE WHEN (l_orderkey // 16) % 2 = 0 THEN 'Y' ELSE 'N' END AS is_cumulative,
       {_room('l_orderkey')} AS room_type, {_characteristic('l_orderkey')} AS characteristic,
       {_board('l_orderkey')} AS board,
       CASE WHEN (l_orderkey // 2) % 3 <> 0 THEN CAST((l_orderkey // 2) % 3 AS INTEGER) END AS adults,
       CAST(l_orderkey % 2 + 1 AS INTEGER) AS pax_order,
       CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE 13 END AS min_age, CASE WHEN l_orderkey % 3 = 0 THEN 12 ELSE 99 END AS max_age,
       {_flags('l_orderkey')}
FROM lineitem WHERE l_linenumber = 1"""),
    "cngr": ((), f"""
SELECT 'S' || l_suppkey AS file_id, l_orderkey AS rule_id, CAST(l_shipdate AS DATE) AS initial_date,
       CAST(l_shipdate AS DATE) + 120 AS final_date,
       CASE WHEN l_orderkey % 4 <> 0 THEN CAST(l_shipdate AS DATE) - 90 END AS application_initial_date,
       CASE WHEN l_orderkey % 4 <> 0 THEN CAST(l_shipdate AS DATE) + 30 END AS application_final_date,
       3 AS min_days, CAST(l_quantity AS INTEGER) % 20 + 5 AS max_days,
       {_room('l_orderkey')} AS room_type, {_characteristic('l_orderkey')} AS characteristic,
       {_board('l_orderkey')} AS board,
       CAST(l_partkey % 2 + 1 AS INTEGER) AS frees, 'F' || (l_partkey % 5) AS free_code, 100.0::DOUBLE AS discount,
       CASE l_partkey % 2 WHEN 0 THEN 'N' ELSE 'B' END AS application_base_type,
       CASE (l_partkey // 2) % 2 WHEN 0 THEN 'N' ELSE 'R' END AS application_board_type,
       CASE (l_partkey // 4) % 2 WHEN 0 THEN 'N' ELSE 'D' END AS application_discount_type,
       CASE l_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS application_stay_type,
       {_flags('l_orderkey')}
FROM lineitem WHERE l_linenumber = 2"""),
    "cnoe": (("n_contracts",), """
SELECT 'S' || (p_partkey % n) AS file_id, 'D' || (p_size % 20) AS code1,
       'D' || ((p_size * 7 + p_partkey // n) % 20) AS code2,
       CASE WHEN (p_partkey // n) % 2 = 0 THEN 'Y' ELSE 'N' END AS is_included
FROM part CROSS JOIN n_contracts"""),
    "cnem": (("n_contracts",), f"""
SELECT 'S' || (c_custkey % n) AS file_id, c_custkey AS rule_id,
       CASE c_custkey % 4 WHEN 1 THEN DATE '1998-07-15' WHEN 2 THEN DATE '1998-08-15' END AS application_date,
       CASE WHEN c_custkey % 5 = 4 THEN DATE '1998-08-22' ELSE DATE '1998-01-01' END AS initial_date,
       CASE WHEN c_custkey % 11 = 0 THEN DATE '1998-08-24' ELSE DATE '1998-12-31' END AS final_date,
       {_room('c_custkey')} AS room_type, {_characteristic('c_custkey')} AS characteristic, {_board('c_custkey')} AS board,
       CAST(c_nationkey % 8 AS INTEGER) AS minimum_days, CAST(c_nationkey + 7 AS INTEGER) AS maximum_days
FROM customer CROSS JOIN n_contracts"""),
    "rt_dic": (("cnct",), """
SELECT r.room_type, r.characteristic, CASE WHEN r.characteristic IN ('A', 'R') THEN f.first_name END AS title,
       r.room_type || ' ROOM' AS rt_title
FROM (SELECT DISTINCT room_type, characteristic FROM cnct) r
JOIN (SELECT p_type, upper(p_name) AS first_name FROM part
      QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) = 1) f ON f.p_type = r.room_type"""),
    "room_type_names": ((), "SELECT DISTINCT split_part(p_name, ' ', 1) AS name_en FROM part"),
    "requests": (("n_contracts",), """
SELECT o_orderkey AS request_id, 'S' || (o_custkey % n) AS file_id, CAST(o_orderdate AS DATE) AS check_in,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 + 1 AS INTEGER) AS check_out,
       CAST(o_custkey % 18 AS INTEGER) AS child_a, CAST((o_orderkey // 14) % 6 AS INTEGER) AS child_b
FROM orders CROSS JOIN n_contracts"""),
}


def with_views(body: str, *names: str, extra: dict[str, tuple[tuple[str, ...], str]] | None = None) -> str:
    """Prefix a statement with the expressions it uses, dependencies first."""
    known = {**VIEWS, **(extra or {})}
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for dep in known[name][0]:
            visit(dep)
        done.append(name)

    for name in names:
        visit(name)
    ctes = ",\n".join(f"{n} AS ({known[n][1]})" for n in done)
    if body.lstrip().upper().startswith("WITH RECURSIVE "):
        rest = body.lstrip()[len("WITH RECURSIVE "):]
        return f"WITH RECURSIVE {ctes},\n{rest}"
    if body.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes},\n{body.lstrip()[5:]}"
    return f"WITH {ctes}\n{body}"
