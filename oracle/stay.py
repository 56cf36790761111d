"""Expressions that depend on the stay: offers, their guests, their rules."""

from __future__ import annotations

# the stay of the registered queries
IN, OUT, NOW, NIGHTS = "DATE '1998-08-20'", "DATE '1998-08-26'", "DATE '1998-08-01'", 6

TOUCHES = f"initial_date < {OUT} AND final_date > {IN}"
SHARED_NIGHTS = f"date_diff('day', greatest(initial_date, {IN}), least(final_date, {OUT}))"
CENTS = "CAST(round(amount * 100) AS BIGINT)"


def wild(rule: str, value: str) -> str:
    return f"({rule} IS NULL OR {rule} = '' OR {rule} = {value})"


def same_room(rule: str, room: str) -> str:
    return (
        f"{rule}.file_id = {room}.file_id AND {wild(rule + '.room_type', room + '.room_type')} "
        f"AND {wild(rule + '.characteristic', room + '.characteristic')}"
    )


def rule_touches(rule: str) -> str:
    return f"{rule}.initial_date < {OUT} AND {rule}.final_date > {IN}"


def can_book(rule: str) -> str:
    return (
        f"({rule}.application_initial_date IS NULL OR {rule}.application_initial_date < {NOW}) "
        f"AND ({rule}.application_final_date IS NULL OR {rule}.application_final_date > {NOW})"
    )


def mask(prefix: str = "") -> str:
    days = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")
    parts = ", ".join(f"CASE WHEN {prefix}on_{d} = 'Y' THEN '{i}' ELSE '-' END" for i, d in enumerate(days))
    return f"concat_ws(',', {parts})"


# the stay has one night on every weekday but Wednesday
DAYS_ACTED = (
    "CASE WHEN application_type IN ('T', 'U') THEN 1 ELSE "
    + " + ".join(
        f"CASE WHEN on_{d} = 'Y' THEN 1 ELSE 0 END"
        for d in ("sunday", "monday", "tuesday", "thursday", "friday", "saturday")
    )
    + " END"
)


def money(x: str) -> str:
    return f"round({x} + 1e-7::DOUBLE, 4) + 0.0::DOUBLE"


BOARD_AMOUNT = "coalesce(cnsr_amount, 0) <> 0"
BOARD_PERCENT = "coalesce(cnsr_percentage, 0) <> 0"

STAY_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "rooms": (("cnct",), f"""
SELECT file_id, room_type, characteristic, base_board, is_price_per_pax,
       CAST(sum({SHARED_NIGHTS}) AS BIGINT) AS sum_nights,
       CAST(sum({SHARED_NIGHTS} * {CENTS}) AS DOUBLE) / 100 AS stay_amount
FROM cnct WHERE {TOUCHES}
GROUP BY file_id, room_type, characteristic, base_board, is_price_per_pax
HAVING sum({SHARED_NIGHTS}) >= {NIGHTS}"""),
    "sold": (("cnct",), f"""
SELECT file_id, room_type, characteristic, base_board, is_price_per_pax, count(*) AS sum_nights,
       CAST(sum({CENTS}) AS DOUBLE) / 100 AS stay_amount
FROM cnct JOIN (SELECT CAST(range AS DATE) AS night FROM range({IN}, {OUT}, INTERVAL 1 DAY)) n
  ON n.night >= initial_date AND n.night < final_date
GROUP BY file_id, room_type, characteristic, base_board, is_price_per_pax
HAVING count(DISTINCT night) = {NIGHTS}"""),
    "guests": (("ccon",), """
SELECT file_id, pax_id, age,
       CASE WHEN kind = 'child' THEN row_number() OVER (PARTITION BY file_id, kind ORDER BY age, pax_id) END AS child_id,
       CASE WHEN kind = 'infant' THEN row_number() OVER (PARTITION BY file_id, kind ORDER BY age, pax_id) END AS infant_id
FROM (SELECT file_id, pax_id, age,
             CASE WHEN age < minimum_child_age THEN 'infant' WHEN age <= maximum_child_age THEN 'child' ELSE 'adult' END AS kind
      FROM ccon CROSS JOIN (VALUES (1, 30), (2, 30), (3, 5), (4, 1)) AS g(pax_id, age))"""),
    "party": (("guests",), """
SELECT file_id, CAST(count(*) - count(infant_id) AS INTEGER) AS paxes,
       CAST(count(*) - count(infant_id) - count(child_id) AS INTEGER) AS adults,
       CAST(count(child_id) AS INTEGER) AS childes, CAST(count(infant_id) AS INTEGER) AS infants
FROM guests GROUP BY file_id"""),
    "offers": (("sold", "cnha", "ccon", "hotel_supplier", "party"), """
SELECT md5(r.file_id || '.' || r.room_type || '.' || r.characteristic || '.' || r.base_board) AS cnct_id,
       r.*, r.stay_amount / r.sum_nights AS room_amount, c.hotel_code, c.contract_number, c.contract_name,
       h.standard_capacity, h.max_pax, h.max_children, p.paxes, p.adults, p.childes, p.infants
FROM sold r JOIN cnha h USING (file_id, room_type, characteristic) JOIN ccon c USING (file_id)
JOIN hotel_supplier s ON s.supplier_hotel_code = c.hotel_code AND s.supplier_id = 5
JOIN party p USING (file_id)
WHERE p.paxes > 0 AND h.max_pax >= p.paxes AND h.max_children >= p.childes"""),
    "board_match": (("offers", "cnsr", "guests"), f"""
SELECT *, CASE WHEN min_age IS NULL AND max_age IS NULL THEN paxes ELSE n_met END AS billed FROM (
SELECT o.cnct_id, o.file_id, o.contract_number, o.room_type, o.characteristic, o.base_board, o.is_price_per_pax,
       o.room_amount, o.standard_capacity, o.paxes, r.rule_id, r.board_code, r.is_per_pax AS cnsr_is_per_pax,
       r.amount AS cnsr_amount, r.percentage AS cnsr_percentage, r.min_age, r.max_age, {mask('r.')} AS week_days,
       string_agg(CAST(g.pax_id AS VARCHAR), ',' ORDER BY g.pax_id) AS guests_met,
       CAST(count(*) AS INTEGER) AS n_met
FROM offers o JOIN cnsr r ON {same_room('r', 'o')} AND {rule_touches('r')}
JOIN guests g ON g.file_id = o.file_id AND (r.min_age IS NULL OR r.min_age <= g.age)
             AND (r.max_age IS NULL OR r.max_age >= g.age)
GROUP BY ALL)"""),
    "board_left": (("offers", "board_match"), f"""
SELECT o.cnct_id, o.file_id, o.room_type, o.characteristic, o.base_board, o.is_price_per_pax, o.room_amount,
       o.standard_capacity, o.paxes, b.rule_id, b.board_code, b.cnsr_is_per_pax, b.cnsr_amount, b.cnsr_percentage,
       b.week_days, b.guests_met, b.billed,
       CASE WHEN o.is_price_per_pax = 'N' THEN o.room_amount ELSE 0.0 END AS service_base_price,
       CASE WHEN o.is_price_per_pax = 'Y' THEN o.room_amount / o.paxes ELSE 0.0 END AS pax_base_price,
       CASE WHEN cnsr_is_per_pax = 'N' AND {BOARD_AMOUNT} THEN cnsr_amount
            WHEN cnsr_is_per_pax = 'N' AND {BOARD_PERCENT} AND o.is_price_per_pax = 'N' THEN o.room_amount * cnsr_percentage / 100
            WHEN cnsr_is_per_pax = 'N' AND {BOARD_PERCENT} THEN o.room_amount * o.standard_capacity * cnsr_percentage / 100
            ELSE 0.0 END AS service_base_board_price,
       CASE WHEN cnsr_is_per_pax = 'Y' AND {BOARD_AMOUNT} THEN cnsr_amount * billed
            WHEN cnsr_is_per_pax = 'Y' AND {BOARD_PERCENT} AND o.is_price_per_pax = 'N'
              THEN o.room_amount / o.standard_capacity * cnsr_percentage / 100 * billed
            WHEN cnsr_is_per_pax = 'Y' AND {BOARD_PERCENT} THEN o.room_amount / o.paxes * cnsr_percentage / 100 * billed
            ELSE 0.0 END AS pax_base_board_price
FROM offers o LEFT JOIN board_match b ON b.cnct_id = o.cnct_id"""),
    "cnsu_rows": (("cnsu",), "SELECT *, row_number() OVER () AS uid FROM cnsu"),
    "discount_match": (("offers", "cnsu_rows", "guests"), f"""
SELECT *, CASE WHEN type IN ('N', 'C', 'I', 'F') THEN n_met ELSE 1 END AS times FROM (
SELECT o.cnct_id, o.file_id, o.room_type, o.characteristic, r.uid, r.rule_id, r.code AS sad_code, r."order", r.type,
       r.application_type, r.amount, r.percentage, r.is_per_pax AS cnsu_is_per_pax,
       r.is_cumulative AS cnsu_is_cumulative, r.application_initial_date, {mask('r.')} AS week_days,
       {DAYS_ACTED} AS days, string_agg(CAST(g.pax_id AS VARCHAR), ',' ORDER BY g.pax_id) AS guests_met,
       CAST(count(*) AS INTEGER) AS n_met
FROM offers o JOIN cnsu_rows r ON {same_room('r', 'o')} AND {wild('r.board', 'o.base_board')}
 AND {rule_touches('r')} AND {can_book('r')} AND (r.adults IS NULL OR r.adults <= o.adults)
JOIN guests g ON g.file_id = o.file_id AND CASE r.type
       WHEN 'N' THEN g.child_id = r.pax_order AND g.age >= r.min_age AND g.age <= r.max_age
       WHEN 'F' THEN g.infant_id = r.pax_order AND g.age >= r.min_age AND g.age <= r.max_age ELSE TRUE END
WHERE r.type <> 'C' OR o.standard_capacity < o.paxes
GROUP BY ALL)"""),
    "free_match": (("offers", "cngr"), f"""
SELECT o.cnct_id, r.rule_id, r.frees, r.free_code, r.discount, r.application_base_type, r.application_board_type,
       r.application_discount_type, r.application_stay_type, {mask('r.')} AS week_days
FROM offers o JOIN cngr r ON {same_room('r', 'o')} AND {wild('r.board', 'o.base_board')}
 AND {rule_touches('r')} AND {can_book('r')} AND r.min_days < {NIGHTS} AND r.max_days > {NIGHTS}"""),
    "listed": (("offers", "board_left", "discount_match", "free_match"), f"""
SELECT 'cnsr' AS sad_name, cnct_id, rule_id, NULL AS sad_code, -100000 AS "order" FROM board_left
UNION ALL
SELECT 'cnsu', o.cnct_id, d.rule_id, d.sad_code, d."order" FROM offers o LEFT JOIN discount_match d USING (cnct_id)
UNION ALL
SELECT 'cngr', o.cnct_id, f.rule_id, f.free_code, 100000 FROM offers o LEFT JOIN free_match f USING (cnct_id)"""),
    "doomed": (("listed", "cnoe", "offers"), """
SELECT DISTINCT l.cnct_id, l.sad_code
FROM (SELECT DISTINCT cnct_id, file_id, sad_code FROM listed JOIN offers USING (cnct_id) WHERE sad_code IS NOT NULL) l
JOIN cnoe p ON p.file_id = l.file_id AND p.code2 = l.sad_code
WHERE (p.is_included = 'Y') = EXISTS (SELECT 1 FROM listed q WHERE q.cnct_id = l.cnct_id AND q.sad_code = p.code1)"""),
    "base": (("board_left",), f"""
SELECT cnct_id, file_id, room_type, characteristic, base_board, is_price_per_pax AS room_flag, paxes AS p,
       standard_capacity AS c, {NIGHTS} AS n, max(service_base_price) AS sbp_1, max(pax_base_price) * paxes AS pbp_1,
       sum(service_base_board_price) AS sbbp_1, sum(pax_base_board_price) AS pbbp_1,
       max(cnsr_is_per_pax) AS board_flag
FROM board_left GROUP BY cnct_id, file_id, room_type, characteristic, base_board, is_price_per_pax, paxes, standard_capacity"""),
    # what may be served in a contract: the own board of a price row, or a supplementary board under a rule
    "servings": (("ccon", "cnsr"), """
SELECT file_id, TRUE AS own, NULL AS board_code, 0.0::DOUBLE AS amount, 0.0::DOUBLE AS percentage, '' AS by_guest, 0 AS age_from,
       0 AS age_to, '' AS room_type, '' AS characteristic, NULL AS rate, NULL::DATE AS initial_date, NULL::DATE AS final_date
FROM ccon
UNION ALL
SELECT file_id, FALSE, board_code, coalesce(amount, 0), coalesce(percentage, 0), is_per_pax, min_age, max_age + 1, room_type,
       characteristic, CAST(rate AS VARCHAR), initial_date, final_date
FROM cnsr WHERE board_code IS NOT NULL"""),
    # a price row with its own board, and with each board whose rule names the room, shares a night and has its rate
    "cache": (("cnct", "ccon", "cnha", "hotel_supplier", "servings"), f"""
SELECT t.file_id, md5(concat_ws('.', c.contract_name, c.contract_number, t.room_type, t.characteristic, coalesce(v.board_code, t.base_board))) AS rt_id,
       h.country_code, h.city_code, c.hotel_code, c.contract_name, c.contract_number,
       concat_ws('.', t.room_type, t.characteristic) AS room_type_id, concat_ws('-', t.base_board, c.company_code) AS meal_type,
       t.room_type, t.characteristic, coalesce(t.generic_rate, t.specific_rate) AS rate, coalesce(v.board_code, t.base_board) AS board,
       v.amount AS cnsr_amount, v.percentage AS cnsr_percentage, v.by_guest AS cnsr_is_per_pax,
       t.initial_date AS lo, t.final_date AS hi, c.currency AS currency_code, 0 AS adult_price, 0 AS child_price,
       t.amount, t.is_price_per_pax, 0 AS min_nights, a.standard_capacity, a.min_pax, a.max_pax, a.max_adult,
       a.max_children, a.max_infant, a.min_adult, a.min_children,
       concat('[', c.minimum_child_age, ',', c.maximum_child_age + 1, ')') AS childe_ages,
       concat('[', coalesce(v.age_from::VARCHAR, ''), ',', coalesce(v.age_to::VARCHAR, ''), ')') AS cnsr_pax_ages,
       v.age_from AS age_from, v.age_to AS age_to, c.minimum_child_age AS child_from, c.maximum_child_age AS child_to
FROM cnct t JOIN servings v ON {same_room('v', 't')} AND (v.own OR (
       v.rate = coalesce(t.generic_rate, nullif(t.specific_rate, '0')) AND t.initial_date < v.final_date AND v.initial_date < t.final_date))
JOIN ccon c ON c.file_id = t.file_id
JOIN hotel_supplier h ON h.supplier_hotel_code = c.hotel_code AND h.supplier_id = 5
JOIN cnha a ON a.file_id = t.file_id AND a.room_type = t.room_type AND a.characteristic = t.characteristic"""),
    # the supplier's export: the price of the first night for every night, two parties, two boards, every line twice
    "export": (("cnct",), f"""
SELECT k, suppkey, s_name, n_name, p_type, flag, children, board, copy, (suppkey + cents) % 17 = 0 AS no_number,
       copy = 2 AND (suppkey + cents) % 11 = 0 AS cut, (cents * CASE WHEN flag = 'A' THEN guests ELSE 1 END + extra) * {NIGHTS} AS total
FROM (SELECT CAST(l_suppkey AS VARCHAR) AS k, l_suppkey AS suppkey, p_type, l_returnflag AS flag,
             CAST(min(floor(round(l_extendedprice * 100) / (l_quantity * 10))) AS BIGINT) AS cents
      FROM lineitem JOIN part ON p_partkey = l_partkey
      WHERE l_suppkey % 7 <> 0 AND CAST(l_shipdate AS DATE) <= {IN} AND CAST(l_shipdate AS DATE) + (30 + CAST(l_quantity AS INTEGER)) > {IN}
      GROUP BY l_suppkey, p_type, l_returnflag) p
JOIN supplier ON s_suppkey = suppkey JOIN nation ON n_nationkey = s_nationkey
CROSS JOIN (VALUES ('', 2), ('5 1', 3)) AS party(children, guests)
CROSS JOIN (VALUES (TRUE, 0), (FALSE, 500)) AS served(own, extra)
CROSS JOIN (VALUES (1), (2)) AS copies(copy)
CROSS JOIN LATERAL (SELECT CASE WHEN own THEN CASE WHEN flag = 'N' THEN 'BB' ELSE 'RO' END ELSE 'HB' END AS board) b"""),
    "api": (("export",), """
SELECT CAST(suppkey AS INTEGER) AS req_id, n_name || '_' || (suppkey % 4) AS destination_code, CAST(suppkey AS INTEGER) AS hotel_id,
       k AS contract_number, s_name AS contract_name, '1998-08-20' AS check_in, '1998-08-26' AS check_out, '2' AS adults, children,
       p_type AS room_type, flag AS characteristic, board, total / 100.0::DOUBLE AS amount, 1 AS min_pax
FROM export WHERE NOT no_number AND NOT cut"""),
}


def _party(kind: str, ages: tuple[int, ...]) -> str:
    """Number of guests of a kind by the child ages of a contract, one CASE for each guest."""
    test = {"infant": "{a} < child_from", "child": "{a} BETWEEN child_from AND child_to", "adult": "{a} > child_to"}[kind]
    return "(" + " + ".join(f"CASE WHEN {test.format(a=a)} THEN 1 ELSE 0 END" for a in ages) + ")"


def cached_views(suffix: str, ages: tuple[int, ...]) -> dict[str, tuple[tuple[str, ...], str]]:
    """Search over the cache for a party: what covers the stay, its board terms, its prices."""
    someone = " OR ".join(f"((age_from IS NULL OR age_from <= {a}) AND (age_to IS NULL OR {a} < age_to))" for a in sorted(set(ages)))
    offer = (
        "file_id, rt_id, country_code, city_code, hotel_code, contract_name, contract_number, room_type, characteristic, rate, "
        "board, meal_type, currency_code, is_price_per_pax, childe_ages, standard_capacity, min_pax, max_pax, max_adult, "
        "max_children, max_infant, min_adult, min_children, child_from, child_to, paxes"
    )
    return {
        f"cached{suffix}": (("cache",), f"""
SELECT {offer}, cnsr_amount, cnsr_percentage, cnsr_is_per_pax, age_from, age_to,
       count(*) AS sum_nights, CAST(sum({CENTS}) AS BIGINT) AS stay_cents
FROM (SELECT *, {_party('adult', ages)} + {_party('child', ages)} AS paxes, {_party('adult', ages)} AS adults,
             {_party('child', ages)} AS childes FROM cache) c
JOIN (SELECT CAST(range AS DATE) AS night FROM range({IN}, {OUT}, INTERVAL 1 DAY)) n ON n.night >= lo AND n.night < hi
WHERE min_nights <= {NIGHTS} AND paxes > 0 AND paxes >= min_pax AND paxes <= max_pax
  AND adults >= min_adult AND adults <= max_adult AND childes <= max_children
GROUP BY {offer}, cnsr_amount, cnsr_percentage, cnsr_is_per_pax, age_from, age_to
HAVING count(DISTINCT night) = {NIGHTS}"""),
        f"terms{suffix}": ((f"cached{suffix}",), f"""
SELECT *, CASE WHEN is_price_per_pax = 'Y' THEN nightly * paxes ELSE nightly END AS room
FROM (SELECT *, stay_cents / 100.0::DOUBLE / sum_nights AS nightly FROM cached{suffix}) n
WHERE (age_from = 0 AND age_to = 0) OR {someone}"""),
        f"priced{suffix}": ((f"terms{suffix}",), f"""
SELECT {offer}, sum_nights, stay_cents, max(room) AS room_price, count(*) AS terms,
       sum(CASE WHEN cnsr_amount <> 0 AND cnsr_is_per_pax = 'N' THEN cnsr_amount
                WHEN cnsr_amount <> 0 AND cnsr_is_per_pax = 'Y' THEN cnsr_amount * paxes
                WHEN cnsr_percentage <> 0 AND cnsr_is_per_pax = 'N' AND is_price_per_pax = 'N' THEN room * cnsr_percentage / 100
                WHEN cnsr_percentage <> 0 AND cnsr_is_per_pax = 'Y' AND is_price_per_pax = 'N'
                  THEN room * cnsr_percentage / 100 / standard_capacity * paxes
                WHEN cnsr_percentage <> 0 AND is_price_per_pax = 'Y' THEN room * cnsr_percentage / 100 * standard_capacity
                ELSE 0 END) AS board_price
FROM terms{suffix} GROUP BY {offer}, sum_nights, stay_cents"""),
        f"prices{suffix}": ((f"priced{suffix}",), f"SELECT *, (room_price + board_price) * {NIGHTS} AS price FROM priced{suffix}"),
    }


STAY_VIEWS |= cached_views("", (30, 30)) | cached_views("_family", (1, 5, 30, 30))
