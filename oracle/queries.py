"""One SQL statement per registered query."""

from __future__ import annotations

from oracle.stay import (
    CENTS, DAYS_ACTED, IN, NIGHTS, NOW, OUT, SHARED_NIGHTS, STAY_VIEWS, TOUCHES, can_book, mask, money, rule_touches,
    same_room, wild,
)
from oracle.views import with_views


def _sql(body: str, *names: str) -> str:
    return with_views(body, *names, extra=STAY_VIEWS)


def _text(col: str, name: str | None = None) -> str:
    return f"strftime({col}, '%Y-%m-%d') AS {name or col.split('.')[-1]}"


def _overlaps(a: str, b: str, c: str, d: str) -> str:
    lo1, hi1, lo2, hi2 = f"least({a}, {b})", f"greatest({a}, {b})", f"least({c}, {d})", f"greatest({c}, {d})"
    return (
        f"CASE WHEN {lo1} = {lo2} THEN 1 WHEN {lo1} > {lo2} AND {lo1} < {hi2} THEN 1 "
        f"WHEN {lo2} > {lo1} AND {lo2} < {hi1} THEN 1 ELSE 0 END"
    )


ROOM_MD5 = "md5(file_id || room_type || characteristic || base_board)"
ROOM_KEY_MD5 = "md5(file_id || '.' || room_type || '.' || characteristic || '.' || base_board)"
ID = "CAST('0x' || substr(md5(file_id || '.' || room_type || '.' || characteristic || '.' || base_board), 1, 15) AS BIGINT)"

SCANS = {
    "stay_availability": _sql("""
SELECT s.country_code, s.city_code, r.file_id, c.contract_name, r.room_type, r.characteristic, r.base_board,
       r.is_price_per_pax, h.standard_capacity, r.sum_nights, r.stay_amount
FROM rooms r JOIN cnha h USING (file_id, room_type, characteristic) JOIN ccon c USING (file_id)
JOIN hotel_supplier s ON s.supplier_hotel_code = c.hotel_code
WHERE s.supplier_id = 5 AND s.city_code LIKE 'NATION_1%' AND 2 BETWEEN h.min_pax AND h.max_pax
  AND 2 BETWEEN h.min_adult AND h.max_adult""", "rooms", "cnha", "ccon", "hotel_supplier"),
    "scan_contracts": _sql(f"""
SELECT file_id, hotel_id, id, {_text('initial_date')}, {_text('final_date')}, room_type, characteristic,
       coalesce(generic_rate, '') AS generic_rate, is_price_per_pax, coalesce(specific_rate, '') AS specific_rate,
       base_board, amount FROM cnct""", "cnct"),
    "scan_api_answers": _sql("SELECT * FROM api", "api"),
    "rejected_answers": _sql("""
SELECT CASE WHEN cut THEN substr(line, 1, len(line) // 2) ELSE line END AS line FROM (
SELECT *, k || ',' || n_name || '_' || (suppkey % 4) || ',' || k || ',,,' || k || ',' || s_name || ',,19980820,19980826,2,' || children || ',' || p_type
       || ',' || flag || ',' || board || repeat(',', 16) || CASE WHEN no_number THEN 'on request' ELSE (total // 100) || '.' || lpad(CAST(total % 100 AS VARCHAR), 2, '0') END
       || ',,1' || repeat(',', 5) AS line FROM export) WHERE cut OR no_number""", "export"),
    "key_violations": _sql("""
SELECT 'ccon' AS table_name, file_id AS key, count(*) AS n FROM ccon GROUP BY file_id HAVING count(*) > 1 OR file_id IS NULL
UNION ALL
SELECT 'cnct', CAST(id AS VARCHAR), count(*) FROM cnct GROUP BY id HAVING count(*) > 1 OR id IS NULL
UNION ALL
SELECT 'cnha', file_id || '|' || room_type || '|' || characteristic, count(*) FROM cnha
GROUP BY file_id, room_type, characteristic HAVING count(*) > 1""", "ccon", "cnct", "cnha"),
    "rule_load": _sql(" UNION ALL ".join(f"""
SELECT '{name}' AS table_name, file_id, CAST(rules AS BIGINT) AS rules,
       CAST(sum(rules) OVER (ORDER BY file_id) - rules + 1 AS BIGINT) AS first_id,
       CAST(sum(rules) OVER (ORDER BY file_id) AS BIGINT) AS last_id, different, most_copies
FROM (SELECT file_id, sum(n) AS rules, count(*) AS different, max(n) AS most_copies
      FROM (SELECT * EXCLUDE (rule_id), count(*) AS n FROM {name} GROUP BY ALL) GROUP BY file_id)"""
        for name in ("cnsr", "cnsu", "cngr", "cnem")), "cnsr", "cnsu", "cngr", "cnem"),
    "parse_dates": _sql(f"""
SELECT rule_id, CASE WHEN rule_id % 11 <> 0 THEN strftime(initial_date, '%Y-%m-%d') END AS initial_date,
       {_text('final_date')} FROM cnsr""", "cnsr"),
    "interval_column": _sql("""
SELECT id, strftime(initial_date + days, '%Y-%m-%d') AS lo, strftime(initial_date + days + 1, '%Y-%m-%d') AS hi,
       CAST(date_diff('day', initial_date, final_date) AS INTEGER) AS valid_nights FROM cnct""", "cnct"),
    "overlap_filter": _sql(f"""
SELECT rule_id, file_id, {_overlaps('initial_date', 'final_date', IN, OUT)} AS as_given,
       {_overlaps('final_date', 'initial_date', OUT, IN)} AS reversed_ends,
       {_overlaps('initial_date', 'initial_date', IN, OUT)} AS start_instant,
       {_overlaps('final_date', 'final_date', IN, OUT)} AS end_instant FROM cnsr""", "cnsr"),
    "range_intersect_nights": _sql(f"""
SELECT id, CAST({SHARED_NIGHTS} AS INTEGER) AS nights, {money(SHARED_NIGHTS + ' * amount')} AS price
FROM cnct WHERE {TOUCHES}""", "cnct"),
    "stay_containment": _sql(f"""
SELECT rule_id, file_id, CASE WHEN initial_date < {IN} AND final_date > {OUT} THEN 1 ELSE 0 END AS strict
FROM cnsr WHERE initial_date <= {IN} AND final_date >= {OUT}""", "cnsr"),
    "rule_valid_on_date": _sql(f"""
SELECT rule_id, file_id, {_text('initial_date')}, {_text('final_date')} FROM cnsr
WHERE initial_date < {IN} AND final_date > {IN}""", "cnsr"),
    "nightly_expand": _sql(f"""
SELECT {ROOM_MD5} AS cnct_id, file_id, strftime(initial_date + days, '%Y-%m-%d') AS initial_date,
       strftime(initial_date + days + 1, '%Y-%m-%d') AS final_date, room_type, characteristic, base_board, amount
FROM cnct""", "cnct"),
    "coverage_having": _sql(f"""
SELECT file_id, room_type, characteristic, base_board, is_price_per_pax, count(DISTINCT night) AS covered_nights,
       count(*) AS priced_nights, CAST(sum({CENTS}) AS DOUBLE) / 100 AS amount
FROM cnct JOIN (SELECT CAST(range AS DATE) AS night FROM range({IN}, {OUT}, INTERVAL 1 DAY)) n
  ON n.night >= initial_date AND n.night < final_date
GROUP BY file_id, room_type, characteristic, base_board, is_price_per_pax
HAVING count(DISTINCT night) = {NIGHTS}""", "cnct"),
    "distinct_on": _sql(f"""
SELECT DISTINCT ON (cnct_id) cnct_id, {_text('initial_date')}, {_text('final_date')}, id, amount
FROM (SELECT {ROOM_MD5} AS cnct_id, initial_date, final_date, id, amount FROM cnct WHERE {TOUCHES})
ORDER BY cnct_id, initial_date, id, final_date, amount""", "cnct"),
    "top_offers": _sql("""
SELECT * FROM rooms ORDER BY stay_amount DESC, file_id, room_type, characteristic, base_board LIMIT 100""", "rooms"),
    "city_prefix": _sql("SELECT * FROM hotel_supplier WHERE supplier_id = 5 AND city_code LIKE 'NATION_1%'",
                        "hotel_supplier"),
    "surrogate_id": _sql(f"SELECT {ID} AS id, file_id, room_type, characteristic, base_board, sum_nights FROM rooms",
                         "rooms"),
}

REQUEST_GUESTS = """
WITH g AS (
  SELECT request_id, file_id, age, row_number() OVER (PARTITION BY request_id ORDER BY age DESC) AS pax_id
  FROM (SELECT request_id, file_id, unnest([30, 30, child_a, child_b]) AS age FROM requests))"""

CLASSIFIED = REQUEST_GUESTS + """,
k AS (SELECT g.*, CASE WHEN age < minimum_child_age THEN 'infant' WHEN age <= maximum_child_age THEN 'child' ELSE 'adult' END AS kind
      FROM g JOIN ccon USING (file_id))"""

GUESTS = {
    "pax_table": _sql(REQUEST_GUESTS + " SELECT request_id, CAST(pax_id AS INTEGER) AS pax_id, age FROM g", "requests"),
    "pax_in_range": _sql("""
SELECT rule_id,
       CAST(count(*) FILTER (board_code <> 'BB' AND (min_age IS NULL OR min_age <= age) AND (max_age IS NULL OR age <= max_age)) AS INTEGER) AS inside,
       CAST(count(*) FILTER (board_code = 'BB' OR ((min_age IS NULL OR min_age <= age) AND (max_age IS NULL OR age <= max_age))) AS INTEGER) AS allowed
FROM cnsr CROSS JOIN (VALUES (1), (5), (30), (30)) AS g(age) GROUP BY rule_id""", "cnsr"),
    "pax_classify": _sql(CLASSIFIED + """
SELECT request_id, file_id, CAST(pax_id AS INTEGER) AS pax_id, age,
       CAST(count(*) FILTER (kind <> 'infant') OVER w AS INTEGER) AS paxes,
       CAST(count(*) FILTER (kind = 'adult') OVER w AS INTEGER) AS adults,
       CAST(count(*) FILTER (kind = 'child') OVER w AS INTEGER) AS childes,
       CAST(count(*) FILTER (kind = 'infant') OVER w AS INTEGER) AS infants,
       CAST(CASE WHEN kind = 'child' THEN row_number() OVER (PARTITION BY request_id, kind ORDER BY age, pax_id) ELSE 0 END AS INTEGER) AS child_id,
       CAST(CASE WHEN kind = 'infant' THEN row_number() OVER (PARTITION BY request_id, kind ORDER BY age, pax_id) ELSE 0 END AS INTEGER) AS infant_id
FROM k WINDOW w AS (PARTITION BY request_id)""", "requests", "ccon"),
    "age_bands": _sql(CLASSIFIED + """
SELECT request_id, CAST(count(*) FILTER (kind = 'child') AS INTEGER) AS childs,
       coalesce(string_agg(CAST(age AS VARCHAR), ',' ORDER BY age) FILTER (kind = 'child'), '') AS child_ages,
       CAST(count(*) FILTER (kind = 'infant') AS INTEGER) AS infants,
       coalesce(string_agg(CAST(age AS VARCHAR), ',' ORDER BY age) FILTER (kind = 'infant'), '') AS infant_ages,
       CAST(count(*) FILTER (kind = 'adult') AS INTEGER) AS adults
FROM k GROUP BY request_id""", "requests", "ccon"),
    "any_age_match": _sql("""
SELECT rule_id,
       CASE WHEN (min_age IS NULL AND max_age IS NULL) OR (bool_or(min_age <= age) AND bool_or(max_age >= age)) THEN 1 ELSE 0 END AS any_match,
       CASE WHEN bool_or((min_age IS NULL OR min_age <= age) AND (max_age IS NULL OR max_age >= age)) THEN 1 ELSE 0 END AS one_guest_match
FROM cnsr CROSS JOIN (VALUES (1), (5), (30), (30)) AS g(age) GROUP BY rule_id, min_age, max_age""", "cnsr"),
    "occupancy_fit": _sql("""
SELECT file_id, room_type, characteristic, paxes, adults, childes,
       CASE WHEN paxes BETWEEN min_pax AND max_pax AND adults BETWEEN min_adult AND max_adult THEN 1 ELSE 0 END AS fits_between,
       CASE WHEN paxes > 0 AND max_pax >= paxes AND max_children >= childes THEN 1 ELSE 0 END AS fits_capacity,
       CASE WHEN max_pax > paxes THEN 1 ELSE 0 END AS fits_strictly
FROM cnha JOIN party USING (file_id)""", "cnha", "party"),
    "stay_weekdays": _sql("""
SELECT request_id, CAST(dayofweek(night) AS INTEGER) AS bk_day, count(*) AS count_bk_days
FROM (SELECT request_id, unnest(range(check_in, check_out, INTERVAL 1 DAY)) AS night FROM requests)
GROUP BY request_id, dayofweek(night)""", "requests"),
    "weekday_map": _sql("""
SELECT request_id, '{' || string_agg('"' || bk_day || '":"' || n || '"', ',' ORDER BY bk_day) || '}' AS bk_days
FROM (SELECT request_id, dayofweek(night) AS bk_day, count(*) AS n
      FROM (SELECT request_id, unnest(range(check_in, check_out, INTERVAL 1 DAY)) AS night FROM requests)
      GROUP BY request_id, dayofweek(night))
GROUP BY request_id""", "requests"),
    "weekday_mask": _sql(f"SELECT rule_id, {mask()} AS week_days FROM cnsr", "cnsr"),
    "discount_days": _sql(f"SELECT rule_id, code, application_type, {DAYS_ACTED} AS sad_days FROM cnsu", "cnsu"),
}

RULES = {
    "wildcard_rule_match": _sql(f"""
SELECT o.file_id, o.room_type, o.characteristic, r.rule_id, r.code
FROM rooms o JOIN cnsu r ON {same_room('r', 'o')} AND {rule_touches('r')}""", "rooms", "cnsu"),
    "rate_match": _sql(f"""
WITH rated AS (
  SELECT file_id, room_type, characteristic, coalesce(generic_rate, specific_rate) AS rate
  FROM cnct WHERE {TOUCHES} GROUP BY ALL HAVING sum({SHARED_NIGHTS}) >= {NIGHTS})
SELECT o.file_id, o.room_type, o.characteristic, o.rate, r.rule_id, r.board_code
FROM rated o JOIN cnsr r ON {same_room('r', 'o')} AND {rule_touches('r')}
 AND (r.rate IS NULL OR CAST(r.rate AS VARCHAR) = o.rate)""", "cnct", "cnsr"),
    "booking_window": _sql(f"SELECT file_id, rule_id, code, type FROM cnsu r WHERE {can_book('r')}", "cnsu"),
    "rule_eligibility": _sql("SELECT cnct_id, rule_id, sad_code, type, guests_met, times FROM discount_match",
                             "discount_match"),
    "board_rules": _sql("""
SELECT cnct_id, coalesce(rule_id, -1) AS rule_id, coalesce(board_code, '') AS board_code, coalesce(billed, 0) AS billed
FROM board_left""", "board_left"),
    "board_rules_inner": _sql("""
SELECT contract_number, room_type, characteristic, base_board || '-' || board_code AS meal_type, rule_id,
       cnsr_is_per_pax, guests_met FROM board_match""", "board_match"),
    "discount_rules": _sql("""
SELECT o.cnct_id, coalesce(rule_id, -1) AS rule_id, coalesce(sad_code, '') AS sad_code, coalesce("order", -1) AS "order",
       coalesce(application_type, '') AS application_type, coalesce(times, 0) AS times
FROM offers o LEFT JOIN discount_match d USING (cnct_id)""", "offers", "discount_match"),
    "free_night_rules": _sql("""
SELECT o.cnct_id, coalesce(rule_id, -1) AS rule_id, coalesce(free_code, '') AS free_code, coalesce(frees, 0) AS frees
FROM offers o LEFT JOIN free_match f USING (cnct_id)""", "offers", "free_match"),
    "stay_length_rules": _sql(f"""
SELECT o.cnct_id, coalesce(r.rule_id, -1) AS rule_id, coalesce(minimum_days, 0) AS minimum_days,
       coalesce(maximum_days, 0) AS maximum_days
FROM offers o LEFT JOIN cnem r ON {same_room('r', 'o')} AND {wild('r.board', 'o.base_board')}
 AND r.initial_date <= {IN} AND r.final_date >= {OUT} AND (r.application_date IS NULL OR r.application_date < {NOW})
WHERE (minimum_days IS NULL OR minimum_days <= {NIGHTS}) AND (maximum_days IS NULL OR maximum_days >= {NIGHTS})""",
                              "offers", "cnem"),
    "min_nights_rule": _sql("""
SELECT file_id, rule_id, CASE WHEN minimum_days IS NULL OR minimum_days = 0 THEN 0 ELSE minimum_days - 1 END AS min_nights
FROM cnem""", "cnem"),
    "superseded_rules": _sql("""
WITH rows_ AS (
  SELECT cnct_id, CAST(unnest(string_split(guests_met, ',')) AS INTEGER) AS pax_id, "order", sad_code, rule_id, type,
         application_type, application_initial_date, amount, percentage FROM discount_match)
SELECT cnct_id, pax_id, coalesce("order", -1) AS "order", sad_code, rule_id, type, application_type,
       CASE WHEN (lag(type) OVER w = type AND lag(application_type) OVER w = application_type
                  AND lag(application_initial_date) OVER w > application_initial_date)
              OR (lead(type) OVER w = type AND lead(application_type) OVER w = application_type
                  AND lead(application_initial_date) OVER w > application_initial_date) THEN 0 ELSE 1 END AS sad_status
FROM rows_
WINDOW w AS (PARTITION BY cnct_id, pax_id ORDER BY "order" NULLS LAST, sad_code, rule_id, type, application_type,
             application_initial_date NULLS LAST, amount NULLS LAST, percentage NULLS LAST)""", "discount_match"),
    "or_join": _sql(f"""
WITH exact AS (SELECT file_id, room_type, characteristic, count(*) AS n, sum(amount) AS s FROM cnsu
               WHERE room_type IS NOT NULL AND characteristic IS NOT NULL GROUP BY ALL),
by_room AS (SELECT room_type, count(*) AS n, sum(amount) AS s FROM cnsu
            WHERE room_type IS NOT NULL AND characteristic IS NULL GROUP BY ALL),
anywhere AS (SELECT count(*) AS n, sum(amount) AS s FROM cnsu
             WHERE room_type IS NULL AND characteristic IS NULL AND type = 'N'),
hits AS (
  SELECT t.id, coalesce(e.n, 0) + coalesce(b.n, 0) + a.n AS rules,
         coalesce(e.s, 0) + coalesce(b.s, 0) + coalesce(a.s, 0) AS amount
  FROM cnct t LEFT JOIN exact e USING (file_id, room_type, characteristic) LEFT JOIN by_room b ON b.room_type = t.room_type
  CROSS JOIN anywhere a)
SELECT id, rules, greatest(rules, 1) AS copies, {money('amount')} AS rule_amount FROM hits""", "cnct", "cnsu"),
    "prefix_join": _sql("""
SELECT p_partkey, upper(p_name) AS description, coalesce(name_en, '') AS name_en
FROM part LEFT JOIN room_type_names ON starts_with(upper(p_name), upper(name_en))""", "room_type_names"),
    "room_types": _sql("""
WITH titles AS (SELECT DISTINCT room_type, upper(rt_title) AS rt_title FROM rt_dic),
described AS (
  SELECT h.*, CASE WHEN d.title IS NULL THEN t.rt_title ELSE d.title END AS description
  FROM cnha h LEFT JOIN rt_dic d USING (room_type, characteristic) LEFT JOIN titles t ON t.room_type = h.room_type)
SELECT md5(file_id || ':' || room_type || ':' || characteristic) AS rt_id, file_id, room_type, characteristic, description,
       coalesce(name_en, '') AS accommodation_type, standard_capacity, max_pax
FROM described LEFT JOIN room_type_names ON starts_with(description, upper(name_en))""", "cnha", "rt_dic", "room_type_names"),
    "pair_rule_lookup": _sql("""
SELECT file_id, room_type, characteristic, coalesce(cnoe_code1, '') AS cnoe_code1
FROM rooms LEFT JOIN (SELECT file_id, string_agg(code1, ',' ORDER BY code1) AS cnoe_code1 FROM cnoe GROUP BY file_id)
USING (file_id)""", "rooms", "cnoe"),
    "md5_key_join": _sql("""
WITH h AS (SELECT md5(file_id || '.' || room_type || '.' || characteristic) AS cnct_id, standard_capacity, max_pax FROM cnha),
r AS (SELECT md5(file_id || '.' || room_type || '.' || characteristic) AS cnct_id, sum_nights FROM rooms)
SELECT cnct_id, sum_nights, standard_capacity, max_pax FROM r JOIN h USING (cnct_id)""", "rooms", "cnha"),
    "offer_capacity": _sql("""
SELECT file_id, room_type, characteristic, sum_nights, standard_capacity, min_pax, max_pax, max_adult, max_children
FROM rooms JOIN cnha USING (file_id, room_type, characteristic)""", "rooms", "cnha"),
    "first_value_window": _sql(f"""
WITH r AS (SELECT {ROOM_KEY_MD5} AS id, file_id, least(room_type, base_board) || ',' || greatest(room_type, base_board) AS combination FROM rooms)
SELECT DISTINCT file_id, combination, first_value(id) OVER (PARTITION BY file_id, combination ORDER BY id) AS representative
FROM r""", "rooms"),
    "array_member_join": _sql(f"""
WITH r AS (SELECT {ROOM_KEY_MD5} AS id, file_id, room_type, characteristic, base_board,
                  least(room_type, base_board) || ',' || greatest(room_type, base_board) AS combination FROM rooms),
chosen AS (SELECT DISTINCT [first_value(id) OVER (PARTITION BY file_id, combination ORDER BY id)] AS ids FROM r)
SELECT DISTINCT r.* FROM r JOIN (SELECT unnest(ids) AS id FROM chosen) c ON c.id = r.id""", "rooms"),
}

ROW_TERMS = ("service_base_price", "pax_base_price", "service_base_board_price", "pax_base_board_price")

PRICES = {
    "base_price_terms": _sql(f"""
SELECT cnct_id, coalesce(rule_id, -1) AS rule_id, {', '.join(f'{money(c)} AS {c}' for c in ROW_TERMS)}
FROM board_left""", "board_left"),
    "board_price_ladder": _sql(f"""
WITH g AS (
  SELECT id, file_id, room_type, characteristic, is_price_per_pax AS room_flag, amount AS room_amount, standard_capacity AS cap,
         unnest([30, 30]) AS pax_age
  FROM cnct JOIN cnha USING (file_id, room_type, characteristic)
  WHERE max_pax > 2 AND initial_date < {IN} AND final_date > {OUT})
SELECT id, pax_age, coalesce(rule_id, -1) AS rule_id,
       {money('''CASE WHEN coalesce(b.amount, 0) <> 0 THEN b.amount
            WHEN b.is_per_pax = 'Y' AND room_flag = 'Y' THEN room_amount * percentage / 100
            WHEN b.is_per_pax = 'N' AND room_flag = 'N' THEN room_amount * percentage / 100
            WHEN b.is_per_pax = 'Y' THEN room_amount / cap * percentage / 100
            WHEN b.is_per_pax = 'N' THEN room_amount * cap * percentage / 100 ELSE 0.0::DOUBLE END''')} AS bb_price
FROM g LEFT JOIN cnsr b ON b.file_id = g.file_id AND b.room_type = g.room_type AND b.characteristic = g.characteristic
 AND b.initial_date < {IN} AND b.final_date > {IN}
 AND (b.min_age IS NULL OR b.min_age <= pax_age) AND (b.max_age IS NULL OR b.max_age >= pax_age)""", "cnct", "cnha", "cnsr"),
    "base_plus_board": _sql(f"""
SELECT cnct_id,
       {money('max(service_base_price) + max(pax_base_price) + sum(service_base_board_price) + sum(pax_base_board_price)')} AS base_price,
       count(service_base_price) AS c_sbp, count(pax_base_price) AS c_pbp, count(service_base_board_price) AS c_sbbp,
       count(pax_base_board_price) AS c_pbbp, count(*) AS c_all
FROM board_left WHERE rule_id IS NOT NULL GROUP BY cnct_id""", "board_left"),
    "board_terms_array": _sql("""
SELECT cnct_id, '[' || string_agg(CAST(to_json({'amount': cnsr_amount, 'pct': cnsr_percentage, 'flag': cnsr_is_per_pax}) AS VARCHAR), ','
         ORDER BY cnsr_amount NULLS FIRST, cnsr_percentage NULLS FIRST, cnsr_is_per_pax) || ']' AS cnsr_board
FROM board_match GROUP BY cnct_id""", "board_match"),
    "json_terms_read": _sql(f"""
SELECT cnct_id, CAST(count(*) AS INTEGER) AS n_terms,
       list(cnsr_is_per_pax ORDER BY cnsr_amount NULLS FIRST, cnsr_percentage NULLS FIRST, cnsr_is_per_pax)[1] AS first_flag,
       {money('sum(coalesce(cnsr_amount, 0.0::DOUBLE))')} AS amount
FROM board_match GROUP BY cnct_id""", "board_match"),
    "json_rollup": _sql("""
SELECT file_id, '[' || string_agg(CAST(to_json({'code1': code1, 'code2': code2, 'is_included': is_included}) AS VARCHAR), ','
         ORDER BY code1, code2, is_included) || ']' AS cnoe
FROM cnoe GROUP BY file_id""", "cnoe"),
    "json_group_key": _sql("""
WITH j AS (
  SELECT cnct_id, '[' || string_agg(CAST(to_json({'type': type, 'application_type': application_type, 'amount': amount,
           'percentage': percentage}) AS VARCHAR), ',' ORDER BY type, application_type, amount NULLS FIRST, percentage NULLS FIRST) || ']' AS cnsu_sad
  FROM discount_match GROUP BY cnct_id)
SELECT cnsu_sad, count(*) AS offers FROM j GROUP BY cnsu_sad""", "discount_match"),
    "board_grouping_sets": _sql("""
SELECT cnct_id, file_id, coalesce(room_type, '') AS room_type, coalesce(characteristic, '') AS characteristic,
       coalesce(base_board, '') AS base_board, coalesce(board_code, '') AS board_code,
       coalesce(cnsr_is_per_pax, '') AS cnsr_is_per_pax, coalesce(base_board, board_code, '') AS board,
       coalesce(cnsr_amount, 0.0::DOUBLE) AS cnsr_amount, coalesce(cnsr_percentage, 0.0::DOUBLE) AS cnsr_percentage,
       count(*) AS rules, CAST(grouping(base_board) AS INTEGER) AS is_board_row
FROM board_left
GROUP BY GROUPING SETS ((cnct_id, file_id, room_type, characteristic, base_board),
                        (cnct_id, file_id, board_code, cnsr_is_per_pax, cnsr_amount, cnsr_percentage))""", "board_left"),
    "room_board_price": _sql(f"""
SELECT file_id, rt_id, room_type, characteristic, coalesce(rate, '') AS rate, board, sum_nights, stay_cents / 100.0::DOUBLE AS stay_amount, terms,
       {money('room_price')} AS room_price, {money('board_price')} AS board_price FROM priced""", "priced"),
    "room_board_price_flag": _sql(f"""
WITH b AS (SELECT *, CASE WHEN is_price_per_pax = 'Y' THEN room_amount * paxes ELSE room_amount END AS room FROM board_match)
SELECT cnct_id, cnsr_is_per_pax AS flag, CAST(count(*) AS INTEGER) AS n_terms, {money('max(room)')} AS room_price,
       {money('''sum(CASE WHEN coalesce(cnsr_amount, 0) <> 0 AND cnsr_is_per_pax = 'N' THEN cnsr_amount
                WHEN coalesce(cnsr_amount, 0) <> 0 THEN cnsr_amount * paxes
                WHEN coalesce(cnsr_percentage, 0) = 0 THEN 0
                WHEN is_price_per_pax = 'Y' THEN room * cnsr_percentage / 100 * standard_capacity
                WHEN cnsr_is_per_pax = 'N' THEN room * cnsr_percentage / 100
                ELSE room * cnsr_percentage / 100 / standard_capacity * paxes END)''')} AS board_price
FROM b GROUP BY cnct_id, cnsr_is_per_pax""", "board_match"),
}

RULE_ORDER = (
    '"order" NULLS LAST, sad_code, rule_id, type, application_type, amount NULLS LAST, percentage NULLS LAST, days'
)
GUEST = "type IN ('N', 'C', 'I', 'F')"
ON_ROOM, ON_BOARD = "application_type IN ('B', 'N', 'T', 'U')", "application_type IN ('R', 'N', 'T', 'U')"
AMT, PCT = "coalesce(amount, 0) <> 0", "coalesce(amount, 0) = 0 AND coalesce(percentage, 0) <> 0"

# what one rule does to the four prices and to the last general adjustments; s is the rule, f the state before it
NEXT = {
    "pbp": f"""CASE WHEN room_flag <> 'Y' THEN pbp
  WHEN {GUEST} AND {ON_ROOM} AND {AMT} THEN pbp + amount / p * days * times
  WHEN {GUEST} AND {ON_ROOM} AND {PCT} THEN pbp + percentage / 100 * pbp_1 / p * days * times
  WHEN {GUEST} AND application_type = 'A' AND {AMT} THEN pbp + (amount - pbp_1) / p * days * times
  WHEN {GUEST} AND application_type = 'M' AND board_flag = 'N' AND {AMT} THEN pbp + (amount - pbp_1 + pbbp_1) / p * days * times
  WHEN {GUEST} AND application_type = 'M' AND board_flag = 'Y' AND {AMT} THEN pbp + (amount / p - pbp_1 / p + sbbp_1) * days * times
  WHEN {GUEST} THEN pbp
  WHEN {ON_ROOM} AND {AMT} THEN pbp + amount * days
  WHEN {ON_ROOM} AND {PCT} THEN pbp + g_room * percentage / 100
  WHEN application_type = 'A' AND {AMT} THEN amount * days
  WHEN application_type = 'M' AND board_flag = 'N' AND {AMT} THEN (amount + pbbp / p) * days
  WHEN application_type = 'M' AND board_flag = 'Y' AND {AMT} THEN (amount + pbbp) * days ELSE pbp END""",
    "sbp": f"""CASE WHEN room_flag <> 'N' THEN sbp
  WHEN {GUEST} AND {ON_ROOM} AND {AMT} THEN sbp + amount / p * days * times
  WHEN {GUEST} AND {ON_ROOM} AND {PCT} THEN sbp + percentage / 100 * sbp_1 / c * days * times
  WHEN {GUEST} AND application_type = 'A' AND {AMT} THEN sbp + (amount / p - sbp_1 / c) * days * times
  WHEN {GUEST} AND application_type = 'M' AND board_flag = 'N' AND {AMT} THEN sbp + (amount / p - pbp_1 / c + sbbp_1 / c) * days * times
  WHEN {GUEST} AND application_type = 'M' AND board_flag = 'Y' AND {AMT} THEN sbp + (amount / p - pbp_1 / c + pbbp_1) * days * times
  WHEN {GUEST} THEN sbp
  WHEN {ON_ROOM} AND {AMT} THEN sbp + amount * days
  WHEN {ON_ROOM} AND {PCT} THEN sbp + g_room * percentage / 100
  WHEN application_type = 'A' AND {AMT} THEN amount * days
  WHEN application_type = 'M' AND board_flag = 'N' AND {AMT} THEN (amount + sbbp / c) * days
  WHEN application_type = 'M' AND board_flag = 'Y' AND {AMT} THEN (amount + sbbp) * days ELSE sbp END""",
    "pbbp": f"""CASE WHEN coalesce(board_flag, '') <> 'Y' OR NOT ({ON_BOARD}) THEN pbbp
  WHEN {GUEST} AND {AMT} THEN pbbp + amount / p * days * times
  WHEN {GUEST} AND {PCT} THEN pbbp + percentage / 100 * pbbp_1 / p * days * times
  WHEN {GUEST} THEN pbbp WHEN {AMT} THEN pbbp + amount * days
  WHEN {PCT} THEN pbbp + g_board * percentage / 100 ELSE pbbp END""",
    "sbbp": f"""CASE WHEN coalesce(board_flag, '') <> 'N' OR NOT ({ON_BOARD}) THEN sbbp
  WHEN {GUEST} AND {AMT} THEN sbbp + amount / p * days * times
  WHEN {GUEST} AND {PCT} THEN sbbp + percentage / 100 * sbbp_1 / c * days * times
  WHEN {GUEST} THEN sbbp WHEN {AMT} THEN sbbp + amount * days
  WHEN {PCT} THEN sbbp + g_board * percentage / 100 ELSE sbbp END""",
    "g_room": f"""CASE WHEN {GUEST} OR NOT ({ON_ROOM}) THEN g_room WHEN {AMT} THEN amount * days
  WHEN {PCT} THEN g_room * percentage / 100 ELSE g_room END""",
    "g_board": f"""CASE WHEN {GUEST} OR NOT ({ON_BOARD}) OR board_flag IS NULL THEN g_board WHEN {AMT} THEN amount * days
  WHEN {PCT} THEN g_board * percentage / 100 ELSE g_board END""",
}

FOLD = f"""
WITH RECURSIVE steps AS (
  SELECT d.cnct_id, type, application_type, amount, percentage, days, times,
         row_number() OVER (PARTITION BY d.cnct_id ORDER BY {RULE_ORDER}) AS seq
  FROM discount_match d
  WHERE days > 0 AND NOT EXISTS (SELECT 1 FROM doomed x WHERE x.cnct_id = d.cnct_id AND x.sad_code = d.sad_code)),
fold AS (
  SELECT cnct_id, CAST(0 AS BIGINT) AS seq, sbp_1 * n AS sbp, sbbp_1 * n AS sbbp, pbp_1 * n AS pbp, pbbp_1 * n AS pbbp,
         0.0::DOUBLE AS g_room, 0.0::DOUBLE AS g_board FROM base
  UNION ALL
  SELECT f.cnct_id, s.seq, {NEXT['sbp']}, {NEXT['sbbp']}, {NEXT['pbp']}, {NEXT['pbbp']}, {NEXT['g_room']}, {NEXT['g_board']}
  FROM fold f JOIN steps s ON s.cnct_id = f.cnct_id AND s.seq = f.seq + 1 JOIN base b ON b.cnct_id = f.cnct_id)
SELECT b.cnct_id, b.file_id, b.room_type, b.characteristic, b.base_board AS board, {money('sbp')} AS sbprice,
       {money('sbbp')} AS sbbprice, {money('pbp')} AS pbprice, {money('pbbp')} AS pbbprice,
       {money('sbp + sbbp + pbp + pbbp')} AS total_price
FROM base b JOIN fold f ON f.cnct_id = b.cnct_id
JOIN (SELECT cnct_id, max(seq) AS last FROM fold GROUP BY cnct_id) m ON m.cnct_id = f.cnct_id AND m.last = f.seq"""

# the state after every step of the fold, behind the base rows, whose board prices add up
RUNNING = FOLD[:FOLD.index("SELECT b.cnct_id")].replace("percentage, days, times,", "percentage, days, times, sad_code, rule_id, d.\"order\",") + f"""
SELECT cnct_id, 'cnsr' AS sad_name, -100000 AS "order", '' AS sad_code, coalesce(rule_id, -1) AS rule_id, '' AS type, '' AS application_type,
       {money(f'service_base_price * {NIGHTS}')} AS service_base_price,
       {money(f'sum(service_base_board_price) OVER w * {NIGHTS}')} AS service_base_board_price,
       {money(f'pax_base_price * paxes * {NIGHTS}')} AS pax_base_price,
       {money(f'sum(pax_base_board_price) OVER w * {NIGHTS}')} AS pax_base_board_price
FROM board_left
WINDOW w AS (PARTITION BY cnct_id ORDER BY rule_id NULLS LAST, service_base_board_price, pax_base_board_price
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
UNION ALL
SELECT s.cnct_id, 'cnsu', coalesce(s."order", -1), s.sad_code, s.rule_id, s.type, s.application_type,
       {money('f.sbp')}, {money('f.sbbp')}, {money('f.pbp')}, {money('f.pbbp')}
FROM steps s JOIN fold f ON f.cnct_id = s.cnct_id AND f.seq = s.seq"""

PIPELINE = {
    "cache_build": _sql(f"""
SELECT file_id, rt_id, country_code, city_code, hotel_code, contract_name, contract_number, room_type_id, meal_type, room_type,
       characteristic, rate, board, cnsr_amount, cnsr_percentage, cnsr_is_per_pax, {_text('lo')}, {_text('hi')}, currency_code,
       adult_price, child_price, amount, is_price_per_pax, min_nights, standard_capacity, min_pax, max_pax, max_adult,
       max_children, max_infant, min_adult, min_children, childe_ages, cnsr_pax_ages FROM cache""", "cache"),
    "nightly_cache": _sql(f"""
SELECT t.file_id, md5(t.file_id || '.' || t.room_type || '.' || t.characteristic) AS rt_id, s.country_code, s.city_code,
       CAST(c.hotel_code AS INTEGER) AS hotel_code, t.room_type || '.' || t.characteristic AS room_type,
       t.base_board || '-' || c.company_code AS meal_type, {_text('t.initial_date + t.days', 'lo')},
       {_text('t.initial_date + t.days + 1', 'hi')}, c.currency AS currency_code, 0 AS adult_price, 0 AS child_price, t.amount,
       t.is_price_per_pax,
       CASE WHEN r.minimum_days IS NULL OR r.minimum_days = 0 THEN 0 ELSE r.minimum_days - 1 END AS min_nights,
       c.minimum_child_age AS child_from, c.maximum_child_age AS child_to
FROM cnct t JOIN ccon c USING (file_id)
JOIN hotel_supplier s ON s.supplier_hotel_code = c.hotel_code AND s.supplier_id = 5
JOIN cnem r ON r.file_id = t.file_id AND r.room_type = t.room_type AND r.characteristic = t.characteristic""",
                          "cnct", "ccon", "hotel_supplier", "cnem"),
    "rule_union": _sql(f"""
WITH flags AS (SELECT cnct_id, max(cnsr_is_per_pax) AS board_flag FROM board_left GROUP BY cnct_id),
head AS (SELECT cnct_id, file_id, room_type, characteristic, base_board, {NIGHTS} AS rest_nights, paxes, adults, childes,
                infants, standard_capacity, max_pax, max_children, is_price_per_pax AS cnct_is_per_pax, board_flag
         FROM offers JOIN flags USING (cnct_id)),
body AS (
  SELECT 'cnsr' AS sad_name, cnct_id, rule_id, guests_met, week_days, -100000 AS "order", cnsr_is_per_pax AS flag,
         service_base_price, pax_base_price, service_base_board_price, pax_base_board_price, NULL AS sad_code, NULL AS type,
         NULL AS application_type, NULL AS amount, NULL AS percentage, NULL AS cnsu_is_per_pax, NULL AS cnsu_is_cumulative,
         NULL AS frees, NULL AS discount, NULL AS application_base_type, NULL AS application_board_type,
         NULL AS application_discount_type, NULL AS application_stay_type
  FROM board_left
  UNION ALL
  SELECT 'cnsu', o.cnct_id, rule_id, guests_met, week_days, "order", NULL, 0, 0, 0, 0, sad_code, type, application_type, amount,
         percentage, cnsu_is_per_pax, cnsu_is_cumulative, NULL, NULL, NULL, NULL, NULL, NULL
  FROM offers o LEFT JOIN discount_match d USING (cnct_id)
  UNION ALL
  SELECT 'cngr', o.cnct_id, rule_id, NULL, week_days, 100000, NULL, 0, 0, 0, 0, free_code, NULL, NULL, NULL, NULL, NULL, NULL,
         frees, discount, application_base_type, application_board_type, application_discount_type, application_stay_type
  FROM offers o LEFT JOIN free_match f USING (cnct_id))
SELECT sad_name, cnct_id, file_id, room_type, characteristic, base_board, rest_nights, paxes, adults, childes, infants,
       standard_capacity, max_pax, max_children, cnct_is_per_pax, coalesce(rule_id, -1) AS rule_id,
       coalesce(guests_met, '') AS guests_met, coalesce(week_days, '') AS week_days, coalesce("order", -1) AS "order",
       coalesce(frees, 0) AS frees, coalesce(flag, board_flag, '') AS cnsr_is_per_pax,
       {', '.join(f"coalesce({c}, '') AS {c}" for c in (
           'sad_code', 'type', 'application_type', 'cnsu_is_per_pax', 'cnsu_is_cumulative', 'application_base_type',
           'application_board_type', 'application_discount_type', 'application_stay_type'))},
       {', '.join(f"{money(f'coalesce({c}, 0.0::DOUBLE)')} AS {c}" for c in (
           *ROW_TERMS, 'amount', 'percentage', 'discount'))}
FROM body JOIN head USING (cnct_id)""", "offers", "board_left", "discount_match", "free_match"),
    "rule_order": _sql("""
SELECT cnct_id, sad_name, coalesce("order", -1) AS "order", coalesce(sad_code, '') AS sad_code, coalesce(rule_id, -1) AS rule_id
FROM listed ORDER BY cnct_id, listed."order" NULLS LAST, listed.sad_code NULLS LAST, listed.rule_id NULLS LAST""", "listed"),
    "offer_code_list": _sql("""
SELECT cnct_id, string_agg(sad_code, ',' ORDER BY sad_code) AS sad_list FROM listed WHERE sad_code IS NOT NULL GROUP BY cnct_id""",
                            "listed"),
    "drop_incompatible": _sql("""
SELECT cnct_id, sad_name, coalesce(sad_code, '') AS sad_code, coalesce(rule_id, -1) AS rule_id FROM listed l
WHERE NOT EXISTS (SELECT 1 FROM doomed d WHERE d.cnct_id = l.cnct_id AND d.sad_code = l.sad_code)""", "listed", "doomed"),
    "price_fold": _sql(FOLD, "discount_match", "doomed", "base"),
    # the same over the own boards of the cache, where rates are offers of their own
    "cached_price_fold": with_views(FOLD, "discount_match", "doomed", "base", extra={**STAY_VIEWS, "offers": (("cache", "party"), f"""
SELECT md5(o.file_id || '.' || o.room_type || '.' || o.characteristic || '.' || o.base_board || '.' || coalesce(o.rate, '')) AS cnct_id,
       o.*, o.stay_amount / o.sum_nights AS room_amount, p.paxes, p.adults, p.childes, p.infants
FROM (
  SELECT file_id, room_type, characteristic, board AS base_board, is_price_per_pax, rate, hotel_code, contract_number, contract_name,
         standard_capacity, max_pax, max_children, count(*) AS sum_nights, CAST(sum({CENTS}) AS DOUBLE) / 100 AS stay_amount
  FROM cache JOIN (SELECT CAST(range AS DATE) AS night FROM range({IN}, {OUT}, INTERVAL 1 DAY)) n ON n.night >= lo AND n.night < hi
  WHERE cnsr_is_per_pax = '' AND age_from = 0 AND age_to = 0 AND city_code LIKE 'NATION_1%'
  GROUP BY file_id, room_type, characteristic, board, is_price_per_pax, rate, hotel_code, contract_number, contract_name,
           standard_capacity, max_pax, max_children
  HAVING count(DISTINCT night) = {NIGHTS}) o
JOIN party p USING (file_id)
WHERE p.paxes > 0 AND o.max_pax >= p.paxes AND o.max_children >= p.childes""")}),
    "running_price": _sql(RUNNING, "discount_match", "doomed", "base", "board_left"),
    "cached_search": _sql(f"""
SELECT file_id, rt_id, city_code, room_type, characteristic, coalesce(rate, '') AS rate, board, sum_nights, terms,
       {money('room_price')} AS room_price, {money('board_price')} AS board_price, {money('price')} AS price
FROM prices WHERE city_code LIKE 'NATION_1%'""", "prices"),
    "cached_search_family": _sql(f"""
SELECT file_id, rt_id, city_code, room_type, characteristic, coalesce(rate, '') AS rate, board, sum_nights, terms,
       {money('room_price')} AS room_price, {money('board_price')} AS board_price, {money('price')} AS price
FROM prices_family""", "prices_family"),
    "search_requests": _sql(f"""
WITH asked AS (
  SELECT q.*, c.contract_name, s.city_code, c.minimum_child_age AS lo, c.maximum_child_age AS hi, date_diff('day', check_in, check_out) AS nights
  FROM requests q JOIN ccon c USING (file_id) JOIN hotel_supplier s ON s.supplier_hotel_code = c.hotel_code AND s.supplier_id = 5),
party AS (
  SELECT request_id, CAST(count(*) FILTER (age >= lo) AS INTEGER) AS paxes, CAST(count(*) FILTER (age > hi) AS INTEGER) AS adults,
         CAST(count(*) FILTER (age BETWEEN lo AND hi) AS INTEGER) AS childes
  FROM (SELECT request_id, lo, hi, unnest([30, 30, child_a, child_b]) AS age FROM asked) GROUP BY request_id),
night AS (SELECT request_id, file_id, nights, CAST(unnest(range(check_in, check_out, INTERVAL 1 DAY)) AS DATE) AS night FROM asked),
sold AS (
  SELECT request_id, n.file_id, room_type, characteristic, base_board, is_price_per_pax, nights, count(*) AS sum_nights,
         CAST(sum({CENTS}) AS DOUBLE) / 100 AS stay_amount
  FROM night n JOIN cnct t ON t.file_id = n.file_id AND n.night >= t.initial_date AND n.night < t.final_date
  GROUP BY ALL HAVING count(DISTINCT night) = nights)
SELECT request_id, file_id, city_code, room_type, characteristic, base_board, is_price_per_pax, sum_nights, stay_amount, paxes, adults, childes,
       {money("stay_amount / sum_nights * CASE WHEN is_price_per_pax = 'Y' THEN paxes ELSE 1 END * s.nights")} AS price
FROM sold s JOIN party USING (request_id) JOIN asked USING (request_id, file_id) JOIN cnha h USING (file_id, room_type, characteristic)
WHERE paxes > 0 AND max_pax >= paxes AND max_children >= childes""", "requests", "ccon", "hotel_supplier", "cnct", "cnha"),
    "discounts_for_stay": _sql(f"""
SELECT t.file_id, t.hotel_id, {_text('t.initial_date')}, {_text('t.final_date')}, t.room_type, t.characteristic,
       t.is_price_per_pax, coalesce(r.is_per_pax, '') AS cnsr_is_per_pax, t.base_board, t.amount, 5 AS age
FROM cnct t JOIN cnha h USING (file_id, room_type, characteristic)
LEFT JOIN cnsr r ON r.file_id = t.file_id AND r.room_type = t.room_type AND r.characteristic = t.characteristic
 AND r.initial_date < {IN} AND r.final_date > {OUT}
WHERE t.initial_date < {OUT} AND t.final_date > {IN}""", "cnct", "cnha", "cnsr"),
    "rule_passthrough": _sql(f"""
SELECT file_id, rule_id, code, type, application_type, pax_order, {_text('initial_date')}, {_text('final_date')}
FROM cnsu ORDER BY file_id, rule_id, code, cnsu.initial_date LIMIT 100""", "cnsu"),
}

# an answer that rounds to the price, then the nearest, then the smaller
NEAREST = (
    "CASE WHEN round_even(api_amount, 0) <> round_even(price, 0) THEN 1 ELSE 0 END, round(abs(api_amount - price), 4), api_amount"
)

CHECKS = {
    "api_dedup": _sql("""
SELECT DISTINCT req_id, check_in, check_out, contract_number, contract_name, room_type, characteristic, board, amount
FROM api WHERE children = ''""", "api"),
    "duplicate_offers": _sql("""
SELECT file_id, hotel_id, room_type, characteristic, is_price_per_pax, coalesce(specific_rate, '') AS specific_rate, base_board,
       amount, count(*) AS n
FROM cnct GROUP BY file_id, hotel_id, room_type, characteristic, is_price_per_pax, specific_rate, base_board, amount
HAVING count(*) > 1""", "cnct"),
    "reconcile_prices": _sql(f"""
WITH a AS (SELECT DISTINCT contract_number, contract_name, room_type, characteristic, board, amount AS api_amount FROM api WHERE children = ''),
p AS (SELECT row_number() OVER () AS n, CAST(contract_number AS VARCHAR) AS contract_number, contract_name, room_type,
             characteristic, board, price FROM prices),
met AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY {NEAREST}) AS place
        FROM p JOIN a USING (contract_number, contract_name, room_type, characteristic, board))
SELECT contract_number, contract_name, room_type, characteristic, board, {money('price')} AS price, api_amount,
       round_even(api_amount, 0) - round_even(price, 0) AS difference
FROM met WHERE place = 1 AND round_even(api_amount, 0) <> round_even(price, 0)""", "api", "prices"),
    "price_check": _sql(f"""
WITH a AS (SELECT DISTINCT contract_number, contract_name, room_type, characteristic, board, amount AS api_amount FROM api WHERE children = ''),
p AS (SELECT row_number() OVER () AS n, CAST(contract_number AS VARCHAR) AS contract_number, contract_name, room_type,
             characteristic, board, room_price, board_price, price FROM prices),
met AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY {NEAREST}) AS place
        FROM p JOIN a USING (contract_number, contract_name, room_type, characteristic, board))
SELECT contract_number, contract_name, room_type, characteristic, board, api_amount, {money('room_price')} AS room_price,
       {money('board_price')} AS board_price, {money('price')} AS price
FROM met WHERE place = 1""", "api", "prices"),
    "missing_from_api": _sql("""
SELECT file_id, CAST(contract_number AS VARCHAR) AS contract_number, contract_name, room_type, characteristic, board
FROM prices p WHERE NOT EXISTS (
  SELECT 1 FROM api a WHERE a.children = '' AND a.contract_number = CAST(p.contract_number AS VARCHAR) AND a.contract_name = p.contract_name
   AND a.room_type = p.room_type AND a.characteristic = p.characteristic AND a.board = p.board)""", "api", "prices"),
    # the joins build the product of the four families; what is distinct in it is counted
    "reconcile_chain": _sql(f"""
WITH stay_match AS (
  SELECT o.cnct_id, r.minimum_days, r.maximum_days
  FROM offers o JOIN cnem r ON {same_room('r', 'o')} AND {wild('r.board', 'o.base_board')}
   AND r.initial_date <= {IN} AND r.final_date >= {OUT} AND (r.application_date IS NULL OR r.application_date < {NOW})),
free_rows AS (SELECT *, row_number() OVER () AS free_id FROM free_match),
board_rows AS (SELECT *, row_number() OVER () AS board_id FROM board_match),
product AS (
  SELECT o.*, b.board_id, b.board_code, b.cnsr_is_per_pax, b.cnsr_amount, b.cnsr_percentage, d.uid, d.type, d.application_type, d.amount AS sad_amount,
         d.percentage AS sad_percentage, f.free_id, s.minimum_days, s.maximum_days
  FROM offers o LEFT JOIN board_rows b ON b.cnct_id = o.cnct_id LEFT JOIN discount_match d ON d.cnct_id = o.cnct_id
  LEFT JOIN free_rows f ON f.cnct_id = o.cnct_id LEFT JOIN stay_match s ON s.cnct_id = o.cnct_id
  WHERE (s.minimum_days IS NULL OR s.minimum_days <= {NIGHTS}) AND (s.maximum_days IS NULL OR s.maximum_days >= {NIGHTS})),
served AS (
  SELECT *, base_board AS board, NULL AS flag, NULL AS term_id FROM product
  UNION ALL SELECT *, board_code, cnsr_is_per_pax, board_id FROM product WHERE board_id IS NOT NULL),
heads AS (
  SELECT cnct_id, CAST(contract_number AS VARCHAR) AS contract_number, contract_name, room_type, characteristic, board, flag, minimum_days, maximum_days,
         CAST(count(DISTINCT uid) AS INTEGER) AS n_discounts, CAST(count(DISTINCT free_id) AS INTEGER) AS n_frees,
         CAST(count(DISTINCT term_id) AS INTEGER) AS n_terms,
         max(CASE WHEN is_price_per_pax = 'Y' THEN room_amount * paxes ELSE room_amount END) AS room_price
  FROM served GROUP BY ALL),
discounts AS (
  SELECT cnct_id, '[' || string_agg(CAST(to_json({{'type': type, 'application_type': application_type, 'amount': sad_amount, 'percentage': sad_percentage}}) AS VARCHAR),
         ',' ORDER BY type, application_type, sad_amount NULLS FIRST, sad_percentage NULLS FIRST) || ']' AS cnsu_sad
  FROM (SELECT DISTINCT cnct_id, type, application_type, sad_amount, sad_percentage FROM product WHERE uid IS NOT NULL) GROUP BY cnct_id),
boards AS (
  SELECT cnct_id, board, flag, '[' || string_agg(CAST(to_json({{'amount': cnsr_amount, 'pct': cnsr_percentage}}) AS VARCHAR), ','
           ORDER BY cnsr_amount NULLS FIRST, cnsr_percentage NULLS FIRST) || ']' AS cnsr_sad,
         sum(CASE WHEN coalesce(cnsr_amount, 0) <> 0 AND flag = 'N' THEN cnsr_amount
                  WHEN coalesce(cnsr_amount, 0) <> 0 THEN cnsr_amount * paxes
                  WHEN coalesce(cnsr_percentage, 0) = 0 THEN 0
                  WHEN is_price_per_pax = 'Y' THEN room * cnsr_percentage / 100 * standard_capacity
                  WHEN flag = 'N' THEN room * cnsr_percentage / 100
                  ELSE room * cnsr_percentage / 100 / standard_capacity * paxes END) AS board_price
  FROM (SELECT DISTINCT cnct_id, board, flag, term_id, cnsr_amount, cnsr_percentage, is_price_per_pax, standard_capacity, paxes,
               CASE WHEN is_price_per_pax = 'Y' THEN room_amount * paxes ELSE room_amount END AS room FROM served WHERE term_id IS NOT NULL)
  GROUP BY cnct_id, board, flag),
p AS (
  SELECT h.*, row_number() OVER () AS n, coalesce(b.board_price, 0.0::DOUBLE) AS board_price, b.cnsr_sad, d.cnsu_sad,
         (room_price + coalesce(b.board_price, 0.0::DOUBLE)) * {NIGHTS} AS price
  FROM heads h LEFT JOIN boards b ON b.cnct_id = h.cnct_id AND b.board = h.board AND b.flag = h.flag LEFT JOIN discounts d ON d.cnct_id = h.cnct_id),
a AS (SELECT DISTINCT contract_number, contract_name, room_type, characteristic, board, amount AS api_amount FROM api WHERE children = '5 1'),
met AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY {NEAREST}) AS place
        FROM p JOIN a USING (contract_number, contract_name, room_type, characteristic, board))
SELECT cnct_id, contract_number, contract_name, room_type, characteristic, board, coalesce(flag, '') AS cnsr_is_per_pax, coalesce(cnsr_sad, '') AS cnsr_sad,
       coalesce(cnsu_sad, '') AS cnsu_sad, coalesce(minimum_days, -1) AS minimum_days, coalesce(maximum_days, -1) AS maximum_days, n_terms, n_discounts,
       n_frees, {money('room_price')} AS room_price, {money('board_price')} AS board_price, {money('price')} AS price, api_amount,
       round_even(api_amount, 0) - round_even(price, 0) AS difference
FROM met WHERE place = 1 AND round_even(api_amount, 0) <> round_even(price, 0)""", "offers", "board_match", "discount_match", "free_match", "cnem", "api"),
}

ORACLES = {**SCANS, **GUESTS, **RULES, **PRICES, **PIPELINE, **CHECKS}
