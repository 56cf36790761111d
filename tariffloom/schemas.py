"""Schemas of the contract tables, their keys and their column defaults."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(20, 7)

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "date": T.DateType(),
    "double": T.DoubleType(), "decimal(20,7)": MONEY,
}


def _struct(ddl: str) -> T.StructType:
    """``name type, name type``, without a session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split(" ") for c in ddl.split(", "))])


# fixed values: weekday flag columns
WEEKDAYS = (
    "on_monday string, on_tuesday string, on_wednesday string, on_thursday string, on_friday string, on_saturday string, "
    "on_sunday string"
)

# fixed values: column names and types of the contract tables
CCON = _struct(
    "file_id string, external_inventory string, destination_code string, office_code int, "
    "contract_number int, contract_name string, company_code string, type_of_service string, "
    "hotel_code string, giata_hotel_code int, initial_date date, end_date date, no_hotel string, "
    "currency string, base_board string, classification string, payment_model string, daily_price string, "
    "release_days string, minimum_child_age int, maximum_child_age int, opaque string, fix_rate string, "
    "contract_type string, maximum_rooms int, hotel_content int, selling_price string, internal_field string, "
    "internal_field_data string, internal_classification string, is_total_price_per_stay string"
)
CNCT = _struct(
    "file_id string, hotel_id int, id bigint, initial_date date, final_date date, room_type string, "
    "characteristic string, generic_rate string, market_price string, is_price_per_pax string, "
    "net_price string, price string, specific_rate string, base_board string, amount decimal(20,7), days int"
)
CNIN = _struct(
    "file_id string, hotel_id int, id bigint, initial_date date, final_date date, room_type string, "
    "characteristic string, rate int, release int, allotment int"
)
CNHA = _struct(
    "file_id string, hotel_id int, room_type string, characteristic string, standard_capacity int, "
    "min_pax int, max_pax int, max_adult int, max_children int, max_infant int, min_adult int, "
    "min_children int"
)
CNSR = _struct(
    "file_id string, hotel_id int, initial_date date, final_date date, board_code string, is_per_pax string, "
    "amount decimal(20,7), percentage decimal(20,7), rate int, room_type string, characteristic string, "
    f"min_age int, max_age int, {WEEKDAYS}, internal_field string, net_price decimal(20,7), "
    "price decimal(20,7)"
)
CNSU = _struct(
    "file_id string, hotel_id int, initial_date date, final_date date, application_initial_date date, "
    "application_final_date date, supplement_or_discount_code string, type string, is_per_pax string, "
    "opaque string, order int, application_type string, amount decimal(20,7), percentage decimal(20,7), "
    "is_cumulative string, rate int, room_type string, characteristic string, board string, adults int, "
    "pax_order int, min_age int, max_age int, number_of_days int, length_of_stay int, limit_date string, "
    f"{WEEKDAYS}, net_price decimal(20,7), price decimal(20,7)"
)
CNGR = _struct(
    "file_id string, hotel_id int, initial_date date, final_date date, application_initial_date date, "
    "application_final_date date, min_days int, max_days int, rate int, room_type string, "
    "characteristic string, board string, frees int, free_code string, discount decimal(20,7), "
    "application_base_type string, application_board_type string, application_discount_type string, "
    f"application_stay_type string, {WEEKDAYS}, week_day_validation_type string"
)
CNOE = _struct(
    "file_id string, hotel_id int, code1 string, code2 string, is_included string"
)
CNEM = _struct(
    "file_id string, hotel_id int, application_date date, initial_date date, final_date date, type string, "
    "rate int, room_type string, characteristic string, board string, minimum_days int, maximum_days int, "
    f"{WEEKDAYS}"
)
API = _struct(
    "req_id int, destination_code string, hotel_id int, inc_office string, company_code string, "
    "contract_number string, contract_name string, classification string, check_in date, check_out date, "
    "adults string, children string, room_type string, characteristic string, board string, "
    "selling_price string, net_price string, price string, currency string, allotment string, "
    "expiry_date string, packaging string, direct_payment string, internal_fild string, cancelation string, "
    "promotions string, fees string, child_age_from int, child_age_to int, internal_fild_2 string, "
    "amount double, internal_fild_3 string, min_pax int, max_pax int, min_adult int, max_adult int, "
    "max_child int, max_infant int"
)

# fixed values: columns of the price cache
CACHE = (
    "file_id string, rt_id string, hotel_code string, contract_name string, contract_number int, room_type_id string, "
    "meal_type string, room_type string, characteristic string, rate string, board string, cnsr_amount double, "
    "cnsr_percentage double, cnsr_is_per_pax string, lo date, hi date, currency_code string, adult_price int, "
    "child_price int, amount double, is_price_per_pax string, min_nights int, childe_ages struct<lo: int, hi: int>, "
    "standard_capacity int, min_pax int, max_pax int, max_adult int, max_children int, max_infant int, min_adult int, "
    "min_children int, cnsr_pax_ages struct<lo: int, hi: int>, country_code string, city_code string"
)
# fixed values: dictionaries
HOTEL_SUPPLIER = _struct(
    "supplier_hotel_code string, supplier_id int, country_code string, city_code string"
)
RT_DIC = _struct(
    "room_type string, characteristic string, title string, rt_title string"
)
ROOM_TYPE_NAMES = _struct(
    "name_en string"
)

TABLES = {
    "ccon": CCON, "cnct": CNCT, "cnin": CNIN, "cnha": CNHA, "cnsr": CNSR, "cnsu": CNSU,
    "cngr": CNGR, "cnoe": CNOE, "cnem": CNEM, "api": API, "hotel_supplier": HOTEL_SUPPLIER, "rt_dic": RT_DIC,
    "room_type_names": ROOM_TYPE_NAMES,
}

# fixed values: declared keys
KEYS = {
    "ccon": ("file_id",),
    "cnct": ("id",),
    "cnin": ("id",),
    "cnha": ("file_id", "room_type", "characteristic"),
}

# fixed values: declared column defaults
DEFAULTS = {
    "cnsr": {"amount": 0, "percentage": 0, "room_type": "", "characteristic": "", "net_price": 0, "price": 0},
    "cnsu": {"amount": 0, "percentage": 0, "room_type": "", "characteristic": "", "net_price": 0, "price": 0},
    "api": {"hotel_id": 0},
}
