"""Entity configurations: one declaration drives stage, clean and dimension.

Each entity lists its staged file columns (in file order), the
projection that types and standardises them (``conform``), the clean
table's key and update/insert lists, the dimension's columns and match
rule, NOT NULL and length checks, and sensitivity tags.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions import conform as cf

AUDIT_COLS = ["_stg_file_name", "_stg_file_load_ts", "_stg_file_md5", "_copy_data_ts"]


@dataclass(frozen=True)
class Entity:
    name: str
    stage_cols: list[str]                 # file columns, in file order
    conform: Callable[[DataFrame], DataFrame]
    keys: list[str]
    surrogate: str
    clean_cols: list[str]                 # clean table columns without the surrogate key
    update_cols: list[str]                # set on update (D3)
    track: list[str] | None               # conditional update (D1); None = always (D2)
    dim_name: str
    dim_hash: str
    dim_values: list[str]
    dim_match: list[str]                  # reference ON clause
    dim_hash_cols: list[str]
    dim_time: tuple[str, str, str] = ("eff_start_date", "eff_end_date", "is_current")
    not_null: list[str] = field(default_factory=list)
    max_len: dict[str, int] = field(default_factory=dict)
    tags: dict[str, str] = field(default_factory=dict)
    set_on_update: dict[str, Column] = field(default_factory=dict)
    set_on_insert: dict[str, Column] = field(default_factory=dict)
    source: str = "feed"                  # 'feed' or 'table' (menu re-reads all of stage)
    dim_overrides: dict[str, str] = field(default_factory=dict)  # dim column -> cast type
    stamp_copy_ts: bool = False           # merge sets _copy_data_ts to the batch time (D5)
    insert_copy_ts: bool = False          # only its inserts do: a column default (B14)
    multi_line: bool = False              # quoted fields may hold newlines (CSV multiLine)
    # Order that picks the last arrival of a key within one batch (J4, D6).
    order_cols: list[str] = field(default_factory=lambda: ["_stg_file_load_ts", "_stg_file_name"])


def _audit():
    return [F.col(c) for c in AUDIT_COLS]


# ------------------------------------------------------------------ location

def _conform_location(stage: DataFrame) -> DataFrame:
    derived = cf.location_columns("city", "state")
    return stage.select(
        cf.to_integer("locationid", strict=True).alias("location_id"),
        derived["city"].alias("city"),
        derived["state"].alias("state"),
        derived["state_code"].alias("state_code"),
        derived["is_union_territory"].alias("is_union_territory"),
        derived["capital_city_flag"].alias("capital_city_flag"),
        derived["city_tier"].alias("city_tier"),
        cf.to_text("zipcode").alias("zip_code"),
        cf.to_text("activeflag").alias("active_flag"),
        cf.to_timestamp("createddate", cf.FMT_TS, strict=True).alias("created_ts"),
        cf.to_timestamp("modifieddate", cf.FMT_TS, strict=True).alias("modified_ts"),
        *_audit(),
    )


_LOC_TRACK = ["city", "state", "state_code", "is_union_territory", "capital_city_flag",
              "city_tier", "zip_code", "active_flag", "modified_ts"]

LOCATION = Entity(
    name="location",
    stage_cols=["locationid", "city", "state", "zipcode", "activeflag", "createddate", "modifieddate"],
    conform=_conform_location,
    keys=["location_id"],
    surrogate="restaurant_location_sk",
    clean_cols=["location_id", "city", "state", "state_code", "is_union_territory",
                "capital_city_flag", "city_tier", "zip_code", "active_flag", "created_ts",
                "modified_ts", *AUDIT_COLS],
    update_cols=[*_LOC_TRACK, *AUDIT_COLS],
    track=_LOC_TRACK,
    dim_name="restaurant_location_dim",
    dim_hash="restaurant_location_hk",
    dim_values=["location_id", "city", "state", "state_code", "is_union_territory",
                "capital_city_flag", "city_tier", "zip_code", "active_flag"],
    dim_match=["location_id", "active_flag"],
    dim_hash_cols=["city", "state", "state_code", "zip_code"],
    dim_time=("eff_start_dt", "eff_end_dt", "current_flag"),
    stamp_copy_ts=True,
    not_null=["location_id", "city", "state", "state_code", "is_union_territory",
              "capital_city_flag", "zip_code", "active_flag", "created_ts"],
    max_len={"city": 100, "state": 100, "state_code": 2, "city_tier": 6, "zip_code": 10,
             "active_flag": 10},
)


# ------------------------------------------------------------------ customer

def _conform_customer(stage: DataFrame) -> DataFrame:
    return stage.select(
        cf.to_text("customerid").alias("customer_id"),
        cf.to_text("name").alias("name"),
        cf.to_text("mobile").alias("mobile"),
        cf.to_text("email").alias("email"),
        cf.to_text("loginbyusing").alias("login_by_using"),
        cf.to_text("gender").alias("gender"),
        cf.to_date("dob", cf.FMT_DATE).alias("dob"),
        cf.to_date("anniversary", cf.FMT_DATE).alias("anniversary"),
        cf.to_text("preferences").alias("preferences"),
        cf.to_timestamp("createddate", cf.FMT_ISO_FF6).alias("created_dt"),
        cf.to_timestamp("modifieddate", cf.FMT_ISO_FF6).alias("modified_dt"),
        *_audit(),
    )


_CUST_VALUES = ["customer_id", "name", "mobile", "email", "login_by_using", "gender", "dob",
                "anniversary", "preferences"]

CUSTOMER = Entity(
    name="customer",
    stage_cols=["customerid", "name", "mobile", "email", "loginbyusing", "gender", "dob",
                "anniversary", "preferences", "createddate", "modifieddate"],
    conform=_conform_customer,
    keys=["customer_id"],
    surrogate="customer_sk",
    clean_cols=[*_CUST_VALUES, "created_dt", "modified_dt", *AUDIT_COLS],
    update_cols=[*_CUST_VALUES[1:], "created_dt", "modified_dt", *AUDIT_COLS],
    track=None,
    dim_name="customer_dim",
    dim_hash="customer_hk",
    dim_values=_CUST_VALUES,
    dim_match=_CUST_VALUES,
    dim_hash_cols=_CUST_VALUES,
    not_null=["customer_id", "name"],
    max_len={"name": 100, "mobile": 15, "email": 100, "login_by_using": 50, "gender": 10},
    tags={"mobile": "PII", "email": "EMAIL", "gender": "PII", "dob": "PII"},
    multi_line=True,
)


# ------------------------------------------------------------------ customer address

def _conform_address(stage: DataFrame) -> DataFrame:
    return stage.select(
        cf.to_integer("addressid", strict=True).cast("int").alias("address_id"),
        cf.to_integer("customerid", strict=True).cast("int").alias("customer_id_fk"),
        F.col("flatno").alias("flat_no"),
        F.col("houseno").alias("house_no"),
        "floor", "building", "landmark", "locality", "city", "state", "pincode", "coordinates",
        F.col("primaryflag").alias("primary_flag"),
        F.col("addresstype").alias("address_type"),
        cf.to_timestamp("createddate", cf.FMT_ISO).alias("created_date"),
        cf.to_timestamp("modifieddate", cf.FMT_ISO).alias("modified_date"),
        *_audit(),
    )


_ADDR_VALUES = ["address_id", "customer_id_fk", "flat_no", "house_no", "floor", "building",
                "landmark", "locality", "city", "state", "pincode", "coordinates",
                "primary_flag", "address_type"]

CUSTOMER_ADDRESS = Entity(
    name="customer_address",
    # Target order of the stage table: pincode before state. The file has
    # State in column 10 and Pincode in 11; binding by position puts the
    # file's state text into ``pincode`` and vice versa, as the source load does.
    stage_cols=["addressid", "customerid", "flatno", "houseno", "floor", "building", "landmark",
                "locality", "city", "pincode", "state", "coordinates", "primaryflag",
                "addresstype", "createddate", "modifieddate"],
    conform=_conform_address,
    keys=["address_id"],
    surrogate="customer_address_sk",
    clean_cols=[*_ADDR_VALUES, "created_date", "modified_date", *AUDIT_COLS],
    update_cols=[c for c in _ADDR_VALUES if c not in ("address_id", "customer_id_fk")]
    + ["created_date", "modified_date", *AUDIT_COLS],
    track=None,
    dim_name="customer_address_dim",
    dim_hash="customer_address_hk",
    dim_values=_ADDR_VALUES,
    dim_match=_ADDR_VALUES,
    dim_hash_cols=_ADDR_VALUES,
    not_null=["address_id"],
    dim_overrides={"customer_id_fk": "string"},
)


# ------------------------------------------------------------------ restaurant

def _conform_restaurant(stage: DataFrame) -> DataFrame:
    return stage.select(
        cf.to_integer("restaurantid", strict=False).alias("restaurant_id"),
        F.col("name"),
        F.col("cuisinetype").alias("cuisine_type"),
        cf.to_decimal("pricing_for_2", 10, 2).alias("pricing_for_two"),
        F.col("restaurant_phone"),
        F.col("operatinghours").alias("operating_hours"),
        cf.to_integer("locationid", strict=False).alias("location_id_fk"),
        F.col("activeflag").alias("active_flag"),
        F.col("openstatus").alias("open_status"),
        F.col("locality"),
        F.col("restaurant_address"),
        cf.to_decimal("latitude", 9, 6).alias("latitude"),
        cf.to_decimal("longitude", 9, 6).alias("longitude"),
        cf.to_timestamp("createddate", cf.FMT_TS_FF9).alias("created_dt"),
        cf.to_timestamp("modifieddate", cf.FMT_TS_FF9).alias("modified_dt"),
        *_audit(),
    )


_REST_VALUES = ["restaurant_id", "name", "cuisine_type", "pricing_for_two", "restaurant_phone",
                "operating_hours", "location_id_fk", "active_flag", "open_status", "locality",
                "restaurant_address", "latitude", "longitude"]

RESTAURANT = Entity(
    name="restaurant",
    stage_cols=["restaurantid", "name", "cuisinetype", "pricing_for_2", "restaurant_phone",
                "operatinghours", "locationid", "activeflag", "openstatus", "locality",
                "restaurant_address", "latitude", "longitude", "createddate", "modifieddate"],
    conform=_conform_restaurant,
    keys=["restaurant_id"],
    surrogate="restaurant_sk",
    clean_cols=[*_REST_VALUES, "created_dt", "modified_dt", *AUDIT_COLS],
    # _copy_data_ts is set on insert (column default: the merge's time) and never updated.
    update_cols=[*_REST_VALUES[1:], "created_dt", "modified_dt",
                 "_stg_file_name", "_stg_file_load_ts", "_stg_file_md5"],
    track=None,
    dim_name="restaurant_dim",
    dim_hash="restaurant_hk",
    dim_values=_REST_VALUES,
    dim_match=_REST_VALUES,
    dim_hash_cols=_REST_VALUES,
    not_null=["name"],
    max_len={"name": 100, "restaurant_phone": 15, "operating_hours": 100, "active_flag": 10,
             "open_status": 10, "locality": 100},
    tags={"restaurant_phone": "SENSITIVE"},
    insert_copy_ts=True,
)


# ------------------------------------------------------------------ menu

def _conform_menu(stage: DataFrame) -> DataFrame:
    return stage.select(
        cf.to_integer("menuid", strict=False).cast("int").alias("menu_id"),
        cf.to_integer("restaurantid", strict=False).cast("int").alias("restaurant_id_fk"),
        cf.trimmed("itemname").alias("item_name"),
        cf.trimmed("description").alias("description"),
        cf.to_decimal("price", 10, 2).alias("price"),
        cf.trimmed("category").alias("category"),
        cf.text_to_bool("availability").alias("availability"),
        cf.trimmed("itemtype").alias("item_type"),
        cf.try_timestamp_ntz("createddate").alias("created_dt"),
        cf.try_timestamp_ntz("modifieddate").alias("modified_dt"),
        *_audit(),
    )


_MENU_VALUES = ["menu_id", "restaurant_id_fk", "item_name", "description", "price", "category",
                "availability", "item_type"]

MENU = Entity(
    name="menu",
    stage_cols=["menuid", "restaurantid", "itemname", "description", "price", "category",
                "availability", "itemtype", "createddate", "modifieddate"],
    conform=_conform_menu,
    keys=["menu_id"],
    surrogate="menu_sk",
    clean_cols=[*_MENU_VALUES, "created_dt", "modified_dt", *AUDIT_COLS],
    update_cols=[*_MENU_VALUES[1:], "created_dt", "modified_dt", *AUDIT_COLS],
    track=None,
    dim_name="menu_dim",
    dim_hash="menu_dim_hk",
    dim_values=_MENU_VALUES,
    dim_match=_MENU_VALUES,
    dim_hash_cols=_MENU_VALUES,
    not_null=["menu_id", "item_name", "description", "price"],
    source="table",
    stamp_copy_ts=True,
)

ENTITIES = {e.name: e for e in (LOCATION, CUSTOMER, CUSTOMER_ADDRESS, RESTAURANT, MENU)}
