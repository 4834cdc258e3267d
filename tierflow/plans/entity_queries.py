"""Registered pipelines of the customer, address, restaurant and menu entities.

Rows of the driver's tables are written as the entity's CSV files for two days
(whole table on day 1; corrections and new keys on day 2), go through
``run_batch``, and the stored clean table or dimension is returned. The oracles
state the expected values from the same tables. ``copied`` is the day whose time
the stored ``_copy_data_ts`` shows, ``stg_file`` the file the row came from: both
are audit columns that a load fills.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.plans import batch, entities
from tierflow.plans.entities import Entity
from tierflow.plans.registry import register
from tierflow.session import unique_scratch
from tierflow.sources import ingest
from tierflow.sources.tables import read_table


def _at(day: int) -> dt.datetime:
    return dt.datetime(2024, 1, day)


def _run(spark, e: Entity, days: list[DataFrame], mode: str = "sound") -> batch.Warehouse:
    """Land and process one frame of text columns for each day."""
    root = unique_scratch(spark, e.name)
    wh = batch.Warehouse(spark, f"{root}/wh")
    for n, rows in enumerate(days, 1):
        path = f"{root}/landing/day{n}"
        ingest.write_csv(rows.select(*[F.col(c).cast("string") for c in rows.columns]), path)
        # The merge runs later than the load, so that their times differ.
        batch.copy_into(wh, e, path, as_of=_at(10 * n))
        batch.run_clean(wh, e, as_of=_at(10 * n + 1), mode=mode)
        batch.run_dim(wh, e, as_of=_at(10 * n + 1), mode=mode)
    return wh


def _audited(clean: DataFrame, *cols) -> DataFrame:
    return clean.select(
        *cols,
        F.dayofmonth("_copy_data_ts").alias("copied"),
        F.regexp_extract("_stg_file_name", r"/(day\d+)/", 1).alias("stg_file"),
        (F.col("_stg_file_md5").isNotNull() & F.col("_stg_file_load_ts").isNotNull()).alias("stamped"),
    )


def _versions(dim: DataFrame, keys: list[str], cols: list[str], start: str, end: str, cur: str, hash_col: str) -> DataFrame:
    """Versions of a dimension; ``hash_ok``: the declared primary key is unique over all rows."""
    unique = dim.groupBy(hash_col).agg(F.count(F.lit(1)).alias("__n"))
    return dim.join(unique, hash_col).select(
        *keys, *cols, F.dayofmonth(start).alias("from_day"), F.dayofmonth(end).alias("to_day"), F.col(cur).alias("is_current"),
        (F.col("__n") == 1).alias("hash_ok"))


# ------------------------------------------------------------------ restaurant (from supplier)

def _restaurant_days(spark, d) -> list[DataFrame]:
    s = read_table(spark, d, "supplier")
    k = F.col("s_suppkey")
    # Keys % 11 = 5 do not parse; keys % 7 = 3 have a price that does not.
    rest = s.select(
        F.when(k % 11 == 5, F.concat(F.lit("R-"), k.cast("string"))).otherwise(k.cast("string")).alias("restaurantid"),
        F.col("s_name").alias("name"), F.lit("Cafe").alias("cuisinetype"),
        F.when(k % 7 == 3, F.lit("n/a")).otherwise(F.concat(F.col("s_nationkey").cast("string"), F.lit(".456"))).alias("pricing_for_2"),
        F.lpad(k.cast("string"), 10, "9").alias("restaurant_phone"), F.lit("10-22").alias("operatinghours"),
        F.col("s_nationkey").cast("string").alias("locationid"), F.lit("Active").alias("activeflag"), F.lit("Open").alias("openstatus"),
        F.lit("CP").alias("locality"), F.concat(F.lit("Block A, "), F.col("s_name")).alias("restaurant_address"),
        F.lit("28.6315").alias("latitude"), F.lit("77.2167").alias("longitude"),
        F.lit("2024-01-01 09:00:00.123456789").alias("createddate"), F.lit(None).cast("string").alias("modifieddate"), k.alias("__k"))
    day2 = rest.filter((F.col("__k") % 5 == 0) & (F.col("__k") % 11 != 5)).withColumn("openstatus", F.lit("Closed"))
    return [rest.drop("__k"), day2.drop("__k")]


_REST_ROWS = """
SELECT CASE WHEN s_suppkey % 11 <> 5 THEN s_suppkey END AS restaurant_id, s_name AS name,
       CASE WHEN s_suppkey % 7 <> 3 THEN CAST(CAST(s_nationkey || '.456' AS DECIMAL(12,3)) AS DECIMAL(10,2)) END AS pricing_for_two,
       s_suppkey % 5 = 0 AND s_suppkey % 11 <> 5 AS again, s_suppkey
FROM supplier"""


@register("restaurant_clean", f"""
SELECT restaurant_id, name, pricing_for_two, CASE WHEN again THEN 'Closed' ELSE 'Open' END AS open_status,
       TIMESTAMP '2024-01-01 09:00:00.123456' AS created_dt, CAST(11 AS INT) AS copied,
       CASE WHEN again THEN 'day2' ELSE 'day1' END AS stg_file, true AS stamped FROM ({_REST_ROWS})""")
def restaurant_clean(spark, d):
    """Try casts, nine fraction digits, and a copy time that only inserts set (that of the merge)."""
    wh = _run(spark, entities.RESTAURANT, _restaurant_days(spark, d))
    return _audited(wh.clean(entities.RESTAURANT), "restaurant_id", "name", "pricing_for_two", "open_status",
                    F.col("created_dt").cast("timestamp_ntz").alias("created_dt"))


@register("restaurant_dim", f"""
SELECT restaurant_id, 'Open' AS open_status, CAST(11 AS INT) AS from_day, CAST(CASE WHEN again THEN 21 END AS INT) AS to_day,
       NOT again AS is_current, true AS hash_ok FROM ({_REST_ROWS}) WHERE restaurant_id IS NOT NULL
UNION ALL
SELECT restaurant_id, 'Closed', 21, NULL, true, true FROM ({_REST_ROWS}) WHERE restaurant_id IS NOT NULL AND again""")
def restaurant_dim(spark, d):
    """Versions of the dimension; rows without a key stay out of it."""
    e = entities.RESTAURANT
    wh = _run(spark, e, _restaurant_days(spark, d))
    return _versions(wh.dim(e), ["restaurant_id"], ["open_status"], *e.dim_time, e.dim_hash)


# ------------------------------------------------------------------ menu (from part)

def _menu_days(spark, d) -> list[DataFrame]:
    p = read_table(spark, d, "part")
    k = F.col("p_partkey")
    menu = p.select(
        k.cast("string").alias("menuid"), F.col("p_size").cast("string").alias("restaurantid"),
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("itemname"), F.col("p_brand").alias("description"),
        F.col("p_retailprice").cast("decimal(12,2)").cast("string").alias("price"), F.col("p_type").alias("category"),
        F.when(k % 3 == 0, "TRUE").when(k % 3 == 1, "False").otherwise("maybe").alias("availability"), F.lit("Veg").alias("itemtype"),
        F.lit("2024-01-01 10:00:00").alias("createddate"), F.lit(None).cast("string").alias("modifieddate"), k.alias("__k"))
    day2 = menu.filter(F.col("__k") % 4 == 0).withColumn("price", F.lit("1.005"))
    return [menu.drop("__k"), day2.drop("__k")]


@register("menu_clean", """
SELECT CAST(p_partkey AS INT) AS menu_id, trim(p_name) AS item_name,
       CASE WHEN p_partkey % 4 = 0 THEN CAST(1.01 AS DECIMAL(10,2)) ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(10,2)) END AS price,
       CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS availability, TIMESTAMP '2024-01-01 10:00:00' AS created_dt,
       CAST(21 AS INT) AS copied, CASE WHEN p_partkey % 4 = 0 THEN 'day2' ELSE 'day1' END AS stg_file, true AS stamped
FROM part""")
def menu_clean(spark, d):
    """The whole stage is read again each time: every row is stamped by the last merge."""
    wh = _run(spark, entities.MENU, _menu_days(spark, d))
    return _audited(wh.clean(entities.MENU), "menu_id", "item_name", "price", "availability", "created_dt")


@register("menu_dim", """
SELECT CAST(p_partkey AS INT) AS menu_id, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(10,2)) AS price, CAST(11 AS INT) AS from_day,
       CAST(CASE WHEN p_partkey % 4 = 0 THEN 21 END AS INT) AS to_day, p_partkey % 4 <> 0 AS is_current, true AS hash_ok FROM part
UNION ALL
SELECT CAST(p_partkey AS INT), CAST(1.01 AS DECIMAL(10,2)), 21, NULL, true, true FROM part WHERE p_partkey % 4 = 0""")
def menu_dim(spark, d):
    """Rows read again without a change make no version."""
    e = entities.MENU
    wh = _run(spark, e, _menu_days(spark, d))
    return _versions(wh.dim(e), ["menu_id"], ["price"], *e.dim_time, e.dim_hash)


# ------------------------------------------------------------------ customer and address (from customer)

def _customer_days(spark, d) -> list[DataFrame]:
    c = read_table(spark, d, "customer")
    k = F.col("c_custkey")
    rows = c.select(
        F.concat(F.lit("C"), k.cast("string")).alias("customerid"), F.col("c_name").alias("name"),
        F.lpad(k.cast("string"), 10, "0").alias("mobile"),
        F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit(None)).otherwise(F.concat(F.col("c_name"), F.lit("@x.in"))).alias("email"),
        F.lit("App").alias("loginbyusing"), F.when(k % 2 == 0, F.lit("Female")).alias("gender"),
        F.when(k % 5 == 0, F.lit("31-12-1990")).otherwise(F.lit("1990-12-31")).alias("dob"), F.lit(None).cast("string").alias("anniversary"),
        F.concat(F.lit('veg, "'), F.col("c_mktsegment"), F.lit('"\nline two')).alias("preferences"),
        F.lit("2024-01-01T09:00:00.123456").alias("createddate"), F.lit(None).cast("string").alias("modifieddate"), k.alias("__k"))
    day1 = rows.filter(F.col("__k") % 9 != 0)
    day2 = rows.filter((F.col("__k") % 9 == 0) | (F.col("__k") % 6 == 1)).withColumn(
        "loginbyusing", F.lit("Web")).withColumn("modifieddate", F.lit("2024-01-02T09:00:00.5"))
    return [day1.drop("__k"), day2.drop("__k")]


@register("customer_clean", """
SELECT 'C' || c_custkey AS customer_id, c_name AS name,
       CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_name || '@x.in' END AS email,
       CASE WHEN c_custkey % 5 <> 0 THEN DATE '1990-12-31' END AS dob, 'veg, "' || c_mktsegment || '"' || chr(10) || 'line two' AS preferences,
       CASE WHEN again THEN 'Web' ELSE 'App' END AS login_by_using,
       CASE WHEN again THEN TIMESTAMP '2024-01-02 09:00:00.5' END AS modified_dt,
       CAST(CASE WHEN again THEN 20 ELSE 10 END AS INT) AS copied, CASE WHEN again THEN 'day2' ELSE 'day1' END AS stg_file, true AS stamped
FROM (SELECT *, c_custkey % 9 = 0 OR c_custkey % 6 = 1 AS again FROM customer)""")
def customer_clean(spark, d):
    """Quoted texts with line ends, empty text and NULL, dates of another form, fractions of any length."""
    wh = _run(spark, entities.CUSTOMER, _customer_days(spark, d))
    return _audited(wh.clean(entities.CUSTOMER), "customer_id", "name", "email", "dob", "preferences", "login_by_using",
                    F.col("modified_dt").cast("timestamp_ntz").alias("modified_dt"))


@register("customer_dim", """
SELECT 'C' || c_custkey AS customer_id, 'App' AS login_by_using, CAST(11 AS INT) AS from_day,
       CAST(CASE WHEN c_custkey % 6 = 1 THEN 21 END AS INT) AS to_day, c_custkey % 6 <> 1 AS is_current, true AS hash_ok
FROM customer WHERE c_custkey % 9 <> 0
UNION ALL
SELECT 'C' || c_custkey, 'Web', 21, NULL, true, true FROM customer WHERE c_custkey % 9 = 0 OR c_custkey % 6 = 1""")
def customer_dim(spark, d):
    e = entities.CUSTOMER
    wh = _run(spark, e, _customer_days(spark, d))
    return _versions(wh.dim(e), ["customer_id"], ["login_by_using"], *e.dim_time, e.dim_hash)


def _address_days(spark, d) -> list[DataFrame]:
    c = read_table(spark, d, "customer")
    k = F.col("c_custkey")

    def day(rows, customer, flat):
        return rows.select(
            k.cast("string").alias("addressid"), customer.cast("string").alias("customerid"), F.lit(flat).alias("flatno"),
            F.lit("12").alias("houseno"), F.lit("2").alias("floor"), F.lit("Tower").alias("building"), F.lit("Park").alias("landmark"),
            F.lit("Saket").alias("locality"), F.lit("Delhi").alias("city"), F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("State"),
            F.lpad(k.cast("string"), 6, "1").alias("Pincode"), F.lit("28.5,77.2").alias("coordinates"), F.lit("Y").alias("primaryflag"),
            F.lit("Home").alias("addresstype"), F.lit("2024-01-01T09:00:00").alias("createddate"), F.lit("2024-01-01T09:00:00").alias("modifieddate"))

    return [day(c, k + 1000, "A1"), day(c.filter(k % 8 == 0), k + 5000, "A2")]


@register("address_clean", """
SELECT c_custkey AS address_id, c_custkey + 1000 AS customer_id_fk, CASE WHEN c_custkey % 8 = 0 THEN 'A2' ELSE 'A1' END AS flat_no,
       'S' || c_nationkey AS pincode, lpad(CAST(c_custkey AS VARCHAR), 6, '1') AS state, '28.5,77.2' AS coordinates,
       CAST(CASE WHEN c_custkey % 8 = 0 THEN 20 ELSE 10 END AS INT) AS copied,
       CASE WHEN c_custkey % 8 = 0 THEN 'day2' ELSE 'day1' END AS stg_file, true AS stamped FROM customer""")
def address_clean(spark, d):
    """Bound by position, so state and pincode cross over; the foreign key is not in the update list."""
    wh = _run(spark, entities.CUSTOMER_ADDRESS, _address_days(spark, d))
    return _audited(wh.clean(entities.CUSTOMER_ADDRESS), "address_id", "customer_id_fk", "flat_no", "pincode", "state", "coordinates")


@register("address_dim", """
SELECT c_custkey AS address_id, CAST(c_custkey + 1000 AS VARCHAR) AS customer_id_fk, 'A1' AS flat_no, CAST(11 AS INT) AS from_day,
       CAST(CASE WHEN c_custkey % 8 = 0 THEN 21 END AS INT) AS to_day, c_custkey % 8 <> 0 AS is_current, true AS hash_ok FROM customer
UNION ALL
SELECT c_custkey, CAST(c_custkey + 1000 AS VARCHAR), 'A2', 21, NULL, true, true FROM customer WHERE c_custkey % 8 = 0""")
def address_dim(spark, d):
    """The foreign key keeps its first value; in the dimension it is text."""
    e = entities.CUSTOMER_ADDRESS
    wh = _run(spark, e, _address_days(spark, d))
    return _versions(wh.dim(e), ["address_id"], ["customer_id_fk", "flat_no"], *e.dim_time, e.dim_hash)


# ------------------------------------------------------------------ replays

@register("runner_replay", """
SELECT CAST(p_partkey AS INT) AS menu_id, CASE WHEN p_partkey % 4 = 0 THEN CAST(1.01 AS DECIMAL(10,2))
       ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(10,2)) END AS price,
       CAST(CASE WHEN p_partkey % 4 = 0 THEN 2 ELSE 1 END AS BIGINT) AS versions FROM part""")
def runner_replay(spark, d):
    """Each day is run twice and the last files arrive once more unchanged: nothing is lost or doubled."""
    e = entities.MENU
    root = unique_scratch(spark, "replay")
    wh = batch.Warehouse(spark, f"{root}/wh")
    days = _menu_days(spark, d)
    for n, rows in enumerate([*days, days[1]], 1):
        path = f"{root}/landing/day{n}"
        ingest.write_csv(rows, path)
        for _ in range(2):
            batch.run_batch(wh, e, path, as_of=_at(n))
    versions = wh.dim(e).groupBy("menu_id").agg(F.count(F.lit(1)).alias("versions"))
    return wh.clean(e).select("menu_id", "price").join(versions, "menu_id", "left").select("menu_id", "price", "versions")
