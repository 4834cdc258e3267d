import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tierflow.functions import conform as cf
from tierflow.plans import entities

LOCATION_DAY1 = [
    ("1", "Delhi", "Delhi", "110001", "Yes", "2024-01-01 09:00:00", None),
    ("2", "Mumbai", "Maharashtra", "400001", "Yes", "2024-01-01 09:00:00", "2024-01-02 10:00:00"),
    ("3", "Bangalore", "Karnataka", "560001", "Yes", "2024-01-01 09:00:00", None),
    ("4", "Jaipur", "Rajasthan", "302001", "No", "2024-01-01 09:00:00", None),
    ("5", "Smalltown", "Kerala", "680001", "Yes", "2024-01-01 09:00:00", None),
    ("6", "New Delhi", "New Delhi", "110002", "Yes", "2024-01-01 09:00:00", None),
]


def _stage(spark, data):
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in entities.LOCATION.stage_cols))
    for c in entities.AUDIT_COLS:
        df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def test_location_rules_match_expected_clean_rows(spark):
    out = entities.LOCATION.conform(_stage(spark, LOCATION_DAY1))
    got = {r.location_id: (r.city, r.state, r.state_code, r.is_union_territory, r.capital_city_flag,
                           r.city_tier) for r in out.collect()}
    assert got[1] == ("New Delhi", "New Delhi", "DL", True, False, "Tier-1")  # raw 'Delhi' misses capital
    assert got[2] == ("Mumbai", "Maharashtra", "MH", False, True, "Tier-1")
    assert got[3] == ("Bangalore", "Karnataka", "KA", False, True, "Tier-3")  # Bangalore != Bengaluru
    assert got[4] == ("Jaipur", "Rajasthan", "RJ", False, True, "Tier-2")
    assert got[5] == ("Smalltown", "Kerala", "KL", False, False, "Tier-3")
    assert got[6] == ("New Delhi", "New Delhi", "DL", True, True, "Tier-1")


def test_union_territory_without_code_gives_null_code(spark):
    out = entities.LOCATION.conform(_stage(spark, [("7", "Leh", "Ladakh", "194101", "Yes",
                                                    "2024-01-01 09:00:00", None)]))
    r = out.first()
    assert r.state_code is None and r.is_union_territory is True


def test_strict_number_cast_rounds_half_up_and_try_casts(spark):
    df = spark.createDataFrame([("12.5", "12.345", "abc", "1234.5", "7.5")], ["a", "p", "bad", "lat", "m"])
    r = df.select(
        cf.to_integer("a").alias("a"),
        cf.to_decimal("p", 10, 2).alias("p"),
        cf.to_decimal("bad", 10, 2).alias("bad"),
        cf.to_decimal("lat", 9, 6).alias("lat"),
        cf.to_integer("m", strict=False).alias("m"),
    ).first()
    assert r.a == 13 and r.p == Decimal("12.35") and r.bad is None and r.lat is None and r.m == 8


def test_text_to_bool_and_dates(spark):
    df = spark.createDataFrame([("TRUE", "1990-12-31", "31-12-1990", "2024-01-02T03:04:05.123456",
                                 "2024-01-02T03:04:05.5"),
                                ("False", None, "x", "bad", "2024-01-02T03:04:05"),
                                ("yes", None, None, None, None)],
                               "b string, d string, bad_d string, ff6 string, iso string")
    out = df.select(
        cf.text_to_bool("b").alias("b"), cf.to_date("d").alias("d"), cf.to_date("bad_d").alias("bd"),
        cf.to_timestamp("ff6", cf.FMT_ISO_FF6, ntz=True).alias("ff6"),
        cf.to_timestamp("iso", cf.FMT_ISO, ntz=True).alias("iso"),
    ).collect()
    assert [r.b for r in out] == [True, False, None]
    assert out[0].d == dt.date(1990, 12, 31) and out[0].bd is None
    assert out[0].ff6 == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert out[0].iso is None                       # fraction not allowed by the pattern
    assert out[1].iso == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_nanosecond_text_truncates_to_micros(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05.123456789",)], ["t"])
    r = df.select(cf.to_timestamp("t", cf.FMT_TS_FF9, ntz=True).alias("t")).first()
    assert r.t == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)


def test_menu_conform_trims_and_parses(spark):
    row = ("7.5", "3", "  Paneer Tikka ", " spicy ", "n/a", "Starter", "yes", "Veg",
           "2024-01-01 10:00:00", "garbage")
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in entities.MENU.stage_cols))
    for c in entities.AUDIT_COLS:
        df = df.withColumn(c, F.lit(None).cast("string"))
    r = entities.MENU.conform(df).first()
    assert r.menu_id == 8 and r.item_name == "Paneer Tikka" and r.description == "spicy"
    assert r.price is None and r.availability is None and r.modified_dt is None
    assert r.created_dt == dt.datetime(2024, 1, 1, 10, 0, 0)
