"""Entity batches derived from the driver's tables.

The source ships no data files. These functions derive entity-shaped
batches from the driver tables with plain expressions (so the DuckDB
oracle can repeat them), and they grow with the tables:

customer batches (customer entity):
  day 1  every customer with c_custkey % 10 <> 0
  day 2  new customers (% 10 = 0)
         + updates of day-1 keys with % 7 = 0: segment -> 'UPDATED';
           for even keys also nation -> (nation + 1) % 25
         + unchanged replays of day-1 keys with % 11 = 0 and % 7 <> 0
  day 3  reverts: day-1 keys with % 21 = 0 back to their day-1 values
  The segment 'HOUSEHOLD' is read as NULL, to exercise NULL handling.

location batches (location entity, from customer rows):
  one location per customer; state, city picked from the fixed rule lists
  so that every standardisation rule fires; day 2 changes the zip code of
  keys with % 7 = 0 and the active flag of keys with % 11 = 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions import conform
from tierflow.plans import entities

DAY_TS = {1: "2024-01-01 00:00:00", 2: "2024-01-02 00:00:00", 3: "2024-01-03 00:00:00"}

CUSTOMER_KEYS = ["c_custkey"]
CUSTOMER_VALUES = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_TRACK = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def customer_base(customer: DataFrame) -> DataFrame:
    return customer.select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"),
        F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")).alias("c_mktsegment"),
    )


def customer_day(customer: DataFrame, day: int) -> DataFrame:
    """Customer batch of ``day`` (1, 2 or 3) with a ``_load_batch`` column."""
    b = customer_base(customer)
    k = F.col("c_custkey")
    if day == 1:
        out = b.filter(k % 10 != 0)
    elif day == 2:
        upd = (k % 10 != 0) & (k % 7 == 0)
        replay = (k % 10 != 0) & (k % 11 == 0) & (k % 7 != 0)
        out = b.filter((k % 10 == 0) | upd | replay).select(
            "c_custkey",
            "c_name",
            F.when(upd & (k % 2 == 0), (F.col("c_nationkey") + 1) % 25)
            .otherwise(F.col("c_nationkey")).alias("c_nationkey"),
            "c_acctbal",
            F.when(upd, F.lit("UPDATED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        )
    elif day == 3:
        out = b.filter((k % 10 != 0) & (k % 21 == 0))
    else:
        raise ValueError(day)
    return out.withColumn("_load_batch", F.lit(day).cast("bigint"))


# ------------------------------------------------------------------ location

# Stand-in value lists: every state of the code table, the union
# territories without a code, and one unknown state; cities from both
# tier lists, the capitals, and two spellings the rules treat specially.
STANDIN_STATES = (
    [s for s, _ in conform.STATE_CODES]
    + [u for u in conform.UNION_TERRITORIES if u not in dict(conform.STATE_CODES)]
    + ["Unknown State"]
)
STANDIN_CITIES = (
    conform.TIER_1_CITIES
    + conform.TIER_2_CITIES
    + [c for _, c in conform.CAPITAL_CITIES if c not in conform.TIER_1_CITIES + conform.TIER_2_CITIES]
    + ["Smalltown"]
)


def _pick(values, index_col):
    return F.element_at(F.array(*[F.lit(v) for v in values]), ((index_col % len(values)) + 1).cast("int"))


def location_stage(customer: DataFrame, day: int = 1) -> DataFrame:
    """Raw (all text) location rows derived from customers, as staged."""
    k = F.col("c_custkey")
    capital = k % 3 == 0
    cap_state = _pick([s for s, _ in conform.CAPITAL_CITIES], k)
    cap_city = _pick([c for _, c in conform.CAPITAL_CITIES], k)
    state = F.when(capital, cap_state).otherwise(_pick(STANDIN_STATES, F.col("c_nationkey") + k))
    city = F.when(capital, cap_city).otherwise(_pick(STANDIN_CITIES, k))
    zip_num = F.lit(110000) + k
    active = F.when(F.col("c_acctbal") >= 0, F.lit("Yes")).otherwise(F.lit("No"))
    if day == 2:
        zip_num = F.when(k % 7 == 0, zip_num + 1).otherwise(zip_num)
        active = F.when(k % 11 == 0, F.when(active == "Yes", "No").otherwise("Yes")).otherwise(active)
    out = customer.select(
        k.cast("string").alias("locationid"),
        city.alias("city"),
        state.alias("state"),
        zip_num.cast("string").alias("zipcode"),
        active.alias("activeflag"),
        F.lit("2024-01-01 09:00:00").alias("createddate"),
        F.when(k % 2 == 0, F.lit(None).cast("string"))
        .otherwise(F.lit(DAY_TS[day][:10] + " 10:00:00")).alias("modifieddate"),
    )
    if day == 2:
        out = out.filter((k % 7 == 0) | (k % 11 == 0))
    return out


# ------------------------------------------------------------------ customer as an entity

def customer_text(customer: DataFrame, day: int) -> DataFrame:
    """A customer batch as staged text (what a CSV file of the batch holds)."""
    return customer_day(customer, day).select(*[F.col(c).cast("string").alias(c)
                                                for c in CUSTOMER_VALUES + ["_load_batch"]])


def _conform_customer_standin(stage: DataFrame) -> DataFrame:
    return stage.select(
        conform.to_integer("c_custkey").alias("c_custkey"),
        F.col("c_name"),
        conform.to_integer("c_nationkey").cast("int").alias("c_nationkey"),
        conform.to_decimal("c_acctbal", 12, 2, strict=True).alias("c_acctbal"),
        F.col("c_mktsegment"),
        conform.to_integer("_load_batch").alias("_load_batch"),
        *[F.col(c) for c in entities.AUDIT_COLS],
    )


CUSTOMER_STANDIN = entities.Entity(
    name="customer_standin",
    stage_cols=CUSTOMER_VALUES + ["_load_batch"],
    conform=_conform_customer_standin,
    keys=CUSTOMER_KEYS,
    surrogate="customer_sk",
    clean_cols=CUSTOMER_VALUES + ["_load_batch", *entities.AUDIT_COLS],
    update_cols=CUSTOMER_VALUES[1:] + ["_load_batch", *entities.AUDIT_COLS],
    track=None,
    dim_name="customer_standin_dim",
    dim_hash="customer_hk",
    dim_values=CUSTOMER_VALUES,
    dim_match=CUSTOMER_VALUES,
    dim_hash_cols=CUSTOMER_VALUES,
    not_null=["c_custkey", "c_name"],
    order_cols=["_load_batch"],
)
