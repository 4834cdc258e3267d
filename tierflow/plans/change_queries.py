"""Registered queries for conform, quality, privacy, keys, merge, feeds and SCD2.

Inputs are derived from the driver tables by ``standins``; each oracle
restates the same batches in DuckDB SQL and computes the expected result
its own way (e.g. SCD2 versions via LAG/LEAD, net changes via a snapshot
diff), so the Spark operators are checked against an independent form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions import conform as cf
from tierflow.functions import keys as K
from tierflow.functions import privacy, quality
from tierflow.operators import cdc, merge, scd2
from tierflow.plans import entities, standins as st
from tierflow.plans.registry import register
from tierflow.session import materialize
from tierflow.sources.tables import read_table


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _ntz(df: DataFrame, cols) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


# ===================================================================== conform

_CAP_STATES = [s for s, _ in cf.CAPITAL_CITIES]
_CAP_CITIES = [c for _, c in cf.CAPITAL_CITIES]


def _location_stage_sql(day: int) -> str:
    zip_expr = "110000 + c_custkey" if day == 1 else \
        "CASE WHEN c_custkey % 7 = 0 THEN 110001 + c_custkey ELSE 110000 + c_custkey END"
    act = "CASE WHEN c_acctbal >= 0 THEN 'Yes' ELSE 'No' END"
    if day == 2:
        act = f"CASE WHEN c_custkey % 11 = 0 THEN (CASE WHEN {act} = 'Yes' THEN 'No' ELSE 'Yes' END) ELSE {act} END"
    where = "" if day == 1 else "WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0"
    return f"""
    SELECT CAST(c_custkey AS VARCHAR) AS locationid,
           CASE WHEN c_custkey % 3 = 0 THEN [{_sql_list(_CAP_CITIES)}][c_custkey % {len(_CAP_CITIES)} + 1]
                ELSE [{_sql_list(st.STANDIN_CITIES)}][c_custkey % {len(st.STANDIN_CITIES)} + 1] END AS city,
           CASE WHEN c_custkey % 3 = 0 THEN [{_sql_list(_CAP_STATES)}][c_custkey % {len(_CAP_STATES)} + 1]
                ELSE [{_sql_list(st.STANDIN_STATES)}][(c_nationkey + c_custkey) % {len(st.STANDIN_STATES)} + 1] END AS state,
           CAST({zip_expr} AS VARCHAR) AS zipcode,
           {act} AS activeflag,
           '2024-01-01 09:00:00' AS createddate,
           CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE '{st.DAY_TS[day][:10]} 10:00:00' END AS modifieddate
    FROM customer {where}"""


def _location_conform_sql(stage: str) -> str:
    codes = "\n".join(f"WHEN state = '{s}' THEN '{c}'" for s, c in cf.STATE_CODES)
    caps = " OR ".join(f"(state = '{s}' AND city = '{c}')" for s, c in cf.CAPITAL_CITIES)
    return f"""
    SELECT CAST(CAST(locationid AS DECIMAL(38,0)) AS BIGINT) AS location_id,
           CASE WHEN city = 'Delhi' THEN 'New Delhi' ELSE city END AS city,
           CASE WHEN state = 'Delhi' THEN 'New Delhi' ELSE state END AS state,
           CASE {codes} ELSE NULL END AS state_code,
           CASE WHEN state IN ({_sql_list(cf.UNION_TERRITORIES)}) THEN true ELSE false END AS is_union_territory,
           CASE WHEN {caps} THEN true ELSE false END AS capital_city_flag,
           CASE WHEN city IN ({_sql_list(cf.TIER_1_CITIES)}) THEN 'Tier-1'
                WHEN city IN ({_sql_list(cf.TIER_2_CITIES)}) THEN 'Tier-2' ELSE 'Tier-3' END AS city_tier,
           CAST(zipcode AS VARCHAR) AS zip_code,
           CAST(activeflag AS VARCHAR) AS active_flag,
           strptime(createddate, '%Y-%m-%d %H:%M:%S') AS created_ts,
           strptime(modifieddate, '%Y-%m-%d %H:%M:%S') AS modified_ts
    FROM {stage}"""


def _conformed_location(spark, d, day: int) -> DataFrame:
    raw = st.location_stage(read_table(spark, d, "customer"), day)
    for c in entities.AUDIT_COLS:
        raw = raw.withColumn(c, F.lit(None).cast("string" if c in ("_stg_file_name", "_stg_file_md5")
                                                   else "timestamp_ntz"))
    out = entities.LOCATION.conform(raw)
    return out.drop(*entities.AUDIT_COLS)


_LOC_CTE = f"""WITH stage1 AS ({_location_stage_sql(1)}),
loc1 AS ({_location_conform_sql('stage1')})"""


@register("conform_location", _LOC_CTE + " SELECT * FROM loc1")
def conform_location(spark, d):
    return _ntz(_conformed_location(spark, d, 1), ["created_ts", "modified_ts"])


@register("conform_codes", _LOC_CTE + """
SELECT state, state_code, count(*) AS n FROM loc1 GROUP BY state, state_code""")
def conform_codes(spark, d):
    return _conformed_location(spark, d, 1).groupBy("state", "state_code").agg(
        F.count(F.lit(1)).alias("n"))


@register("conform_tiers", _LOC_CTE + """
SELECT city_tier, capital_city_flag, is_union_territory, count(*) AS n
FROM loc1 GROUP BY city_tier, capital_city_flag, is_union_territory""")
def conform_tiers(spark, d):
    return _conformed_location(spark, d, 1).groupBy(
        "city_tier", "capital_city_flag", "is_union_territory").agg(F.count(F.lit(1)).alias("n"))


@register("conform_bool", """
WITH t AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'TRUE' WHEN 'O' THEN 'False' ELSE 'yes' END AS availability_text FROM orders)
SELECT o_orderkey, availability_text,
       CASE WHEN lower(availability_text) = 'true' THEN true
            WHEN lower(availability_text) = 'false' THEN false END AS availability
FROM t""")
def conform_bool(spark, d):
    o = read_table(spark, d, "orders")
    text = (F.when(F.col("o_orderstatus") == "F", "TRUE")
            .when(F.col("o_orderstatus") == "O", "False").otherwise("yes"))
    t = o.select("o_orderkey", text.alias("availability_text"))
    return t.withColumn("availability", cf.text_to_bool("availability_text"))


_PART_TEXT_SQL = """
SELECT p_partkey,
       CASE WHEN p_partkey % 13 = 0 THEN CAST(p_partkey AS VARCHAR) || '.5' ELSE CAST(p_partkey AS VARCHAR) END AS menuid,
       CASE WHEN p_size % 10 = 0 THEN 'n/a'
            WHEN p_size % 10 = 1 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) || '5'
            ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
       CASE WHEN p_size % 7 = 0 THEN '1234.5' ELSE '28.' || CAST(p_size AS VARCHAR) END AS latitude,
       CASE WHEN p_size % 9 = 0 THEN '2024-13-01 10:00:00'
            ELSE '2024-01-' || lpad(CAST(p_size % 28 + 1 AS VARCHAR), 2, '0') || ' 10:00:00' END AS createddate
FROM part"""


@register("typed_cast_try", f"""WITH t AS ({_PART_TEXT_SQL})
SELECT p_partkey,
       TRY_CAST(TRY_CAST(menuid AS DECIMAL(38,0)) AS BIGINT) AS menu_id,
       TRY_CAST(price AS DECIMAL(10,2)) AS price,
       TRY_CAST(latitude AS DECIMAL(9,6)) AS latitude,
       TRY_CAST(createddate AS TIMESTAMP) AS created_dt
FROM t""")
def typed_cast_try(spark, d):
    p = read_table(spark, d, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    t = p.select(
        "p_partkey",
        F.when(k % 13 == 0, F.concat(k.cast("string"), F.lit(".5"))).otherwise(k.cast("string")).alias("menuid"),
        F.when(size % 10 == 0, F.lit("n/a")).when(size % 10 == 1, F.concat(price, F.lit("5")))
        .otherwise(price).alias("price"),
        F.when(size % 7 == 0, F.lit("1234.5")).otherwise(F.concat(F.lit("28."), size.cast("string")))
        .alias("latitude"),
        F.when(size % 9 == 0, F.lit("2024-13-01 10:00:00"))
        .otherwise(F.concat(F.lit("2024-01-"), F.lpad(((size % 28) + 1).cast("string"), 2, "0"),
                            F.lit(" 10:00:00"))).alias("createddate"),
    )
    return t.select(
        "p_partkey",
        cf.to_integer("menuid", strict=False).alias("menu_id"),
        cf.to_decimal("price", 10, 2).alias("price"),
        cf.to_decimal("latitude", 9, 6).alias("latitude"),
        cf.try_timestamp_ntz("createddate").alias("created_dt"),
    )


@register("parse_dates", """
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate, '%d-%m-%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS dob,
         CASE WHEN o_orderkey % 7 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.123456' END AS iso6,
         CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.5' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS iso,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.123456789' AS ts9,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts
  FROM orders)
SELECT o_orderkey,
       CAST(try_strptime(dob, '%Y-%m-%d') AS DATE) AS dob,
       try_strptime(iso6, '%Y-%m-%dT%H:%M:%S.%f') AS created_ff6,
       try_strptime(iso, '%Y-%m-%dT%H:%M:%S') AS created_iso,
       try_strptime(substr(ts9, 1, 26), '%Y-%m-%d %H:%M:%S.%f') AS created_ff9,
       strptime(ts, '%Y-%m-%d %H:%M:%S') AS created_ts
FROM t""")
def parse_dates(spark, d):
    o = read_table(spark, d, "orders")
    k = F.col("o_orderkey")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    ts = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    t = o.select(
        "o_orderkey",
        F.when(k % 5 == 0, F.date_format("o_orderdate", "dd-MM-yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("dob"),
        F.when(k % 7 == 0, F.lit("bad")).otherwise(F.concat(iso, F.lit(".123456"))).alias("iso6"),
        F.when(k % 4 == 0, F.concat(iso, F.lit(".5"))).otherwise(iso).alias("iso"),
        F.concat(ts, F.lit(".123456789")).alias("ts9"),
        ts.alias("ts"),
    )
    out = t.select(
        "o_orderkey",
        cf.to_date("dob", cf.FMT_DATE).alias("dob"),
        cf.to_timestamp("iso6", cf.FMT_ISO_FF6).alias("created_ff6"),
        cf.to_timestamp("iso", cf.FMT_ISO).alias("created_iso"),
        cf.to_timestamp("ts9", cf.FMT_TS_FF9).alias("created_ff9"),
        cf.to_timestamp("ts", cf.FMT_TS, strict=True).alias("created_ts"),
    )
    return _ntz(out, ["created_ff6", "created_iso", "created_ff9", "created_ts"])


# ===================================================================== quality, privacy, keys

_CUST_BASE_SQL = """base AS (
  SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal,
         nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment
  FROM customer)"""


@register("quality_violations", f"""WITH {_CUST_BASE_SQL}
SELECT 'not_null:c_mktsegment' AS rule, CAST(count(*) FILTER (WHERE c_mktsegment IS NULL) AS BIGINT) AS violations FROM base
UNION ALL SELECT 'not_null:c_name', CAST(count(*) FILTER (WHERE c_name IS NULL) AS BIGINT) FROM base
UNION ALL SELECT 'max_length:c_name<=100', CAST(count(*) FILTER (WHERE length(c_name) > 100) AS BIGINT) FROM base
UNION ALL SELECT 'max_length:c_mktsegment<=9', CAST(count(*) FILTER (WHERE length(c_mktsegment) > 9) AS BIGINT) FROM base""")
def quality_violations(spark, d):
    base = st.customer_base(read_table(spark, d, "customer"))
    rules = quality.rules_for(["c_mktsegment", "c_name"], {"c_name": 100, "c_mktsegment": 9})
    return quality.violation_counts(base, rules)


@register("quality_quarantine", f"""WITH {_CUST_BASE_SQL}
SELECT c_custkey, c_mktsegment FROM base WHERE c_mktsegment IS NULL OR length(c_mktsegment) > 9""")
def quality_quarantine(spark, d):
    base = st.customer_base(read_table(spark, d, "customer"))
    rules = quality.rules_for(["c_mktsegment"], {"c_mktsegment": 9})
    _, bad = quality.split_valid(base, rules)
    return bad.select("c_custkey", "c_mktsegment")


@register("quality_duplicates", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def quality_duplicates(spark, d):
    return quality.duplicates(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@register("row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _COUNTED))
def row_counts(spark, d):
    return quality.row_counts({t: read_table(spark, d, t) for t in _COUNTED})


def _contact_frame(spark, d) -> DataFrame:
    c = read_table(spark, d, "customer")
    return c.select(
        "c_custkey",
        "c_name",
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+91"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("phone"),
        "c_mktsegment",
    )


@register("mask_by_tag", """
SELECT c_custkey, '** PII **' AS c_name, '** EAMIL **' AS email, '** Phone **' AS phone, c_mktsegment
FROM customer""")
def mask_by_tag(spark, d):
    tagged = privacy.tag(_contact_frame(spark, d), {"c_name": "PII", "email": "EMAIL", "phone": "SENSITIVE"})
    return privacy.mask(tagged)


@register("mask_unmasked_role", """
SELECT c_custkey, c_name, '** EAMIL **' AS email, '** Phone **' AS phone, c_mktsegment FROM customer""")
def mask_unmasked_role(spark, d):
    tagged = privacy.tag(_contact_frame(spark, d), {"c_name": "PII", "email": "EMAIL", "phone": "SENSITIVE"})
    return privacy.mask(tagged, unmasked=("c_name",))


@register("hash_key_sha1", f"""WITH {_CUST_BASE_SQL}
SELECT c_custkey,
       sha1(CAST(c_custkey AS VARCHAR) || c_name || CAST(c_nationkey AS VARCHAR) || CAST(c_acctbal AS VARCHAR) || c_mktsegment) AS digest_reference,
       sha1(concat_ws(chr(31), coalesce(CAST(c_custkey AS VARCHAR), '\\N'), coalesce(c_name, '\\N'),
                      coalesce(CAST(c_nationkey AS VARCHAR), '\\N'), coalesce(CAST(c_acctbal AS VARCHAR), '\\N'),
                      coalesce(c_mktsegment, '\\N'))) AS digest_sound
FROM base""")
def hash_key_sha1(spark, d):
    base = st.customer_base(read_table(spark, d, "customer"))
    return base.select(
        "c_custkey",
        K.digest_reference(st.CUSTOMER_VALUES).alias("digest_reference"),
        K.digest_sound(st.CUSTOMER_VALUES).alias("digest_sound"),
    )


@register("surrogate_unique", """
SELECT count(*) AS n_rows, count(*) AS n_distinct_keys, true AS old_kept, true AS new_above FROM customer""")
def surrogate_unique(spark, d):
    """Keys given by an upsert of many partitions: unique, old ones kept, new ones above the old maximum."""
    c = read_table(spark, d, "customer").select("c_custkey", "c_name")
    old = K.assign_surrogate(c.filter(F.col("c_custkey") % 3 == 0), "customer_sk", base=500)
    out = merge.upsert(old, c.repartition(7), ["c_custkey"], surrogate="customer_sk").table
    before = old.select("c_custkey", F.col("customer_sk").alias("old_sk"))
    top = K.max_key(old, "customer_sk")
    return out.join(before, "c_custkey", "left").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("customer_sk").alias("n_distinct_keys"),
        F.bool_and(F.col("old_sk").isNull() | (F.col("old_sk") == F.col("customer_sk"))).alias("old_kept"),
        F.bool_and(F.col("old_sk").isNotNull() | (F.col("customer_sk") > F.lit(top))).alias("new_above"),
    )


# ===================================================================== merge / upsert

_DAYS_SQL = f"""{_CUST_BASE_SQL},
day1 AS (SELECT *, CAST(1 AS BIGINT) AS _load_batch FROM base WHERE c_custkey % 10 <> 0),
day2 AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_custkey % 10 <> 0 AND c_custkey % 7 = 0 AND c_custkey % 2 = 0
              THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS c_nationkey,
         c_acctbal,
         CASE WHEN c_custkey % 10 <> 0 AND c_custkey % 7 = 0 THEN 'UPDATED' ELSE c_mktsegment END AS c_mktsegment,
         CAST(2 AS BIGINT) AS _load_batch
  FROM base
  WHERE c_custkey % 10 = 0 OR (c_custkey % 10 <> 0 AND c_custkey % 7 = 0)
     OR (c_custkey % 10 <> 0 AND c_custkey % 11 = 0 AND c_custkey % 7 <> 0)),
day3 AS (SELECT *, CAST(3 AS BIGINT) AS _load_batch FROM base WHERE c_custkey % 10 <> 0 AND c_custkey % 21 = 0),
up2 AS (SELECT * FROM day2 UNION ALL SELECT * FROM day1 WHERE c_custkey NOT IN (SELECT c_custkey FROM day2)),
up3 AS (SELECT * FROM day3 UNION ALL SELECT * FROM up2 WHERE c_custkey NOT IN (SELECT c_custkey FROM day3))"""

_DISTINCT = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in st.CUSTOMER_TRACK)
_NOT_EQUAL = " OR ".join(f"s.{c} <> t.{c}" for c in st.CUSTOMER_TRACK)


def _days(spark, d):
    c = read_table(spark, d, "customer")
    return st.customer_day(c, 1), st.customer_day(c, 2), st.customer_day(c, 3)


def _up(target, source, **kw):
    return merge.upsert(target, source, st.CUSTOMER_KEYS, **kw)


@register("upsert_unconditional", f"WITH {_DAYS_SQL} SELECT * FROM up2")
def upsert_unconditional(spark, d):
    d1, d2, _ = _days(spark, d)
    return _up(d1, d2).table


@register("upsert_broadcast", f"WITH {_DAYS_SQL} SELECT * FROM up2")
def upsert_broadcast(spark, d):
    d1, d2, _ = _days(spark, d)
    return _up(d1, d2, strategy="broadcast").table


@register("upsert_conditional", f"""WITH {_DAYS_SQL},
chg AS (SELECT s.* FROM day2 s JOIN day1 t ON s.c_custkey = t.c_custkey WHERE {_DISTINCT}),
new AS (SELECT * FROM day2 WHERE c_custkey NOT IN (SELECT c_custkey FROM day1))
SELECT * FROM chg UNION ALL SELECT * FROM new
UNION ALL SELECT * FROM day1 WHERE c_custkey NOT IN (SELECT c_custkey FROM chg)""")
def upsert_conditional(spark, d):
    d1, d2, _ = _days(spark, d)
    return _up(d1, d2, track=st.CUSTOMER_TRACK).table


@register("upsert_partial_cols", f"""WITH {_DAYS_SQL}
SELECT s.c_custkey, s.c_name, t.c_nationkey, s.c_acctbal, s.c_mktsegment, s._load_batch
FROM day2 s JOIN day1 t ON s.c_custkey = t.c_custkey
UNION ALL SELECT * FROM day2 WHERE c_custkey NOT IN (SELECT c_custkey FROM day1)
UNION ALL SELECT * FROM day1 WHERE c_custkey NOT IN (SELECT c_custkey FROM day2)""")
def upsert_partial_cols(spark, d):
    d1, d2, _ = _days(spark, d)
    return _up(d1, d2, update_cols=["c_name", "c_acctbal", "c_mktsegment", "_load_batch"]).table


@register("upsert_set_on_update", f"""WITH {_DAYS_SQL}
SELECT s.c_custkey, s.c_name, s.c_nationkey, s.c_acctbal, s.c_mktsegment, CAST(20 AS BIGINT) AS _load_batch
FROM day2 s JOIN day1 t ON s.c_custkey = t.c_custkey
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(10 AS BIGINT)
FROM day2 WHERE c_custkey NOT IN (SELECT c_custkey FROM day1)
UNION ALL SELECT * FROM day1 WHERE c_custkey NOT IN (SELECT c_custkey FROM day2)""")
def upsert_set_on_update(spark, d):
    d1, d2, _ = _days(spark, d)
    return _up(d1, d2, set_on_update={"_load_batch": F.lit(20)},
               set_on_insert={"_load_batch": F.lit(10)}).table


@register("changed_null_safe", f"""WITH {_DAYS_SQL}
SELECT t.c_custkey FROM day1 t JOIN day2 s ON s.c_custkey = t.c_custkey WHERE {_DISTINCT}""")
def changed_null_safe(spark, d):
    d1, d2, _ = _days(spark, d)
    return merge.changed_keys(d1, d2, st.CUSTOMER_KEYS, st.CUSTOMER_TRACK, null_safe=True)


@register("changed_reference", f"""WITH {_DAYS_SQL}
SELECT t.c_custkey FROM day1 t JOIN day2 s ON s.c_custkey = t.c_custkey WHERE {_NOT_EQUAL}""")
def changed_reference(spark, d):
    d1, d2, _ = _days(spark, d)
    return merge.changed_keys(d1, d2, st.CUSTOMER_KEYS, st.CUSTOMER_TRACK, null_safe=False)


@register("dedupe_latest", f"""WITH {_DAYS_SQL},
u AS (SELECT * FROM day1 UNION ALL SELECT * FROM day2 UNION ALL SELECT * FROM day3),
r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY _load_batch DESC) AS rn FROM u)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, _load_batch FROM r WHERE rn = 1""")
def dedupe_latest(spark, d):
    d1, d2, d3 = _days(spark, d)
    return merge.dedupe_latest(d1.unionByName(d2).unionByName(d3), st.CUSTOMER_KEYS, ["_load_batch"])


@register("upsert_dedupe_source", f"WITH {_DAYS_SQL} SELECT * FROM up3")
def upsert_dedupe_source(spark, d):
    """Whole-stage re-read (menu style): day2 and day3 arrive together."""
    d1, d2, d3 = _days(spark, d)
    return _up(d1, d2.unionByName(d3), on_duplicate="latest", order_cols=["_load_batch"]).table


# ===================================================================== change feeds

_FEED2_SQL = """
feed2 AS (
  SELECT *, 'INSERT' AS _change_action, false AS _change_is_update FROM day2 WHERE c_custkey NOT IN (SELECT c_custkey FROM day1)
  UNION ALL SELECT *, 'DELETE', true FROM day1 WHERE c_custkey IN (SELECT c_custkey FROM day2)
  UNION ALL SELECT *, 'INSERT', true FROM day2 WHERE c_custkey IN (SELECT c_custkey FROM day1)),
feed3 AS (
  SELECT *, 'DELETE' AS _change_action, true AS _change_is_update FROM up2 WHERE c_custkey IN (SELECT c_custkey FROM day3)
  UNION ALL SELECT *, 'INSERT', true FROM day3)"""


@register("change_feed", f"WITH {_DAYS_SQL}, {_FEED2_SQL} SELECT * FROM feed2")
def change_feed(spark, d):
    d1, d2, _ = _days(spark, d)
    return _up(d1, d2).feed


@register("feed_peek_counts", f"""WITH {_DAYS_SQL}, {_FEED2_SQL}
SELECT _change_action, _change_is_update, count(*) AS n FROM feed2 GROUP BY 1, 2""")
def feed_peek_counts(spark, d):
    d1, d2, _ = _days(spark, d)
    return cdc.peek_counts(_up(d1, d2).feed)


_ALL_DIFF = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in st.CUSTOMER_TRACK + ["_load_batch"])


@register("net_changes", f"""WITH {_DAYS_SQL}
SELECT *, 'INSERT' AS _change_action, false AS _change_is_update FROM up3 WHERE c_custkey NOT IN (SELECT c_custkey FROM day1)
UNION ALL SELECT o.*, 'DELETE', true FROM day1 o JOIN up3 n ON o.c_custkey = n.c_custkey WHERE {_ALL_DIFF}
UNION ALL SELECT n.*, 'INSERT', true FROM day1 o JOIN up3 n ON o.c_custkey = n.c_custkey WHERE {_ALL_DIFF}""")
def net_changes(spark, d):
    d1, d2, d3 = _days(spark, d)
    r2 = _up(d1, d2)
    r3 = _up(r2.table, d3)
    feed = cdc.with_batch(r2.feed, 2).unionByName(cdc.with_batch(r3.feed, 3))
    return cdc.net_changes(feed, st.CUSTOMER_KEYS)


@register("diff_snapshots", f"""WITH {_DAYS_SQL}
SELECT *, 'INSERT' AS _change_action, false AS _change_is_update FROM up3 WHERE c_custkey NOT IN (SELECT c_custkey FROM day1)
UNION ALL SELECT o.*, 'DELETE', true FROM day1 o JOIN up3 n ON o.c_custkey = n.c_custkey WHERE {_ALL_DIFF}
UNION ALL SELECT n.*, 'INSERT', true FROM day1 o JOIN up3 n ON o.c_custkey = n.c_custkey WHERE {_ALL_DIFF}""")
def diff_snapshots(spark, d):
    d1, d2, d3 = _days(spark, d)
    final = _up(_up(d1, d2).table, d3).table
    return cdc.diff_snapshots(d1, final, st.CUSTOMER_KEYS)


@register("append_feed", """
SELECT *, CAST(day(ts) AS BIGINT) AS _batch_id FROM events WHERE day(ts) > 15""")
def append_feed(spark, d):
    ev = read_table(spark, d, "events").withColumn("_batch_id", F.dayofmonth("ts").cast("bigint"))
    return cdc.appended_since(ev, 15)


# ===================================================================== SCD2

_T = {day: f"TIMESTAMP '{ts}'" for day, ts in st.DAY_TS.items()}
_VALS = ", ".join(st.CUSTOMER_VALUES)


def _dim_chain(spark, d, mode: str) -> DataFrame:
    d1, d2, d3 = _days(spark, d)
    empty = d1.limit(0)
    f1 = _up(empty, d1).feed
    r2 = _up(d1, d2)
    r3 = _up(materialize(r2.table), d3)
    kw = dict(keys=st.CUSTOMER_KEYS, value_cols=st.CUSTOMER_VALUES, hash_cols=st.CUSTOMER_VALUES,
              hash_col="customer_hk", mode=mode)
    dim = scd2.empty_dim(f1, st.CUSTOMER_VALUES, "customer_hk")
    dim = materialize(scd2.apply(dim, cdc.with_batch(f1, 1), as_of=st.DAY_TS[1], **kw))
    dim = materialize(scd2.apply(dim, cdc.with_batch(r2.feed, 2), as_of=st.DAY_TS[2], **kw))
    return scd2.apply(dim, cdc.with_batch(r3.feed, 3), as_of=st.DAY_TS[3], **kw)


def _dim_out(dim: DataFrame) -> DataFrame:
    return _ntz(dim.drop("customer_hk"), [scd2.START, scd2.END])


_DIFF_VERS = " OR ".join(f"{c} IS DISTINCT FROM p_{c}" for c in st.CUSTOMER_TRACK)
_LAGS = ", ".join(f"lag({c}) OVER k AS p_{c}" for c in st.CUSTOMER_TRACK)

_SCD_SOUND_SQL = f"""WITH {_DAYS_SQL},
v AS (SELECT {_VALS}, {_T[1]} AS eff_start FROM day1
      UNION ALL SELECT {_VALS}, {_T[2]} FROM day2
      UNION ALL SELECT {_VALS}, {_T[3]} FROM day3),
w AS (SELECT *, {_LAGS}, row_number() OVER k AS rn FROM v WINDOW k AS (PARTITION BY c_custkey ORDER BY eff_start)),
kept AS (SELECT {_VALS}, eff_start FROM w WHERE rn = 1 OR {_DIFF_VERS}),
dim AS (SELECT {_VALS}, eff_start,
               lead(eff_start) OVER (PARTITION BY c_custkey ORDER BY eff_start) AS eff_end,
               lead(eff_start) OVER (PARTITION BY c_custkey ORDER BY eff_start) IS NULL AS is_current
        FROM kept)"""


@register("scd2_sound", _SCD_SOUND_SQL + " SELECT * FROM dim")
def scd2_sound(spark, d):
    return _dim_out(_dim_chain(spark, d, "sound"))


@register("scd2_current", _SCD_SOUND_SQL + " SELECT * FROM dim WHERE is_current")
def scd2_current(spark, d):
    return _dim_out(scd2.current_rows(_dim_chain(spark, d, "sound")))


def _ref_step(prev: str, feed: str, day: int) -> str:
    match = " AND ".join(f"f.{c} = d.{c}" for c in st.CUSTOMER_VALUES)
    sel = ", ".join(f"d.{c}" for c in st.CUSTOMER_VALUES)
    fsel = ", ".join(f"f.{c}" for c in st.CUSTOMER_VALUES)
    hit = f"EXISTS (SELECT 1 FROM {feed} f WHERE f._change_action = 'DELETE' AND f._change_is_update AND {match})"
    return f"""
  SELECT {sel}, d.eff_start,
         CASE WHEN {hit} THEN {_T[day]} ELSE d.eff_end END AS eff_end,
         CASE WHEN {hit} THEN false ELSE d.is_current END AS is_current
  FROM {prev} d
  UNION ALL
  SELECT {fsel}, {_T[day]}, CAST(NULL AS TIMESTAMP), true
  FROM {feed} f WHERE f._change_action = 'INSERT' AND NOT EXISTS (SELECT 1 FROM {prev} d WHERE {match})"""


_SCD_REF_SQL = f"""WITH {_DAYS_SQL}, {_FEED2_SQL},
dim1 AS (SELECT {_VALS}, {_T[1]} AS eff_start, CAST(NULL AS TIMESTAMP) AS eff_end, true AS is_current FROM day1),
dim2 AS ({_ref_step('dim1', 'feed2', 2)}),
dim3 AS ({_ref_step('dim2', 'feed3', 3)})
SELECT * FROM dim3"""


@register("scd2_reference", _SCD_REF_SQL)
def scd2_reference(spark, d):
    return _dim_out(_dim_chain(spark, d, "reference"))


def _delete_dim(spark, d, on_delete: str) -> DataFrame:
    d1 = st.customer_base(read_table(spark, d, "customer")).withColumn("_load_batch", F.lit(1).cast("bigint"))
    kept = d1.filter(F.col("c_custkey") % 13 != 0)
    feed = cdc.diff_snapshots(d1, kept, st.CUSTOMER_KEYS)
    f1 = _up(d1.limit(0), d1).feed
    kw = dict(keys=st.CUSTOMER_KEYS, value_cols=st.CUSTOMER_VALUES, hash_cols=st.CUSTOMER_VALUES,
              hash_col="customer_hk", mode="sound", on_delete=on_delete)
    dim = materialize(scd2.apply(scd2.empty_dim(f1, st.CUSTOMER_VALUES, "customer_hk"), f1,
                                 as_of=st.DAY_TS[1], **kw))
    return _dim_out(scd2.apply(dim, feed.select(*d1.columns, merge.ACTION, merge.IS_UPDATE),
                               as_of=st.DAY_TS[2], **kw))


@register("scd2_ignore_delete", f"""WITH {_CUST_BASE_SQL}
SELECT {_VALS}, {_T[1]} AS eff_start, CAST(NULL AS TIMESTAMP) AS eff_end, true AS is_current FROM base""")
def scd2_ignore_delete(spark, d):
    return _delete_dim(spark, d, "ignore")


@register("scd2_expire_delete", f"""WITH {_CUST_BASE_SQL}
SELECT {_VALS}, {_T[1]} AS eff_start,
       CASE WHEN c_custkey % 13 = 0 THEN {_T[2]} END AS eff_end,
       c_custkey % 13 <> 0 AS is_current FROM base""")
def scd2_expire_delete(spark, d):
    return _delete_dim(spark, d, "expire")


# Location dimension: the source matches on (location_id, active_flag) only.
_LOC = entities.LOCATION
_LOC_VALS = ", ".join(_LOC.dim_values)


def _loc_ref_step(prev: str, feed: str, day: int) -> str:
    match = " AND ".join(f"f.{c} = d.{c}" for c in _LOC.dim_match)
    sel = ", ".join(f"d.{c}" for c in _LOC.dim_values)
    fsel = ", ".join(f"f.{c}" for c in _LOC.dim_values)
    hit = f"EXISTS (SELECT 1 FROM {feed} f WHERE f._change_action = 'DELETE' AND f._change_is_update AND {match})"
    return f"""
  SELECT {sel}, d.eff_start_dt,
         CASE WHEN {hit} THEN {_T[day]} ELSE d.eff_end_dt END AS eff_end_dt,
         CASE WHEN {hit} THEN false ELSE d.current_flag END AS current_flag
  FROM {prev} d
  UNION ALL
  SELECT {fsel}, {_T[day]}, CAST(NULL AS TIMESTAMP), true
  FROM {feed} f WHERE f._change_action = 'INSERT' AND NOT EXISTS (SELECT 1 FROM {prev} d WHERE {match})"""


_LOC_CHANGED = " OR ".join(f"s.{c} <> t.{c}" for c in _LOC.track)

_SCD_LOC_SQL = f"""WITH stage1 AS ({_location_stage_sql(1)}), stage2 AS ({_location_stage_sql(2)}),
loc1 AS ({_location_conform_sql('stage1')}),
loc2 AS ({_location_conform_sql('stage2')}),
upd AS (SELECT s.* FROM loc2 s JOIN loc1 t ON s.location_id = t.location_id WHERE {_LOC_CHANGED}),
feed2 AS (
  SELECT *, 'INSERT' AS _change_action, false AS _change_is_update FROM loc2 WHERE location_id NOT IN (SELECT location_id FROM loc1)
  UNION ALL SELECT *, 'DELETE', true FROM loc1 WHERE location_id IN (SELECT location_id FROM upd)
  UNION ALL SELECT *, 'INSERT', true FROM upd),
dim1 AS (SELECT {_LOC_VALS}, {_T[1]} AS eff_start_dt, CAST(NULL AS TIMESTAMP) AS eff_end_dt, true AS current_flag FROM loc1),
dim2 AS ({_loc_ref_step('dim1', 'feed2', 2)})
SELECT * FROM dim2"""


@register("scd2_partial_match", _SCD_LOC_SQL)
def scd2_partial_match(spark, d):
    loc1 = _conformed_location(spark, d, 1)
    loc2 = _conformed_location(spark, d, 2)
    r2 = merge.upsert(loc1, loc2, _LOC.keys, track=_LOC.track, null_safe=False)
    f1 = merge.upsert(loc1.limit(0), loc1, _LOC.keys).feed
    start, end, cur = _LOC.dim_time
    kw = dict(keys=_LOC.keys, value_cols=_LOC.dim_values, hash_cols=_LOC.dim_hash_cols,
              hash_col=_LOC.dim_hash, mode="reference", match_cols=_LOC.dim_match,
              start=start, end=end, current=cur)
    dim = scd2.empty_dim(f1, _LOC.dim_values, _LOC.dim_hash, start, end, cur)
    dim = materialize(scd2.apply(dim, f1, as_of=st.DAY_TS[1], **kw))
    dim = scd2.apply(dim, r2.feed, as_of=st.DAY_TS[2], **kw)
    return _ntz(dim.drop(_LOC.dim_hash), [start, end])


# ===================================================================== upsert at table scale

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _orders_delta(orders: DataFrame, every: int) -> DataFrame:
    """Delta of ~2/every of orders: status updates of keys % every = 0,
    new orders (negated keys) for keys % every = 1."""
    k = F.col("o_orderkey")
    upd = orders.filter(k % every == 0).withColumn("o_orderstatus", F.lit("U"))
    new = orders.filter(k % every == 1).withColumn("o_orderkey", -k - 1)
    return upd.unionByName(new)


def _orders_upsert_sql(every: int) -> str:
    return f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % {every} = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority FROM orders
UNION ALL
SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % {every} = 1"""


@register("upsert_orders_1pct", _orders_upsert_sql(100))
def upsert_orders_1pct(spark, d):
    """Whole orders table as target, 1% updates + 1% inserts; strategy chosen by size."""
    o = read_table(spark, d, "orders")
    return merge.upsert(o, _orders_delta(o, 100), ["o_orderkey"], strategy="auto").table


@register("upsert_orders_10pct", _orders_upsert_sql(10))
def upsert_orders_10pct(spark, d):
    """Whole orders table as target, 10% updates + 10% inserts, shuffle (sort-merge) join."""
    o = read_table(spark, d, "orders")
    return merge.upsert(o, _orders_delta(o, 10), ["o_orderkey"], strategy="shuffle").table


@register("upsert_orders_10pct_feed", f"""
SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       'INSERT' AS _change_action, true AS _change_is_update FROM orders WHERE o_orderkey % 10 = 0
UNION ALL
SELECT *, 'DELETE', true FROM orders WHERE o_orderkey % 10 = 0
UNION ALL
SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, 'INSERT', false
FROM orders WHERE o_orderkey % 10 = 1""")
def upsert_orders_10pct_feed(spark, d):
    o = read_table(spark, d, "orders")
    return merge.upsert(o, _orders_delta(o, 10), ["o_orderkey"], strategy="shuffle").feed
