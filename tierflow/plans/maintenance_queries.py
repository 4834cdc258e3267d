"""Registered queries for tables that are kept up to date batch by batch.

Touched-bucket upserts, marts folded from feeds, histories spliced by event
time, multi-line CSV read in ranges, and reloads told by content. All work on
whole driver tables; the tables they maintain lie in fresh folders under the
shared scratch folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions import privacy
from tierflow.operators import cdc, merge
from tierflow.operators.consumers import Consumer, trim
from tierflow.operators.merge import ACTION, IS_UPDATE
from tierflow.operators.timeline import Timeline
from tierflow.operators.unique import KeyFilter, violations
from tierflow.plans import standins as st
from tierflow.plans.change_queries import _DAYS_SQL, _SCD_SOUND_SQL, _orders_delta, _ORDER_COLS
from tierflow.plans.incremental import MartStore
from tierflow.plans.registry import register
from tierflow.plans import batch, entities, marts
from tierflow.sources import ingest, multiline
from tierflow.session import materialize, unique_scratch
from tierflow.sources.buckets import BucketedTable
from tierflow.sources.tables import read_table

# ===================================================================== touched buckets

BUCKETS = 64


def sql_bucket(df: DataFrame, keys, n: int):
    """A bucket that other engines can compute as well: by the MD5 of the key."""
    digest = F.md5(F.col(keys[0]).cast("string").cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % n).cast("int")


_BUCKET_SQL = f"(('0x' || substr(md5(CAST({{k}} AS VARCHAR)), 1, 8))::BIGINT % {BUCKETS})"


@register("upsert_bucketed", f"""
WITH new AS (SELECT *, {_BUCKET_SQL.format(k='o_orderkey')} AS b FROM (
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 50 = 0 AND {_BUCKET_SQL.format(k='o_orderkey')} IN (3, 17, 40) THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority FROM orders
    UNION ALL
    SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderkey % 50 = 1 AND {_BUCKET_SQL.format(k='-o_orderkey - 1')} IN (3, 17, 40))),
hit AS (SELECT DISTINCT b FROM new WHERE o_orderkey < 0 OR o_orderkey % 50 = 0 AND b IN (3, 17, 40))
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       CASE WHEN b IN (SELECT b FROM hit) THEN 2 ELSE 1 END AS written_by FROM new""")
def upsert_bucketed(spark, d):
    """Orders by buckets, then a delta whose keys fall into three of them; ``written_by`` is the version a row lies in."""
    o = read_table(spark, d, "orders").select(*_ORDER_COLS)
    table = BucketedTable(spark, unique_scratch(spark, "orders"), ["o_orderkey"], BUCKETS, sql_bucket)
    table.upsert(o)
    delta = _orders_delta(o, 50).filter(sql_bucket(o, ["o_orderkey"], BUCKETS).isin(3, 17, 40))
    table.upsert(delta)
    return table.rows().select(*_ORDER_COLS, F.col("v").alias("written_by"))


@register("upsert_not_older", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
       CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate, o_orderpriority FROM orders""")
def upsert_not_older(spark, d):
    """Newer rows for keys % 10 = 0, older ones for keys % 10 = 1 that change nothing."""
    o = read_table(spark, d, "orders").select(*_ORDER_COLS)
    k = F.col("o_orderkey")
    moved = F.when(k % 10 == 0, F.expr("o_orderdate + INTERVAL 1 DAY")).otherwise(F.expr("o_orderdate - INTERVAL 1 DAY"))
    delta = o.filter(k % 10 < 2).withColumns({"o_orderstatus": F.lit("U"), "o_orderdate": moved})
    return merge.upsert(o, delta, ["o_orderkey"], not_older="o_orderdate").table


# ===================================================================== incremental marts

def _images(df: DataFrame, action: str, is_update: bool) -> DataFrame:
    return df.withColumns({ACTION: F.lit(action), IS_UPDATE: F.lit(is_update)})


def _feeds(spark, d):
    """Four batches of (lines, orders) feeds: a first load, new orders, changed lines, deleted and moved orders."""
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_discount")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    lk, ok = F.col("l_orderkey"), F.col("o_orderkey")
    none = [li.limit(0), o.limit(0)]
    yield _images(li.filter(lk % 5 != 0), "INSERT", False), _images(o.filter(ok % 5 != 0), "INSERT", False)
    yield _images(li.filter(lk % 5 == 0), "INSERT", False), _images(o.filter(ok % 5 == 0), "INSERT", False)
    changed = (lk % 7 == 0) & (F.col("l_linenumber") == 1)
    cheaper = li.withColumns({"l_discount": F.lit(0.5), "l_suppkey": F.when(lk % 2 == 0, F.col("l_suppkey") % 10 + 1).otherwise(F.col("l_suppkey"))})
    yield (_images(li.filter(changed), "DELETE", True).unionByName(_images(cheaper.filter(changed), "INSERT", True)),
           _images(none[1], "INSERT", False))
    gone, moves = ok % 11 == 3, (ok % 13 == 0) & (ok % 11 != 3)
    lines = li.filter(~changed).unionByName(cheaper.filter(changed)).filter(lk % 11 == 3)
    later = o.withColumn("o_orderdate", F.expr("o_orderdate + INTERVAL 40 DAY"))
    yield (_images(lines, "DELETE", False), reduce(DataFrame.unionByName, [
        _images(o.filter(gone), "DELETE", False), _images(o.filter(moves), "DELETE", True), _images(later.filter(moves), "INSERT", True)]))


def _store(spark, d) -> MartStore:
    # A bucket is written by one task: about a million lines each.
    buckets = max(16, marts.partitions_for(read_table(spark, d, "lineitem")) // 4)
    store = MartStore(spark, unique_scratch(spark, "marts"), buckets)
    for n, (lines, orders) in enumerate(_feeds(spark, d), 1):
        store.apply(lines, orders, n)
    return store


_FINAL_SQL = """
lines AS (SELECT l_orderkey,
    CASE WHEN l_orderkey % 14 = 0 AND l_linenumber = 1 THEN l_suppkey % 10 + 1 ELSE l_suppkey END AS l_suppkey,
    CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(CASE WHEN l_orderkey % 7 = 0 AND l_linenumber = 1 THEN 0.5 ELSE l_discount END AS DECIMAL(4,2))) AS revenue
  FROM lineitem WHERE l_orderkey % 11 <> 3),
moved AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN o_orderdate + INTERVAL 40 DAY ELSE o_orderdate END AS day FROM orders WHERE o_orderkey % 11 <> 3),
dated AS (SELECT l.*, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month FROM lines l JOIN moved ON o_orderkey = l_orderkey)"""

_MART_SQL = """SELECT {keys}, CAST(sum(r) AS DECIMAL(38,4)) AS total_revenue, count(*) AS total_orders,
       CAST(sum(r) AS DOUBLE) / count(*) AS avg_revenue_per_order, CAST(sum(r) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS avg_revenue_per_item,
       CAST(max(r) AS DECIMAL(38,4)) AS max_order_value
FROM (SELECT {inner}, sum(revenue) AS r, count(*) AS n FROM dated GROUP BY {inner}) t {join} GROUP BY {group}"""


@register("mart_incremental", f"WITH {_FINAL_SQL} " + _MART_SQL.format(
    keys="year, month", inner="l_orderkey, year, month", join="", group="year, month"))
def mart_incremental(spark, d):
    """The monthly mart after a first load and three feeds; equals a full build over the final facts."""
    return _store(spark, d).monthly()


@register("mart_incremental_yearly", f"WITH {_FINAL_SQL} " + _MART_SQL.format(keys="year", inner="l_orderkey, year", join="", group="year"))
def mart_incremental_yearly(spark, d):
    return _store(spark, d).yearly()


@register("mart_incremental_by_supplier", f"WITH {_FINAL_SQL} " + _MART_SQL.format(
    keys="year, month, l_suppkey AS restaurant_id, any_value(s_name) AS restaurant_name", inner="l_orderkey, l_suppkey, year, month",
    join="LEFT JOIN supplier ON s_suppkey = l_suppkey", group="year, month, l_suppkey"))
def mart_incremental_by_supplier(spark, d):
    return _store(spark, d).monthly_by_restaurant(read_table(spark, d, "supplier"))


# ===================================================================== histories by event time

def _timeline(spark, d, arrival) -> Timeline:
    customer = read_table(spark, d, "customer")
    line = Timeline(spark, unique_scratch(spark, "timeline"), st.CUSTOMER_KEYS, st.CUSTOMER_TRACK, "day_ts")
    for n, day in enumerate(arrival, 1):
        rows = st.customer_day(customer, day).drop("_load_batch")
        line.splice(rows.withColumn("day_ts", F.lit(st.DAY_TS[day]).cast("timestamp_ntz")), consumed=n)
    return line


@register("scd2_any_order", _SCD_SOUND_SQL + " SELECT * FROM dim")
def scd2_any_order(spark, d):
    """The batches of three days, arriving as day 3, day 1, day 2: the history is that of the right order."""
    return _timeline(spark, d, (3, 1, 2)).dimension()


@register("scd2_as_of", f"""WITH {_DAYS_SQL},
seen AS (SELECT * FROM day1 UNION ALL SELECT * FROM day2)
SELECT c_custkey, arg_max(c_name, _load_batch) AS c_name, arg_max(c_nationkey, _load_batch) AS c_nationkey, arg_max(c_acctbal, _load_batch) AS c_acctbal,
       max_by(struct_pack(s := c_mktsegment), _load_batch).s AS c_mktsegment
FROM seen GROUP BY c_custkey""")
def scd2_as_of(spark, d):
    """What was in force on day 2, from a history whose batches came backwards."""
    cols = [*st.CUSTOMER_KEYS, *st.CUSTOMER_TRACK]
    return _timeline(spark, d, (3, 2, 1)).as_of(st.DAY_TS[2]).select(*cols)


# ===================================================================== files

def _note_files(spark, d) -> str:
    """Customers as CSV whose quoted fields hold line breaks, quotes and separators."""
    c = read_table(spark, d, "customer")
    note = F.concat(F.col("c_name"), F.lit('\nsaid "'), F.col("c_mktsegment"), F.lit('",\n\n'), F.col("c_custkey").cast("string"))
    rows = c.select(F.col("c_custkey").cast("string").alias("c_custkey"), F.when(F.col("c_custkey") % 3 > 0, note).otherwise(F.col("c_name")).alias("note"),
                    F.col("c_nationkey").cast("string").alias("c_nationkey"))
    path = unique_scratch(spark, "notes")
    ingest.write_csv(rows, path)
    return path


@register("csv_multiline_split", """
SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_name || chr(10) || 'said "' || c_mktsegment || '",' || chr(10) || chr(10) || c_custkey ELSE c_name END AS note,
       c_nationkey FROM customer""")
def csv_multiline_split(spark, d):
    """Files with line breaks inside quotes, cut into byte ranges."""
    schema, options = ingest.csv_format(["c_custkey", "note", "c_nationkey"])
    rows = multiline.read_records(spark, [_note_files(spark, d)], schema, options)
    return rows.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "note", F.col("c_nationkey").cast("bigint").alias("c_nationkey"))


def _landed(spark, d) -> str:
    path = unique_scratch(spark, "landing")
    stage = st.location_stage(read_table(spark, d, "customer"), 1)
    ingest.write_csv(stage.select(*entities.LOCATION.stage_cols), path)
    return path


def _touch(spark, path: str) -> None:
    """Give every file a new modification time, as an upload of the same bytes does."""
    from tierflow.sources.tables import _fs

    fs, folder, _ = _fs(spark, path)
    for status in fs.listStatus(folder):
        fs.setTimes(status.getPath(), status.getModificationTime() + 60_000, -1)


@register("copy_reupload", """
SELECT 1 AS load, count(*) AS n_rows, 'LOADED' AS status FROM customer
UNION ALL SELECT 2, 0, 'SKIPPED'""")
def copy_reupload(spark, d):
    """Files uploaded again with the same bytes under a new time: the second load takes nothing."""
    e, path = entities.LOCATION, _landed(spark, d)
    wh = batch.Warehouse(spark, unique_scratch(spark, "reupload"))
    batch.copy_into(wh, e, path)
    _touch(spark, path)
    batch.copy_into(wh, e, path)
    loads = wh.ledger.loads().groupBy("status").agg(F.sum("rows_loaded").alias("n_rows"))
    return loads.select(F.when(F.col("status") == "LOADED", 1).otherwise(2).alias("load"), "n_rows", "status")


@register("copy_on_error", """
SELECT 'loaded' AS part, count(*) FILTER (c_custkey % 5 <> 0) AS n FROM customer
UNION ALL SELECT 'quarantined', count(*) FILTER (c_custkey % 5 = 0) FROM customer""")
def copy_on_error(spark, d):
    """Every fifth line lacks a field: it is kept apart, the others are loaded."""
    e = entities.LOCATION
    c = read_table(spark, d, "customer")
    k = F.col("c_custkey").cast("string")
    line = F.when(F.col("c_custkey") % 5 == 0, F.concat(k, F.lit(",short"))).otherwise(
        F.concat_ws(",", k, F.lit("Pune"), F.lit("Maharashtra"), F.lit("411001"), F.lit("Yes"), F.lit("2024-01-01 09:00:00"), F.lit("\\N")))
    path = unique_scratch(spark, "broken")
    # One text column named like the header, without quoting: lines as they are, a header in each file.
    c.select(line.alias(",".join(e.stage_cols))).write.options(header=True, sep="\x01", quote="\0", escape="\0", emptyValue="").csv(path)
    wh = batch.Warehouse(spark, unique_scratch(spark, "on-error"))
    batch.copy_into(wh, e, path, on_error="continue")
    bad = spark.read.parquet(f"{wh.root}/quarantine/{e.name}_load")
    parts = wh.stage(e).select(F.lit("loaded").alias("part")).unionByName(bad.select(F.lit("quarantined").alias("part")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


# ===================================================================== keys, consumers, derived tags

@register("unique_incremental", """
WITH batch AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 97 = 1
               UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 50 = 0)
SELECT o_orderkey, 'repeats' AS reason FROM batch GROUP BY o_orderkey HAVING count(*) > 1
UNION ALL SELECT o_orderkey, 'exists' FROM orders WHERE o_orderkey % 97 = 1 AND o_orderkey % 10 <> 0""")
def unique_incremental(spark, d):
    """A batch checked against the filter of all keys so far: planted old keys and repeated new ones."""
    o = read_table(spark, d, "orders").select(*_ORDER_COLS)
    k = F.col("o_orderkey")
    table = BucketedTable(spark, unique_scratch(spark, "unique"), ["o_orderkey"], 16)
    table.upsert(o.filter(k % 10 != 0))
    seen = KeyFilter(spark, unique_scratch(spark, "filter"), ["o_orderkey"])
    seen.add(o.filter(k % 10 != 0))
    batch_rows = o.filter((k % 10 == 0) | (k % 97 == 1)).unionByName(o.filter(k % 50 == 0))
    return violations(batch_rows, table, seen)


@register("feed_consumers", f"""WITH {_DAYS_SQL},
net AS (SELECT t.c_custkey, t.c_mktsegment, 'DELETE' AS action FROM day1 t JOIN up3 s USING (c_custkey)
          WHERE {" OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in st.CUSTOMER_TRACK)}
        UNION ALL SELECT s.c_custkey, s.c_mktsegment, 'INSERT' FROM day1 t JOIN up3 s USING (c_custkey)
          WHERE {" OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in st.CUSTOMER_TRACK)}
        UNION ALL SELECT c_custkey, c_mktsegment, 'INSERT' FROM up3 WHERE c_custkey NOT IN (SELECT c_custkey FROM day1))
SELECT consumer, net.* FROM net, (VALUES ('daily'), ('late')) t(consumer)""")
def feed_consumers(spark, d):
    """One consumer takes each day's feed, another both at once after the feed was trimmed: both get the same net changes."""
    customer, root = read_table(spark, d, "customer"), unique_scratch(spark, "consumers")
    table = BucketedTable(spark, f"{root}/table", st.CUSTOMER_KEYS)
    table.upsert(st.customer_day(customer, 1).drop("_load_batch"), track=st.CUSTOMER_TRACK)
    daily, late = (Consumer(table, f"{root}/consumers", name, start=1) for name in ("daily", "late"))
    taken = []
    for n, day in enumerate((2, 3), 1):
        table.upsert(st.customer_day(customer, day).drop("_load_batch"), track=st.CUSTOMER_TRACK)
        rows, upto = daily.pending()
        taken.append(materialize(cdc.with_batch(rows, n)))
        daily.advance(upto)
        trim(table, [daily, late])
    both = cdc.net_changes(reduce(DataFrame.unionByName, taken), st.CUSTOMER_KEYS, compare=st.CUSTOMER_TRACK)
    parts = [both.withColumn("consumer", F.lit("daily")), late.pending()[0].withColumn("consumer", F.lit("late"))]
    return reduce(DataFrame.unionByName, parts).select("consumer", "c_custkey", "c_mktsegment", F.col(ACTION).alias("action"))


@register("mask_derived", """
SELECT c_custkey, '** PII **' AS label, '** EAMIL **' AS domain, '** PII **' AS both_of_them, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) * 2 AS twice
FROM customer""")
def mask_derived(spark, d):
    """Columns computed from tagged ones carry the tag through expressions, a join and a union."""
    c = read_table(spark, d, "customer")
    contact = privacy.tag(c.select("c_custkey", F.col("c_name").alias("name"), F.concat("c_name", F.lit("@mail")).alias("email")), {"name": "PII", "email": "EMAIL"})
    money = privacy.tag(c.select(F.col("c_custkey").alias("k"), "c_nationkey", F.col("c_acctbal").cast("decimal(12,2)").alias("balance")), {"balance": "PRICE"})
    joined = contact.join(money, F.col("c_custkey") == F.col("k"))
    out = joined.select("c_custkey", F.upper(F.concat("name", F.lit("!"))).alias("label"), F.split("email", "@")[1].alias("domain"),
                        F.concat_ws("|", "email", "name").alias("both_of_them"), "c_nationkey", (F.col("balance") * 2).alias("twice"))
    halves = [out.filter("c_custkey % 2 = 0"), out.filter("c_custkey % 2 = 1").withColumn("label", F.lower("label"))]
    return privacy.mask_derived(reduce(DataFrame.unionByName, halves))
