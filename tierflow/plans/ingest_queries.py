"""Registered queries for CSV ingest, the load ledger, the batch runner and streaming.

Each query lands driver-table rows as CSV files in a fresh scratch folder
(under ``spark.checkpoint.dir``), runs the loader/runner over them, and
returns what was stored. The oracles restate the expected stored values
from the same driver tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.plans import batch, marts, reports, standins as st
from tierflow.plans import registry as _reg
from tierflow.plans.change_queries import _DAYS_SQL
from tierflow.plans.entities import Entity
from tierflow.plans.registry import register
from tierflow.session import unique_scratch
from tierflow.sources import ingest
from tierflow.sources.tables import read_table
from tierflow.streaming import stream

AS_OF = dt.datetime(2024, 1, 1, 12, 0, 0)

_TEXT_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "label"]


def _customer_text(spark, d) -> DataFrame:
    """Customer rows as text, with a label that needs quoting (comma, quotes)."""
    base = st.customer_base(read_table(spark, d, "customer"))
    return base.select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.col("c_acctbal").cast("string").alias("c_acctbal"),
        "c_mktsegment",
        F.concat(F.col("c_name"), F.lit(', "'), F.coalesce("c_mktsegment", F.lit("none")), F.lit('"'))
        .alias("label"),
    )


_TEXT_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal,
       nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment,
       c_name || ', "' || coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), 'none') || '"' AS label
FROM customer"""

_TEXT_ENTITY = Entity(
    name="customer_text", stage_cols=_TEXT_COLS, conform=lambda df: df, keys=["c_custkey"],
    surrogate="sk", clean_cols=_TEXT_COLS, update_cols=_TEXT_COLS[1:], track=None,
    dim_name="customer_text_dim", dim_hash="hk", dim_values=_TEXT_COLS, dim_match=_TEXT_COLS,
    dim_hash_cols=_TEXT_COLS,
)


def _landed(spark, d, name: str) -> tuple[str, str]:
    root = unique_scratch(spark, name)
    landing = f"{root}/landing/customer"
    ingest.write_csv(_customer_text(spark, d), landing)
    return root, landing


@register("csv_roundtrip", _TEXT_SQL)
def csv_roundtrip(spark, d):
    root, landing = _landed(spark, d, "csv-roundtrip")
    wh = batch.Warehouse(spark, f"{root}/wh")
    batch.copy_into(wh, _TEXT_ENTITY, landing, as_of=AS_OF)
    return wh.stage(_TEXT_ENTITY).select(*_TEXT_COLS)


@register("csv_positional", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
       nullif(c_mktsegment, 'HOUSEHOLD') AS pincode, CAST(c_nationkey AS VARCHAR) AS state
FROM customer""")
def csv_positional(spark, d):
    """File order (id, name, State, Pincode) bound by position to (id, name, pincode, state)."""
    root = unique_scratch(spark, "csv-positional")
    t = _customer_text(spark, d).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("State"), F.col("c_nationkey").alias("Pincode"))
    ingest.write_csv(t, f"{root}/landing")
    staged = ingest.read_staged(spark, f"{root}/landing", ["id", "name", "State", "Pincode"],
                                target_cols=["id", "name", "pincode", "state"], as_of=AS_OF)
    return staged.select("id", "name", "pincode", "state")


@register("csv_by_name", """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
       CAST(c_nationkey AS VARCHAR) AS pincode, nullif(c_mktsegment, 'HOUSEHOLD') AS state
FROM customer""")
def csv_by_name(spark, d):
    """Same file, bound by header name: no crossover."""
    root = unique_scratch(spark, "csv-by-name")
    t = _customer_text(spark, d).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("state"), F.col("c_nationkey").alias("pincode"))
    ingest.write_csv(t, f"{root}/landing")
    staged = ingest.read_staged(spark, f"{root}/landing", ["id", "name", "state", "pincode"],
                                target_cols=["id", "name", "pincode", "state"], bind_by="name",
                                as_of=AS_OF)
    return staged.select("id", "name", "pincode", "state")


@register("copy_idempotent", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS second_load_rows FROM customer""")
def copy_idempotent(spark, d):
    root, landing = _landed(spark, d, "copy-idempotent")
    wh = batch.Warehouse(spark, f"{root}/wh")
    batch.copy_into(wh, _TEXT_ENTITY, landing, as_of=AS_OF)
    second = batch.copy_into(wh, _TEXT_ENTITY, landing, as_of=AS_OF)
    return wh.stage(_TEXT_ENTITY).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "second_load_rows", F.lit(second.rows).cast("bigint"))


@register("copy_history", """
SELECT 'customer_text' AS table_name, 'LOADED' AS status, CAST(count(*) AS BIGINT) AS rows_loaded
FROM customer""")
def copy_history(spark, d):
    root, landing = _landed(spark, d, "copy-history")
    wh = batch.Warehouse(spark, f"{root}/wh")
    batch.copy_into(wh, _TEXT_ENTITY, landing, as_of=AS_OF)
    hist = wh.ledger.copy_history("customer_text", now=AS_OF + dt.timedelta(minutes=30))
    return hist.groupBy("table_name", "status").agg(F.sum("rows_loaded").cast("bigint").alias("rows_loaded"))


@register("list_files", """
SELECT true AS same_files, true AS same_bytes, true AS keys_unique, CAST(count(*) AS BIGINT) AS scanned_rows FROM customer""")
def list_files(spark, d):
    """The listing of the landed files against what a scan of them reports."""
    _, landing = _landed(spark, d, "list-files")
    listed = ingest.list_files(spark, landing).filter(F.col("path").endswith(".csv"))
    raw = ingest.csv_reader(spark, _TEXT_COLS).load(landing)
    scanned = raw.select(ingest.scanned_path().alias("path"), F.col("_metadata.file_size").alias("size"), ingest.file_key().alias("key"))
    files = scanned.groupBy("path").agg(F.max("size").alias("size"), F.max("key").alias("key"), F.count(F.lit(1)).alias("n"))
    tail = lambda c: F.element_at(F.split(c, "/"), -1)
    both = listed.select(tail(F.col("path")).alias("name"), "length", "file_key").join(
        files.select(tail(F.col("path")).alias("name"), "size", "key", "n"), "name", "left")
    # A file without rows is listed but reports nothing to a scan.
    return both.agg(
        (F.count("n") == F.lit(files.count())).alias("same_files"),
        F.bool_and(F.col("n").isNull() | (F.col("length") == F.col("size"))).alias("same_bytes"),
        (F.countDistinct("file_key") == F.count(F.lit(1))).alias("keys_unique"),
        F.sum("n").alias("scanned_rows"))


# ------------------------------------------------------------------ runner and stream

def _land_days(spark, d, root: str) -> str:
    c = read_table(spark, d, "customer")
    landing = f"{root}/landing"
    for day in (1, 2, 3):
        ingest.write_csv(st.customer_text(c, day), f"{landing}/day{day}")
    return landing


_FINAL_SQL = f"WITH {_DAYS_SQL} SELECT * FROM up3"


@register("batch_runner_clean", _FINAL_SQL)
def batch_runner_clean(spark, d):
    """Three daily files through copy -> clean merge -> dimension (batch path)."""
    root = unique_scratch(spark, "batch-runner")
    c = read_table(spark, d, "customer")
    wh = batch.Warehouse(spark, f"{root}/wh")
    e = st.CUSTOMER_STANDIN
    for day in (1, 2, 3):
        path = f"{root}/landing/day{day}"
        ingest.write_csv(st.customer_text(c, day), path)
        batch.run_batch(wh, e, path, as_of=dt.datetime(2024, 1, day))
    return wh.clean(e).select(*st.CUSTOMER_VALUES, "_load_batch")


@register("stream_equals_batch", _FINAL_SQL)
def stream_equals_batch(spark, d):
    """The same three files through a file stream (availableNow) and foreachBatch."""
    root = unique_scratch(spark, "stream")
    landing = _land_days(spark, d, root)
    wh = batch.Warehouse(spark, f"{root}/wh")
    e = st.CUSTOMER_STANDIN
    stream.run_entity(spark, wh, e, landing, f"{root}/checkpoint", as_of=AS_OF)
    # A second run finds nothing new: the checkpoint and ledger both say so.
    stream.run_entity(spark, wh, e, landing, f"{root}/checkpoint", as_of=AS_OF)
    return wh.clean(e).select(*st.CUSTOMER_VALUES, "_load_batch")


@register("stream_dim_current", f"""WITH {_DAYS_SQL}
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM up3""")
def stream_dim_current(spark, d):
    """Current dimension rows after streaming all three days in one go.

    All three files may arrive in one micro-batch; the latest version of
    each key wins, so the current rows equal the final clean values.
    """
    root = unique_scratch(spark, "stream-dim")
    landing = _land_days(spark, d, root)
    wh = batch.Warehouse(spark, f"{root}/wh")
    e = st.CUSTOMER_STANDIN
    stream.run_entity(spark, wh, e, landing, f"{root}/checkpoint", as_of=AS_OF)
    dim = wh.dim(e, "sound")
    return dim.filter(F.col("is_current")).select(*st.CUSTOMER_VALUES)



# ------------------------------------------------------------------ published marts

def _published(spark, d) -> str:
    root = unique_scratch(spark, "marts")
    marts.publish(read_table(spark, d, "lineitem"), read_table(spark, d, "orders"),
                  read_table(spark, d, "supplier"), root)
    return root


@register("kpi_yearly_published", _reg.ORACLE["kpi_yearly"])
def kpi_yearly_published(spark, d):
    """The yearly mart written partitioned by year and read back."""
    out = marts.read_published(spark, _published(spark, d), "yearly")
    return out.select("year", *marts.MEASURES).orderBy("year")


@register("quarterly_totals_published", _reg.ORACLE["quarterly_totals"])
def quarterly_totals_published(spark, d):
    """Quarterly report over the published monthly mart (reads only year=1998)."""
    monthly = marts.read_published(spark, _published(spark, d), "monthly")
    return reports.quarterly(monthly, year=1998)
