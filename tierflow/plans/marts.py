"""Revenue KPI marts: yearly, monthly, and monthly by restaurant.

The dashboard reads three views whose definitions are not given; the
formulas here follow their column names:

  total_revenue          sum of line revenue, price * (1 - discount)
  total_orders           orders with at least one line in the period
  avg_revenue_per_order  total_revenue / total_orders
  avg_revenue_per_item   total_revenue / number of lines
  max_order_value        largest single order total in the period

Restaurants are stood in by suppliers: an order spanning two suppliers
counts once for each, with only that supplier's lines in its total.

Plan shape (checked with ``explain``): for the yearly and monthly marts line
items are aggregated per order before any shuffle (partial aggregation
collapses even an order holding a third of all lines) and the per-order rows
are joined to ``orders`` on the key they are already partitioned by. The
restaurant mart joins its few line columns to ``orders`` first and aggregates
by (order, supplier) on that partitioning, so the facts are shuffled once, into
as many partitions as they need at ``ROWS_OF_TASK`` lines each: what a task
sorts and hashes does not grow with the facts. The final per-period aggregation
shuffles only partial sums, one row per period per task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.session import unique_scratch

REVENUE_TYPE = "decimal(38,4)"

#: Lines that one task of a join or aggregation takes: about 100 MB of sorted rows and hash maps.
ROWS_OF_TASK = 250_000

MEASURES = (
    "total_revenue",
    "total_orders",
    "avg_revenue_per_order",
    "avg_revenue_per_item",
    "max_order_value",
)


def line_revenue() -> Column:
    """Exact line revenue: both factors as decimals so sums do not depend on order."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    return price * (F.lit(1) - discount)


def partitions_for(facts: DataFrame) -> int:
    """Partitions of ``ROWS_OF_TASK`` rows; for a table, the count comes from the footers of its files."""
    return max(facts.sparkSession.sparkContext.defaultParallelism, math.ceil(facts.count() / ROWS_OF_TASK))


def _order_totals(lineitem: DataFrame, orders: DataFrame, by_supplier: bool, parts: int | None = None) -> DataFrame:
    """``parts``: partitions that the facts are dealt over by order; None leaves that, and a broadcast, to Spark."""
    dated = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.year("o_orderdate").cast("int").alias("year"),
        F.month("o_orderdate").cast("int").alias("month"),
    )
    totals = [F.sum(line_revenue()).alias("order_revenue"), F.count(F.lit(1)).alias("n_items")]
    if not by_supplier:
        return lineitem.groupBy("l_orderkey").agg(*totals).join(dated, "l_orderkey")
    lines = lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount")
    if parts:
        lines, dated = lines.repartition(parts, "l_orderkey"), dated.repartition(parts, "l_orderkey")
    lines = lines.join(dated, "l_orderkey")
    return lines.groupBy("l_orderkey", "l_suppkey", "year", "month").agg(*totals)


def _measures(grouped) -> DataFrame:
    return grouped.agg(
        F.sum("order_revenue").cast(REVENUE_TYPE).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("n_items").alias("total_items"),
        F.max("order_revenue").cast(REVENUE_TYPE).alias("max_order_value"),
    )


def with_averages(df: DataFrame) -> DataFrame:
    """The ratios of a mart from its additive measures."""
    revenue = F.col("total_revenue").cast("double")
    return df.withColumn(
        "avg_revenue_per_order", revenue / F.col("total_orders").cast("double")
    ).withColumn(
        "avg_revenue_per_item", revenue / F.col("total_items").cast("double")
    )


def yearly_kpis(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per year: year + the five measures."""
    totals = _order_totals(lineitem, orders, by_supplier=False)
    out = with_averages(_measures(totals.groupBy("year")))
    return out.select("year", *MEASURES)


def monthly_kpis(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per (year, month) with orders."""
    totals = _order_totals(lineitem, orders, by_supplier=False)
    out = with_averages(_measures(totals.groupBy("year", "month")))
    return out.select("year", "month", *MEASURES)


def monthly_by_restaurant(
    lineitem: DataFrame, orders: DataFrame, supplier: DataFrame
) -> DataFrame:
    """One row per (year, month, restaurant); restaurant = supplier.

    The supplier name is joined after aggregation, so the join sees one
    row per (period, supplier) instead of one per line item. Whether that
    join broadcasts is left to Spark's size check
    (``spark.sql.autoBroadcastJoinThreshold`` and AQE's runtime sizes):
    the supplier table grows with the data and is not hinted.
    """
    totals = _order_totals(lineitem, orders, by_supplier=True, parts=partitions_for(lineitem))
    return _by_restaurant(totals, supplier)


def monthly_by_restaurant_of(lineitem: DataFrame, orders: DataFrame, supplier: DataFrame, year: int, month: int | None = None) -> DataFrame:
    """``monthly_by_restaurant`` of the orders of one year or month.

    Keys and dates of these orders are written first. Where they are small Spark
    then broadcasts them to the scan of the lines, which are not shuffled; where
    they are not, only the lines of these orders go on to the aggregation.
    """
    path = unique_scratch(orders.sparkSession, "mart-orders")
    few = orders_in(orders, year, month).select("o_orderkey", "o_orderdate")
    few.write.parquet(path)
    few = orders_in(orders.sparkSession.read.schema(few.schema).parquet(path), year, month)
    return _by_restaurant(_order_totals(lineitem, few, by_supplier=True), supplier)


def _by_restaurant(totals: DataFrame, supplier: DataFrame) -> DataFrame:
    agg = with_averages(_measures(totals.groupBy("year", "month", "l_suppkey")))
    names = supplier.select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("restaurant_name")
    )
    out = agg.join(names, "l_suppkey", "left")
    return out.select(
        "year",
        "month",
        F.col("l_suppkey").alias("restaurant_id"),
        "restaurant_name",
        *MEASURES,
    )


def orders_in(orders: DataFrame, first: int, month: int | None = None, last: int | None = None) -> DataFrame:
    """Orders of the years first..last (default: one), or of one month, by a range of dates."""
    if month is None:
        lo, hi = f"{first}-01-01", f"{(last or first) + 1}-01-01"
    else:
        lo, hi = f"{first}-{month:02d}-01", f"{first + month // 12}-{month % 12 + 1:02d}-01"
    date = F.col("o_orderdate")
    kind = orders.schema["o_orderdate"].dataType.simpleString()
    return orders.filter((date >= F.lit(lo).cast(kind)) & (date < F.lit(hi).cast(kind)))


def latest_period(lineitem: DataFrame, orders: DataFrame) -> tuple[int, int]:
    """Year and month of the last order that has a line: one date comes to the driver."""
    sold = orders.join(lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    last = sold.agg(F.max("o_orderdate").alias("d")).select(F.year("d").alias("y"), F.month("d").alias("m")).first()
    return last["y"], last["m"]


MART_NAMES = ("yearly", "monthly", "monthly_by_restaurant")


def publish(
    lineitem: DataFrame,
    orders: DataFrame,
    supplier: DataFrame,
    root: str,
    years: list[int] | None = None,
) -> None:
    """Write the three marts under ``root``, partitioned by ``year``.

    Readers filtering on ``year`` then prune partitions instead of
    recomputing. With ``years`` only those years are recomputed (orders are
    filtered on their date range, which reaches the parquet scan) and only
    their partitions are replaced (dynamic partition overwrite); other
    years stay as they are. Without ``years`` all partitions are replaced, so a
    year that no longer occurs disappears.
    """
    parts = partitions_for(lineitem)
    if years:
        orders = orders_in(orders, min(years), last=max(years)).filter(F.year("o_orderdate").isin(list(years)))
        # Lines of other orders go before they are aggregated.
        lineitem = lineitem.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    # The facts are read once: both marts come from the totals by order and supplier,
    # and the yearly one from the monthly one, as an order has one date.
    path = unique_scratch(lineitem.sparkSession, "mart-totals")
    written = _order_totals(lineitem, orders, by_supplier=True, parts=parts)
    written.write.parquet(path)
    totals = lineitem.sparkSession.read.schema(written.schema).parquet(path)
    # Dealt before they are aggregated: a split of the files holds far more rows than one task should hash.
    per_order = totals.repartition(parts, "l_orderkey").groupBy("l_orderkey", "year", "month").agg(
        F.sum("order_revenue").alias("order_revenue"), F.sum("n_items").alias("n_items"))
    monthly = _measures(per_order.groupBy("year", "month"))
    yearly = monthly.groupBy("year").agg(
        F.sum("total_revenue").cast(REVENUE_TYPE).alias("total_revenue"), F.sum("total_orders").alias("total_orders"),
        F.sum("total_items").alias("total_items"), F.max("max_order_value").alias("max_order_value"))
    frames = {
        "yearly": with_averages(yearly).select("year", *MEASURES),
        "monthly": with_averages(monthly).select("year", "month", *MEASURES),
        "monthly_by_restaurant": _by_restaurant(totals.repartition(parts, "year", "month", "l_suppkey"), supplier),
    }
    for name, df in frames.items():
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if years else "static")
         .partitionBy("year").parquet(f"{root.rstrip('/')}/{name}"))


def read_published(spark, root: str, name: str) -> DataFrame:
    """A published mart; ``year`` comes back as a partition column."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
    cols = [c for c in df.columns if c != "year"]
    return df.select(F.col("year").cast("int").alias("year"), *cols)
