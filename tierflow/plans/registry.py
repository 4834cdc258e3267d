"""Registered queries: one Spark callable per operator, with its DuckDB oracle.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the driver's tables (or data Spark derives from them). The oracle SQL is
the same computation written for DuckDB against views of the same names.
Column names and types are aligned on both sides (see SURVEY §7.4 typing
rules): years and months are INT, counts BIGINT, money DECIMAL(38,4),
ratios DOUBLE.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.plans import marts, reports
from tierflow.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _pinned(fn: Query) -> Query:
    """Set what results rely on where a query starts: ANSI casts and UTC."""

    @functools.wraps(fn)
    def run(spark: SparkSession, d: str) -> DataFrame:
        spark.conf.set("spark.sql.ansi.enabled", "true")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, d)

    return run


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = _pinned(fn)
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# ------------------------------------------------------------ mart helpers

def _yearly(spark, d):
    return marts.yearly_kpis(read_table(spark, d, "lineitem"), read_table(spark, d, "orders"))


def _monthly(spark, d):
    return marts.monthly_kpis(read_table(spark, d, "lineitem"), read_table(spark, d, "orders"))


def _mbr(spark, d):
    return marts.monthly_by_restaurant(
        read_table(spark, d, "lineitem"),
        read_table(spark, d, "orders"),
        read_table(spark, d, "supplier"),
    )


def _latest(spark, d) -> tuple[int, int]:
    """Latest (year, month) with revenue: two key columns and a date are read for it."""
    return marts.latest_period(read_table(spark, d, "lineitem"), read_table(spark, d, "orders"))


def _mbr_of(spark, d, year: int, month: int | None = None):
    """The restaurant mart of one year or month; the date range reaches the scan of orders."""
    tables = (read_table(spark, d, t) for t in ("lineitem", "orders", "supplier"))
    return marts.monthly_by_restaurant_of(*tables, year, month)


# Oracle building blocks (DuckDB): the same definitions as marts.py.
_ORDER_TOTALS = """
per_order AS (
    SELECT l_orderkey,
           sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS order_revenue,
           count(*) AS n_items
    FROM lineitem GROUP BY l_orderkey
),
dated AS (
    SELECT p.*, CAST(year(o.o_orderdate) AS INTEGER) AS year,
           CAST(month(o.o_orderdate) AS INTEGER) AS month
    FROM per_order p JOIN orders o ON o.o_orderkey = p.l_orderkey
)"""

_SUPP_TOTALS = """
per_order AS (
    SELECT l_orderkey, l_suppkey,
           sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS order_revenue,
           count(*) AS n_items
    FROM lineitem GROUP BY l_orderkey, l_suppkey
),
dated AS (
    SELECT p.*, CAST(year(o.o_orderdate) AS INTEGER) AS year,
           CAST(month(o.o_orderdate) AS INTEGER) AS month
    FROM per_order p JOIN orders o ON o.o_orderkey = p.l_orderkey
)"""

_MEASURES = """
    CAST(sum(order_revenue) AS DECIMAL(38,4)) AS total_revenue,
    count(*) AS total_orders,
    CAST(sum(order_revenue) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_revenue_per_order,
    CAST(sum(order_revenue) AS DOUBLE) / CAST(sum(n_items) AS DOUBLE) AS avg_revenue_per_item,
    CAST(max(order_revenue) AS DECIMAL(38,4)) AS max_order_value"""

_YEARLY_CTE = f"""WITH {_ORDER_TOTALS},
yearly AS (SELECT year, {_MEASURES} FROM dated GROUP BY year)"""

_MONTHLY_CTE = f"""WITH {_ORDER_TOTALS},
monthly AS (SELECT year, month, {_MEASURES} FROM dated GROUP BY year, month)"""

_MBR_CTE = f"""WITH {_SUPP_TOTALS},
agg AS (SELECT year, month, l_suppkey, {_MEASURES} FROM dated GROUP BY year, month, l_suppkey),
mbr AS (
    SELECT a.year, a.month, a.l_suppkey AS restaurant_id, s.s_name AS restaurant_name,
           a.total_revenue, a.total_orders, a.avg_revenue_per_order,
           a.avg_revenue_per_item, a.max_order_value
    FROM agg a LEFT JOIN supplier s ON s.s_suppkey = a.l_suppkey
)"""


# ------------------------------------------------------------ marts (C6, E6-E8)

@register("kpi_yearly", f"{_YEARLY_CTE} SELECT * FROM yearly ORDER BY year")
def kpi_yearly(spark, d):
    return reports.yearly(_yearly(spark, d))


@register("kpi_monthly", f"{_MONTHLY_CTE} SELECT * FROM monthly ORDER BY year, month")
def kpi_monthly(spark, d):
    return _monthly(spark, d).orderBy("year", "month")


@register("kpi_monthly_by_supplier", f"{_MBR_CTE} SELECT * FROM mbr ORDER BY year, month, restaurant_id")
def kpi_monthly_by_supplier(spark, d):
    return _mbr(spark, d).orderBy("year", "month", "restaurant_id")


# ------------------------------------------------------------ reports (E2-E5, F1, F2, G1-G7)

@register("kpi_overall", f"""{_YEARLY_CTE}
SELECT CAST(sum(total_revenue) AS DECIMAL(38,4)) AS total_revenue_all_years,
       CAST(sum(total_orders) AS BIGINT) AS total_orders_all_years,
       max(max_order_value) AS max_order_value_overall
FROM yearly""")
def kpi_overall(spark, d):
    return reports.overall(_yearly(spark, d))


_YOY_SELECT = """
SELECT y.year, y.total_revenue, y.total_orders, y.avg_revenue_per_order,
       y.avg_revenue_per_item, y.max_order_value,
       CAST(y.total_revenue - p.total_revenue AS DECIMAL(38,4)) AS revenue_diff,
       y.total_orders - p.total_orders AS orders_diff,
       y.avg_revenue_per_order - p.avg_revenue_per_order AS avg_rev_order_diff,
       y.avg_revenue_per_item - p.avg_revenue_per_item AS avg_rev_item_diff,
       CAST(y.max_order_value - p.max_order_value AS DECIMAL(38,4)) AS max_order_diff
FROM {src} y LEFT JOIN {src} p ON p.year = y.year - 1
ORDER BY y.year"""


@register("yoy_delta", _YEARLY_CTE + _YOY_SELECT.format(src="yearly"))
def yoy_delta(spark, d):
    return _decimal_diffs(reports.yoy(_yearly(spark, d)))


@register("yoy_missing_year", _YEARLY_CTE + ", yr AS (SELECT * FROM yearly WHERE year <> 1998)"
          + _YOY_SELECT.format(src="yr"))
def yoy_missing_year(spark, d):
    from pyspark.sql import functions as F
    return _decimal_diffs(reports.yoy(_yearly(spark, d).filter(F.col("year") != 1998)))


def _decimal_diffs(df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F
    return df.withColumn("revenue_diff", F.col("revenue_diff").cast(marts.REVENUE_TYPE)).withColumn(
        "max_order_diff", F.col("max_order_diff").cast(marts.REVENUE_TYPE)
    )


_QUARTER = "'Q' || quarter(make_date(2000, month, 1))"


@register("quarterly_totals", f"""{_MONTHLY_CTE}
SELECT {_QUARTER} AS quarter,
       CAST(sum(total_revenue) AS DECIMAL(38,4)) AS quarterly_revenue,
       CAST(sum(total_orders) AS BIGINT) AS quarterly_orders
FROM monthly WHERE year = 1998 GROUP BY quarter ORDER BY quarter""")
def quarterly_totals(spark, d):
    return reports.quarterly(_monthly(spark, d), year=1998)


@register("quarterly_latest_year", f"""{_MONTHLY_CTE}
SELECT {_QUARTER} AS quarter,
       CAST(sum(total_revenue) AS DECIMAL(38,4)) AS quarterly_revenue,
       CAST(sum(total_orders) AS BIGINT) AS quarterly_orders
FROM monthly WHERE year = (SELECT max(year) FROM monthly) GROUP BY quarter ORDER BY quarter""")
def quarterly_latest_year(spark, d):
    year, _ = _latest(spark, d)
    orders = marts.orders_in(read_table(spark, d, "orders"), year)
    return reports.quarterly(marts.monthly_kpis(read_table(spark, d, "lineitem"), orders), year=year)


@register("monthly_trend", f"""{_MONTHLY_CTE}
SELECT CAST(month AS DECIMAL(2,0)) AS month, CAST(total_revenue AS DECIMAL(38,0)) AS total_revenue
FROM monthly WHERE year = 1998 ORDER BY month""")
def monthly_trend(spark, d):
    return reports.monthly_trend(_monthly(spark, d), year=1998)


@register("monthly_yoy_long", f"""{_MONTHLY_CTE}
SELECT year, month, strftime(make_date(2000, month, 1), '%b') AS month_name,
       total_revenue, total_orders
FROM monthly ORDER BY year, month""")
def monthly_yoy_long(spark, d):
    return reports.monthly_yoy_long(_monthly(spark, d))


_YEARS = range(1995, 2002)  # the order dates of the given tables


@register("monthly_yoy_pivot", f"""{_MONTHLY_CTE}
SELECT month, strftime(make_date(2000, month, 1), '%b') AS month_name,
       {", ".join(f'sum(total_revenue) FILTER (WHERE year = {y}) AS "{y}"' for y in _YEARS)}
FROM monthly GROUP BY month ORDER BY month""")
def monthly_yoy_pivot(spark, d):
    return reports.monthly_yoy_pivot(_monthly(spark, d), years=list(_YEARS))


_PERF = """
SELECT restaurant_name,
       CAST(sum(total_revenue) AS DECIMAL(38,4)) AS annual_revenue,
       CAST(sum(total_orders) AS BIGINT) AS annual_orders,
       avg(avg_revenue_per_order) AS avg_revenue_per_order,
       count(DISTINCT month) AS active_months
FROM mbr WHERE year = {year}
GROUP BY restaurant_name
ORDER BY annual_revenue DESC NULLS FIRST, restaurant_name
LIMIT 15"""


@register("supplier_performance_top15", _MBR_CTE + _PERF.format(year="(SELECT max(year) FROM mbr)"))
def supplier_performance_top15(spark, d):
    year, _ = _latest(spark, d)
    return reports.restaurant_performance(_mbr_of(spark, d, year), year=year)


@register("top10_of_top15", _MBR_CTE + ", top15 AS (" + _PERF.format(year="(SELECT max(year) FROM mbr)")
          + ") SELECT * FROM top15 ORDER BY annual_revenue DESC NULLS FIRST, restaurant_name LIMIT 10")
def top10_of_top15(spark, d):
    year, _ = _latest(spark, d)
    return reports.top_of(reports.restaurant_performance(_mbr_of(spark, d, year), year=year), 10)


@register("supplier_performance_1998", _MBR_CTE + _PERF.format(year="1998"))
def supplier_performance_1998(spark, d):
    return reports.restaurant_performance(_mbr_of(spark, d, 1998), year=1998)


_TOP_MONTH = """
SELECT restaurant_id, restaurant_name, total_revenue, total_orders, avg_revenue_per_order,
       avg_revenue_per_item, max_order_value
FROM mbr WHERE {where}
ORDER BY total_revenue DESC NULLS FIRST, restaurant_id
LIMIT 10"""


@register("top_suppliers_month", _MBR_CTE + _TOP_MONTH.format(
    where="(year, month) = (SELECT max((year, month)) FROM mbr)"))
def top_suppliers_month(spark, d):
    year, month = _latest(spark, d)
    return reports.top_restaurants(_mbr_of(spark, d, year, month), year=year, month=month)


@register("top_suppliers_1998_06", _MBR_CTE + _TOP_MONTH.format(where="year = 1998 AND month = 6"))
def top_suppliers_1998_06(spark, d):
    return reports.top_restaurants(_mbr_of(spark, d, 1998, 6), year=1998, month=6)


@register("active_months", _MBR_CTE + """
SELECT DISTINCT month FROM mbr WHERE year = (SELECT max(year) FROM mbr) ORDER BY month""")
def active_months(spark, d):
    year, _ = _latest(spark, d)
    return reports.active_months(_mbr_of(spark, d, year), year=year)


@register("latest_period", _MBR_CTE + """
SELECT year, max(month) AS month FROM mbr WHERE year = (SELECT max(year) FROM mbr) GROUP BY year""")
def latest_period(spark, d):
    year, month = _latest(spark, d)
    return reports.latest_period(_mbr_of(spark, d, year, month))



@register("top_suppliers_sql_params", _MBR_CTE + _TOP_MONTH.format(where="year = 1999 AND month = 3"))
def top_suppliers_sql_params(spark, d):
    return reports.top_restaurants_sql(spark, _mbr_of(spark, d, 1999, 3), 1999, 3)


@register("top_suppliers_labeled", _MBR_CTE + """
SELECT restaurant_name AS "Restaurant Name", total_revenue AS "Total Revenue (₹)",
       total_orders AS "Total Orders", avg_revenue_per_order AS "Avg Revenue per Order (₹)",
       avg_revenue_per_item AS "Avg Revenue per Item (₹)", max_order_value AS "Max Order Value (₹)"
FROM mbr WHERE (year, month) = (SELECT max((year, month)) FROM mbr)
ORDER BY total_revenue DESC NULLS FIRST, restaurant_id LIMIT 10""")
def top_suppliers_labeled(spark, d):
    year, month = _latest(spark, d)
    top = reports.top_restaurants(_mbr_of(spark, d, year, month), year=year, month=month).drop("restaurant_id")
    return reports.relabel(top, reports.TOP_LABELS)

# Remaining query groups register themselves on import.
from tierflow.plans import change_queries  # noqa: E402,F401
from tierflow.plans import ingest_queries  # noqa: E402,F401
from tierflow.plans import entity_queries  # noqa: E402,F401
from tierflow.plans import maintenance_queries  # noqa: E402,F401
