"""Dashboard reports over the KPI marts.

Every function takes mart DataFrames and returns a lazy DataFrame. Where
the dashboard picks a default (latest year, latest month of that year),
``year=None`` / ``month=None`` derive it inside the plan with a one-row
aggregate joined on the period key, so no value passes through the driver.

NULL ordering is stated explicitly (the source warehouse sorts NULLs as
largest) and every LIMIT is tie-broken by the restaurant key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.plans.marts import REVENUE_TYPE


# ---------------------------------------------------------------- helpers

def month_name(month: Column) -> Column:
    """1 -> 'Jan' ... 12 -> 'Dec' (English short names)."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMM")


def quarter_label(month: Column) -> Column:
    """Month 1-3 -> 'Q1' ... 10-12 -> 'Q4'; anything else -> NULL."""
    q = F.ceil(month / F.lit(3)).cast("int")
    return F.when(month.between(1, 12), F.concat(F.lit("Q"), q.cast("string")))


def latest_year(yearly: DataFrame) -> DataFrame:
    """One row, column ``year``: the most recent year (the dashboard default)."""
    return yearly.agg(F.max("year").alias("year"))


def latest_period(mart: DataFrame) -> DataFrame:
    """One row (year, month): latest year, then latest month within it.

    A single aggregate: the max of struct(year, month) orders by year first.
    """
    latest = mart.agg(F.max(F.struct("year", "month")).alias("p"))
    return latest.select(F.col("p.year").alias("year"), F.col("p.month").alias("month"))


def _for_year(mart: DataFrame, year: int | None) -> DataFrame:
    if year is not None:
        return mart.filter(F.col("year") == F.lit(year))
    return mart.join(latest_year(mart), "year", "left_semi")


def _for_period(mart: DataFrame, year: int | None, month: int | None) -> DataFrame:
    if year is not None and month is not None:
        return mart.filter((F.col("year") == F.lit(year)) & (F.col("month") == F.lit(month)))
    if year is not None:
        in_year = mart.filter(F.col("year") == F.lit(year))
        last = in_year.agg(F.max("month").alias("month")).withColumn("year", F.lit(year))
        return in_year.join(last, ["year", "month"], "left_semi")
    return mart.join(latest_period(mart), ["year", "month"], "left_semi")


def relabel(df: DataFrame, labels: list[str]) -> DataFrame:
    """Positional relabel of result columns (display names)."""
    return df.toDF(*labels)


# ---------------------------------------------------------------- reports

def yearly(yearly_mart: DataFrame) -> DataFrame:
    """Yearly comparison / KPI list, ordered by year."""
    return yearly_mart.orderBy(F.asc_nulls_last("year"))


def overall(yearly_mart: DataFrame) -> DataFrame:
    """Totals over all years: revenue, orders, largest order."""
    return yearly_mart.agg(
        F.sum("total_revenue").cast(REVENUE_TYPE).alias("total_revenue_all_years"),
        F.sum("total_orders").alias("total_orders_all_years"),
        F.max("max_order_value").alias("max_order_value_overall"),
    )


def yoy(yearly_mart: DataFrame) -> DataFrame:
    """Each year with the change of its five measures against year - 1.

    The prior year is found by key (year - 1), not by position, so a
    missing year gives NULL changes. The yearly mart has one row per
    calendar year, so broadcasting it is bounded by the calendar.
    """
    cols = ("total_revenue", "total_orders", "avg_revenue_per_order",
            "avg_revenue_per_item", "max_order_value")
    prev = yearly_mart.select(
        (F.col("year") + F.lit(1)).alias("year"),
        *[F.col(c).alias(f"prev_{c}") for c in cols],
    )
    joined = yearly_mart.join(F.broadcast(prev), "year", "left")
    diff_names = {
        "total_revenue": "revenue_diff",
        "total_orders": "orders_diff",
        "avg_revenue_per_order": "avg_rev_order_diff",
        "avg_revenue_per_item": "avg_rev_item_diff",
        "max_order_value": "max_order_diff",
    }
    return joined.select(
        "year",
        *cols,
        *[(F.col(c) - F.col(f"prev_{c}")).alias(diff_names[c]) for c in cols],
    ).orderBy(F.asc_nulls_last("year"))


def quarterly(monthly_mart: DataFrame, year: int | None = None) -> DataFrame:
    """Revenue and orders per quarter of one year (default: latest year)."""
    rows = _for_year(monthly_mart, year).withColumn("quarter", quarter_label(F.col("month")))
    return (
        rows.groupBy("quarter")
        .agg(
            F.sum("total_revenue").cast(REVENUE_TYPE).alias("quarterly_revenue"),
            F.sum("total_orders").alias("quarterly_orders"),
        )
        .orderBy(F.asc_nulls_last("quarter"))
    )


def monthly_trend(monthly_mart: DataFrame, year: int | None = None, digits: int = 38) -> DataFrame:
    """Month and revenue of one year, rounded to whole numbers.

    The source rounds to ``number(10)``; ``digits=10`` does that and, as an ANSI
    cast, raises for a monthly revenue of more digits. The default holds any.
    """
    rows = _for_year(monthly_mart, year)
    return rows.select(
        F.col("month").cast("decimal(2,0)").alias("month"),
        F.col("total_revenue").cast(f"decimal({digits},0)").alias("total_revenue"),
    ).orderBy(F.asc_nulls_last("month"))


def monthly_yoy_long(monthly_mart: DataFrame) -> DataFrame:
    """Monthly series of every year with month names, chronological order."""
    return monthly_mart.select(
        "year",
        "month",
        month_name(F.col("month")).alias("month_name"),
        "total_revenue",
        "total_orders",
    ).orderBy(F.asc_nulls_last("year"), F.asc_nulls_last("month"))


def monthly_yoy_pivot(monthly_mart: DataFrame, years: list[int] | None = None) -> DataFrame:
    """One row per month, one revenue column per year.

    Without ``years`` Spark first finds the distinct years (one small job,
    bounded by the calendar); pass them to skip it.
    """
    grouped = monthly_mart.groupBy("month", month_name(F.col("month")).alias("month_name"))
    pivoted = grouped.pivot("year", years) if years else grouped.pivot("year")
    return pivoted.agg(F.sum("total_revenue")).orderBy(F.asc_nulls_last("month"))


def restaurant_performance(mbr_mart: DataFrame, year: int | None = None, n: int = 15) -> DataFrame:
    """Top-n restaurants of a year by revenue.

    ``avg_revenue_per_order`` is the unweighted mean of the monthly means,
    as in the source (a double: its last bit may depend on the order in
    which partial sums are combined).
    """
    rows = _for_year(mbr_mart, year)
    summary = rows.groupBy("restaurant_name").agg(
        F.sum("total_revenue").cast(REVENUE_TYPE).alias("annual_revenue"),
        F.sum("total_orders").alias("annual_orders"),
        F.avg("avg_revenue_per_order").alias("avg_revenue_per_order"),
        F.countDistinct("month").alias("active_months"),
    )
    return summary.orderBy(
        F.desc_nulls_first("annual_revenue"), F.asc_nulls_last("restaurant_name")
    ).limit(n)


def top_of(df: DataFrame, n: int = 10) -> DataFrame:
    """First n rows of an already ordered report (``head(10)``)."""
    return df.limit(n)


def top_restaurants(
    mbr_mart: DataFrame, year: int | None = None, month: int | None = None, n: int = 10
) -> DataFrame:
    """Top-n restaurants of one month (default: latest month of the latest year)."""
    rows = _for_period(mbr_mart, year, month)
    return rows.select(
        "restaurant_id",
        "restaurant_name",
        "total_revenue",
        "total_orders",
        "avg_revenue_per_order",
        "avg_revenue_per_item",
        "max_order_value",
    ).orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("restaurant_id")).limit(n)


def active_months(mbr_mart: DataFrame, year: int | None = None) -> DataFrame:
    """Distinct months with restaurant data in a year, ascending."""
    return _for_year(mbr_mart, year).select("month").distinct().orderBy(F.asc_nulls_last("month"))


# The dashboard's column titles.
TOP_LABELS = ["Restaurant Name", "Total Revenue (₹)", "Total Orders", "Avg Revenue per Order (₹)",
              "Avg Revenue per Item (₹)", "Max Order Value (₹)"]


def top_restaurants_sql(spark, mbr_mart: DataFrame, year: int, month: int, n: int = 10) -> DataFrame:
    """The top-n query as Spark SQL with bound parameters instead of string formatting."""
    mbr_mart.createOrReplaceTempView("tf_monthly_by_restaurant")
    return spark.sql(
        """
        SELECT restaurant_id, restaurant_name, total_revenue, total_orders, avg_revenue_per_order,
               avg_revenue_per_item, max_order_value
        FROM tf_monthly_by_restaurant
        WHERE year = :year AND month = :month
        ORDER BY total_revenue DESC NULLS FIRST, restaurant_id
        LIMIT :n
        """,
        args={"year": year, "month": month, "n": n},
    )
