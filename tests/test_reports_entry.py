from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tierflow.plans import reports
from tests.conftest import SMOKE, rows

YEARLY = "year int, total_revenue decimal(38,4), total_orders long, avg_revenue_per_order double, " \
         "avg_revenue_per_item double, max_order_value decimal(38,4)"


def test_yoy_missing_year_gives_null(spark):
    y = spark.createDataFrame([(1996, Decimal("10"), 2, 5.0, 1.0, Decimal("6")),
                               (1998, Decimal("30"), 3, 10.0, 2.0, Decimal("20")),
                               (1999, Decimal("40"), 4, 10.0, 4.0, Decimal("25"))], YEARLY)
    got = {r.year: r for r in reports.yoy(y).collect()}
    assert got[1998].revenue_diff is None and got[1996].orders_diff is None
    assert got[1999].revenue_diff == Decimal("10") and got[1999].orders_diff == 1


def test_quarter_and_month_names(spark):
    df = spark.range(1, 13).selectExpr("cast(id as int) as m")
    out = df.select(reports.quarter_label(df.m).alias("q"), reports.month_name(df.m).alias("n")).collect()
    assert [r.q for r in out] == ["Q1"] * 3 + ["Q2"] * 3 + ["Q3"] * 3 + ["Q4"] * 3
    assert [r.n for r in out][:3] == ["Jan", "Feb", "Mar"] and out[11].n == "Dec"


def test_top_n_breaks_ties_by_key_and_defaults_to_latest_period(spark):
    mbr = spark.createDataFrame(
        [(2000, 1, i, f"R{i}", Decimal("5"), 1, 5.0, 5.0, Decimal("5")) for i in range(12)]
        + [(2000, 2, 1, "R1", Decimal("7"), 1, 7.0, 7.0, Decimal("7"))],
        "year int, month int, restaurant_id long, restaurant_name string, total_revenue decimal(38,4), "
        "total_orders long, avg_revenue_per_order double, avg_revenue_per_item double, "
        "max_order_value decimal(38,4)")
    top = reports.top_restaurants(mbr, 2000, 1, n=10).collect()
    assert [r.restaurant_id for r in top] == list(range(10))
    latest = reports.top_restaurants(mbr).collect()
    assert [(r.restaurant_id, r.total_revenue) for r in latest] == [(1, Decimal("7"))]
    assert rows(reports.latest_period(mbr)) == [(2000, 2)]
    assert rows(reports.active_months(mbr, 2000)) == [(1,), (2,)]


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "revenue_diff" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert all(x == "pipeline" or x.startswith("op") and x[2].isdigit() for x in set(q) - set(o))


FAST = ["kpi_yearly", "kpi_monthly_by_supplier", "yoy_delta", "supplier_performance_top15",
        "top_suppliers_month", "conform_location", "upsert_conditional", "net_changes",
        "scd2_reference", "hash_key_sha1"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_at_smoke_scale(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    sdf = entry_mod.queries()[name](spark, SMOKE)
    cur = con.execute(entry_mod.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)

    def canon(cols, data):
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        norm = [tuple(float(f"{r[i]:.9g}") if isinstance(r[i], float) else r[i] for i in idx) for r in data]
        return sorted(norm, key=repr)

    assert canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == canon(dcols, cur.fetchall())


def test_published_marts_prune_and_refresh_by_year(spark, tmp_dir):
    from pyspark.sql import functions as F
    from tierflow.plans import marts
    from tierflow.sources.tables import read_table
    li, o, s = (read_table(spark, SMOKE, t) for t in ("lineitem", "orders", "supplier"))
    root = f"{tmp_dir}/marts"
    marts.publish(li, o, s, root)
    pub = marts.read_published(spark, root, "monthly_by_restaurant")
    assert rows(pub.select(*marts.monthly_by_restaurant(li, o, s).columns)) == \
        rows(marts.monthly_by_restaurant(li, o, s))
    # year filter prunes partitions of the published mart
    plan = pub.filter(F.col("year") == 1998)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan
    # refresh one year from changed input: only its partition is replaced
    before = {r.year: r.total_revenue for r in marts.read_published(spark, root, "yearly").collect()}
    marts.publish(li.filter(F.col("l_linenumber") <= 2), o, s, root, years=[1998])
    after = {r.year: r.total_revenue for r in marts.read_published(spark, root, "yearly").collect()}
    assert set(after) == set(before)
    assert after[1998] < before[1998]
    assert all(after[y] == before[y] for y in before if y != 1998)
