"""Plans and publishing of the marts."""

import re

from tierflow.plans import marts, registry
from tierflow.sources.tables import read_table
from tests.conftest import SMOKE


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_latest_period_reports_scan_the_facts_once_with_a_date_range(spark):
    for name in ("top_suppliers_month", "supplier_performance_top15", "top_suppliers_labeled", "active_months"):
        plan = plan_of(registry.QUERIES[name](spark, SMOKE))
        assert len(re.findall(r"l_suppkey#\d+L?,[^\n]*parquet", plan)) == 1, name
        assert re.search(r"o_orderdate#\d+ >= ", plan) and re.search(r"o_orderdate#\d+ < ", plan), name


def test_restaurant_mart_exchanges_the_lines_once(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = marts.monthly_by_restaurant(*(read_table(spark, SMOKE, t) for t in ("lineitem", "orders", "supplier")))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # One exchange by order key for each side of the join; the aggregate by (order, supplier) needs none.
    assert len(re.findall(r"hashpartitioning\(l_orderkey#\d+L?, \d+\)", plan)) == 2
    assert not re.search(r"hashpartitioning\(l_orderkey#\d+L?, l_suppkey", plan)


def test_publish_drops_vanished_years_and_refreshes_one(spark, tmp_dir):
    lines, orders, suppliers = (read_table(spark, SMOKE, t) for t in ("lineitem", "orders", "supplier"))
    root = f"{tmp_dir}/marts"
    marts.publish(lines, orders, suppliers, root)
    whole = {r.year: r.total_orders for r in marts.read_published(spark, root, "yearly").collect()}
    year = sorted(whole)[1]
    marts.publish(lines, orders.filter(f"year(o_orderdate) <> {year}"), suppliers, root)
    assert {r.year for r in marts.read_published(spark, root, "yearly").collect()} == set(whole) - {year}
    marts.publish(lines, orders, suppliers, root, years=[year])
    assert {r.year: r.total_orders for r in marts.read_published(spark, root, "yearly").collect()} == whole


def test_period_bounds(spark):
    df = spark.sql("select explode(sequence(timestamp_ntz'1998-11-15', timestamp_ntz'2000-02-15', interval 1 month)) o_orderdate")
    assert marts.orders_in(df, 1998, 12).count() == 1 and marts.orders_in(df, 1999).count() == 12
    assert marts.orders_in(df, 1998, last=1999).count() == 14


def test_a_task_of_the_marts_takes_a_fixed_number_of_lines(spark, tmp_dir, monkeypatch):
    lines, orders, suppliers = (read_table(spark, SMOKE, t) for t in ("lineitem", "orders", "supplier"))
    monkeypatch.setattr(marts, "ROWS_OF_TASK", 100)
    parts = -(-lines.count() // 100)
    plan = marts.monthly_by_restaurant(lines, orders, suppliers)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(rf"hashpartitioning\(l_orderkey#\d+L?, {parts}\)", plan)) == 2
    seen, plain = [], marts._measures
    monkeypatch.setattr(marts, "_measures", lambda grouped: seen.append(plain(grouped)) or seen[-1])
    marts.publish(lines, orders, suppliers, f"{tmp_dir}/marts")
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in seen]
    assert any(re.search(rf"hashpartitioning\(l_orderkey#\d+L?, {parts}\)", p) for p in plans)
    assert any(re.search(rf"hashpartitioning\(year#\d+, month#\d+, l_suppkey#\d+L?, {parts}\)", p) for p in plans)


def test_orders_of_a_month_are_broadcast_to_the_lines(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")  # the whole table of orders is larger
    try:
        assert "SortMergeJoin" not in physical(registry.QUERIES["top_suppliers_1998_06"](spark, SMOKE))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
