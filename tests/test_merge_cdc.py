import pytest
from pyspark.sql import functions as F

from tierflow.operators import cdc, merge
from tests.conftest import rows

COLS = ["k", "a", "b", "batch"]


def _frames(spark):
    target = spark.createDataFrame([(1, "x", None, 1), (2, "y", "p", 1), (3, "z", "q", 1)],
                                   "k long, a string, b string, batch long")
    source = spark.createDataFrame([(2, "y", "p", 2), (3, "z", "Q", 2), (4, "w", None, 2),
                                    (1, "x", "now", 2)],
                                   "k long, a string, b string, batch long")
    return target, source


def test_unconditional_upsert_and_feed(spark):
    t, s = _frames(spark)
    r = merge.upsert(t, s, ["k"])
    assert rows(r.table) == [(1, "x", "now", 2), (2, "y", "p", 2), (3, "z", "Q", 2), (4, "w", None, 2)]
    feed = rows(r.feed, "k", merge.ACTION, merge.IS_UPDATE)
    assert feed.count((4, "INSERT", False)) == 1
    assert feed.count((2, "DELETE", True)) == 1 and feed.count((2, "INSERT", True)) == 1  # replay pair
    assert len(feed) == 7


def test_conditional_upsert_null_safe_vs_reference(spark):
    t, s = _frames(spark)
    sound = merge.upsert(t, s, ["k"], track=["a", "b"], null_safe=True)
    ref = merge.upsert(t, s, ["k"], track=["a", "b"], null_safe=False)
    # key 1: NULL -> 'now' is a change only when compared NULL-safe
    assert rows(sound.table.filter("k = 1"), "b") == [("now",)]
    assert rows(ref.table.filter("k = 1"), "b") == [(None,)]
    # key 2 is an unchanged replay: no update, keeps batch 1
    assert rows(sound.table.filter("k = 2"), "batch") == [(1,)]
    assert rows(merge.changed_keys(t, s, ["k"], ["a", "b"], null_safe=True)) == [(1,), (3,)]
    assert rows(merge.changed_keys(t, s, ["k"], ["a", "b"], null_safe=False)) == [(3,)]


def test_partial_update_and_overrides(spark):
    t, s = _frames(spark)
    r = merge.upsert(t, s, ["k"], update_cols=["b"], set_on_update={"batch": F.lit(99)},
                     set_on_insert={"batch": F.lit(7)})
    got = {x.k: (x.a, x.b, x.batch) for x in r.table.collect()}
    assert got[3] == ("z", "Q", 99) and got[4] == ("w", None, 7)


def test_broadcast_strategy_equals_shuffle(spark):
    t, s = _frames(spark)
    a = merge.upsert(t, s, ["k"], strategy="shuffle")
    b = merge.upsert(t, s, ["k"], strategy="broadcast")
    c = merge.upsert(t, s, ["k"], strategy="auto")
    assert rows(a.table) == rows(b.table) == rows(c.table)
    assert rows(a.feed) == rows(b.feed)


def test_null_key_never_matches(spark):
    t = spark.createDataFrame([(None, "x")], "k long, a string")
    s = spark.createDataFrame([(None, "y")], "k long, a string")
    assert len(rows(merge.upsert(t, s, ["k"]).table)) == 2


def test_surrogate_keys_unique_above_existing(spark):
    t = spark.createDataFrame([(10, 1, "x")], "sk long, k long, a string")
    s = spark.range(2, 500).select(F.col("id").alias("k"), F.lit("n").alias("a")).repartition(4)
    out = merge.upsert(t, s, ["k"], surrogate="sk").table
    agg = out.agg(F.countDistinct("sk").alias("d"), F.count(F.lit(1)).alias("n"),
                  F.min(F.when(F.col("k") != 1, F.col("sk"))).alias("m")).first()
    assert agg.d == agg.n == 499 and agg.m > 10


def test_duplicates_error_and_latest(spark):
    t, _ = _frames(spark)
    s = spark.createDataFrame([(5, "a", None, 1), (5, "b", None, 2)], "k long, a string, b string, batch long")
    with pytest.raises(merge.DuplicateKeyError):
        merge.upsert(t, s, ["k"], on_duplicate="error")
    r = merge.upsert(t, s, ["k"], on_duplicate="latest", order_cols=["batch"])
    assert rows(r.table.filter("k = 5"), "a") == [("b",)]


def test_feed_applied_to_old_gives_new(spark):
    old, s = _frames(spark)
    new = merge.upsert(old, s, ["k"]).table
    feed = cdc.diff_snapshots(old, new, ["k"])
    # apply: drop keys with a DELETE image, add INSERT images
    gone = feed.filter(F.col(merge.ACTION) == "DELETE").select("k")
    rebuilt = old.join(gone, "k", "left_anti").unionByName(
        feed.filter(F.col(merge.ACTION) == "INSERT").select(*old.columns))
    assert rows(rebuilt) == rows(new)


def test_net_changes_equals_diff_of_endpoints(spark):
    t, s = _frames(spark)
    r2 = merge.upsert(t, s, ["k"])
    s3 = spark.createDataFrame([(3, "z", "q", 1), (4, "w2", None, 3)], "k long, a string, b string, batch long")
    r3 = merge.upsert(r2.table, s3, ["k"])
    feed = cdc.with_batch(r2.feed, 2).unionByName(cdc.with_batch(r3.feed, 3))
    net = cdc.net_changes(feed, ["k"])
    diff = cdc.diff_snapshots(t, r3.table, ["k"])
    assert rows(net) == rows(diff)
    # key 3 went z/q -> z/Q -> z/q with batch 1 again: no net change
    assert rows(net.filter("k = 3")) == []


def test_appended_since_and_peek(spark):
    ev = spark.createDataFrame([(i, i % 3) for i in range(9)], "id long, _batch_id long")
    assert len(rows(cdc.appended_since(ev, 1))) == 3
    fe = spark.createDataFrame([("INSERT", False), ("INSERT", False), ("DELETE", True)],
                               f"{merge.ACTION} string, {merge.IS_UPDATE} boolean")
    assert rows(cdc.peek_counts(fe)) == [("DELETE", True, 1), ("INSERT", False, 2)]
