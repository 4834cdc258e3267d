"""Touched-bucket tables, commits, numbering."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tierflow.functions import keys as K
from tierflow.operators import merge
from tierflow.sources.buckets import BUCKET, BucketedTable
from tierflow.sources.tables import CommitConflict, SnapshotTable
from tests.conftest import rows


def by_tens(df, keys, n):
    """Ten keys a bucket."""
    return F.pmod((F.col(keys[0]) / 10).cast("int"), F.lit(n)).cast("int")


def table(spark, tmp_dir, n=100, buckets=10, bucket=by_tens):
    t = BucketedTable(spark, f"{tmp_dir}/t", ["k"], buckets, bucket)
    t.upsert(spark.range(n).select(F.col("id").alias("k"), F.lit("old").alias("v1")))
    return t


def files(tmp_dir, version):
    return sorted(re.findall(r"_bucket=(\d+)", " ".join(p for p, _, names in os.walk(f"{tmp_dir}/t/v={version:08d}/_kind=row") if names)))


def test_delta_reads_and_writes_its_buckets_only(spark, tmp_dir):
    t = table(spark, tmp_dir)
    delta = spark.createDataFrame([(42, "new"), (47, "new"), (141, "new")], "k long, v1 string")
    t.upsert(delta)
    assert files(tmp_dir, 2) == ["4"]
    read = t.rows(t.touched(t.placed(delta)), 1)
    assert {int(re.search(r"_bucket=(\d+)", f)[1]) for f in read.inputFiles()} == {4}
    assert t.where() == {b: 2 if b == 4 else 1 for b in range(10)}
    want = {k: "new" if k in (42, 47, 141) else "old" for k in [*range(100), 141]}
    assert dict(rows(t.rows(), "k", "v1")) == want
    # The version before is still there, and the feed holds the change.
    assert t.rows(version=1).count() == 100
    feed = t.read_versions(2, 2).filter(f"{merge.KIND} = 'feed'")
    assert sorted(rows(feed, "k", "v1", merge.ACTION)) == [(42, "new", "INSERT"), (42, "old", "DELETE"), (47, "new", "INSERT"), (47, "old", "DELETE"), (141, "new", "INSERT")]


def test_scan_of_touched_buckets_is_pruned(spark, tmp_dir):
    t = table(spark, tmp_dir)
    plan = t.rows([3, 7])._jdf.queryExecution().executedPlan().toString()
    whole = t.rows()
    assert len(t.rows([3, 7]).inputFiles()) < len(whole.inputFiles())
    assert "parquet" in plan.lower()


def test_null_keys_spread_and_stay(spark, tmp_dir):
    t = BucketedTable(spark, f"{tmp_dir}/t", ["k"], 8)
    data = [(None, f"r{i}") for i in range(40)] + [(1, "a")]
    t.upsert(spark.createDataFrame(data, "k long, v1 string"))
    assert len(t.where()) > 3
    t.upsert(spark.createDataFrame([(1, "b"), (None, "r0")], "k long, v1 string"))
    got = rows(t.rows(), "k", "v1")
    assert len(got) == 42 and (1, "b") in got and got.count((None, "r0")) == 2


def test_surrogates_continue_over_batches(spark, tmp_dir):
    t = BucketedTable(spark, f"{tmp_dir}/t", ["k"], 4)
    for n in (50, 80):
        t.upsert(spark.range(n).repartition(7).select(F.col("id").alias("k"), F.lit(n).alias("v1")), surrogate="sk")
    out = t.rows()
    assert out.count() == 80 and out.select("sk").distinct().count() == 80
    assert t.marker()["max_key"] == 130 and out.filter("k < 50").agg(F.max("sk")).first()[0] == 50


def test_rebucket_keeps_rows(spark, tmp_dir):
    t = table(spark, tmp_dir, bucket=by_tens)
    t.rebucket(3)
    assert t.buckets() == 3 and set(t.where()) == {0, 1, 2}
    t.upsert(spark.createDataFrame([(5, "new")], "k long, v1 string"))
    assert dict(rows(t.rows(), "k", "v1")) == {k: "new" if k == 5 else "old" for k in range(100)}


def test_second_writer_of_a_version_is_refused(spark, tmp_dir):
    t = table(spark, tmp_dir)
    base = t.version()
    mine = t.placed(spark.createDataFrame([(1, "mine")], "k long, v1 string"))
    rows_of = merge.merge_rows(t.rows([0], base).drop("v"), mine, ["k"])
    t.upsert(spark.createDataFrame([(2, "theirs")], "k long, v1 string"))
    before = sorted(rows(t.rows(), "k", "v1"))
    with pytest.raises(CommitConflict):
        t.write_buckets(rows_of, [0], based_on=base)
    assert t.version() == 2 and sorted(rows(t.rows(), "k", "v1")) == before


def test_snapshot_conflict_and_failed_draft(spark, tmp_dir):
    t = SnapshotTable(spark, f"{tmp_dir}/s")
    t.write(spark.range(3), consumed=1)
    t.write(spark.range(4), consumed=2, based_on=1)
    with pytest.raises(CommitConflict):
        t.write(spark.range(9), consumed=9, based_on=1)
    os.makedirs(f"{tmp_dir}/s/_draft-dead")
    assert t.version() == 2 and t.consumed() == 2 and t.read().count() == 4


def test_numbering_is_dense_stable_and_without_a_window_over_rows(spark):
    df = spark.range(1000).repartition(9).withColumn("x", F.col("id") % 3)
    out = K.assign_surrogate(df, "sk", base=10)
    first = sorted(rows(out, "id", "sk"))
    assert sorted(r[1] for r in first) == list(range(11, 1011)) and sorted(rows(out, "id", "sk")) == first
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == 1 and "__part" in plan.split("Window ")[1].split("\n")[0]


def test_rows_older_than_the_target_change_nothing(spark):
    t = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "a", None), (4, "a", 5)], "k long, v string, at int")
    s = spark.createDataFrame([(1, "b", 4), (2, "b", 5), (3, "b", 1), (4, "b", None), (5, "b", None)], "k long, v string, at int")
    for strategy in ("shuffle", "auto"):
        out = merge.upsert(t, s, ["k"], not_older="at", strategy=strategy)
        assert sorted(rows(out.table, "k", "v")) == [(1, "a"), (2, "b"), (3, "b"), (4, "a"), (5, "b")]
        assert sorted(rows(out.feed.filter(f"{merge.ACTION} = 'INSERT'"), "k")) == [(2,), (3,), (5,)]


def test_bucket_column_is_not_in_the_way(spark, tmp_dir):
    t = table(spark, tmp_dir)
    assert BUCKET in t.rows().columns and merge.KIND not in t.rows().columns
