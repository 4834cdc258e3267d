"""Uniqueness over time, feed consumers, tags of derived columns."""

import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierflow.functions import privacy
from tierflow.operators import cdc
from tierflow.operators.consumers import Consumer, trim
from tierflow.operators.unique import KeyFilter, violations
from tierflow.sources.buckets import BucketedTable
from tierflow.sources.tables import CommitConflict
from tests.conftest import rows


# ------------------------------------------------------------------ keys

def test_filter_never_misses_and_seldom_suspects(spark, tmp_dir):
    seen = KeyFilter(spark, f"{tmp_dir}/f", ["a", "b"], bits=1 << 16)
    assert seen.suspects(spark.createDataFrame([(1, "x")], "a long, b string")).count() == 0
    def keys(lo, hi):
        return spark.range(lo, hi).select(F.col("id").alias("a"), (F.col("id") % 3).cast("string").alias("b"))

    seen.add(keys(0, 2000))
    seen.add(keys(2000, 4000))
    assert KeyFilter(spark, f"{tmp_dir}/f", ["a", "b"]).bits == 1 << 16
    asked = keys(3000, 9000).unionByName(spark.createDataFrame([(None, "1"), (5, None)], "a long, b string"))
    found = {r.a for r in seen.suspects(asked).collect()}
    assert found >= set(range(3000, 4000)) and len(found) < 1000 + 5000 / 20


def test_violations_are_exact_and_read_few_buckets(spark, tmp_dir, monkeypatch):
    table = BucketedTable(spark, f"{tmp_dir}/t", ["k"], 32)
    table.upsert(spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("x")))
    seen = KeyFilter(spark, f"{tmp_dir}/f", ["k"], bits=1 << 18)
    seen.add(table.rows())
    read = []
    real = table.rows
    monkeypatch.setattr(table, "rows", lambda buckets=None, version=None: read.append(buckets) or real(buckets, version))
    batch = spark.createDataFrame([(k, 0) for k in [*range(1000, 1400), 17, 17, 18, 1500, 1500, None, None]], "k long, x int")
    assert sorted(rows(violations(batch, table, seen))) == [(17, "exists"), (17, "repeats"), (18, "exists"), (1500, "repeats")]
    assert len(read[0]) < 8


def test_first_batch_has_nothing_to_compare_with(spark, tmp_dir):
    table, seen = BucketedTable(spark, f"{tmp_dir}/t", ["k"], 4), KeyFilter(spark, f"{tmp_dir}/f", ["k"])
    batch = spark.createDataFrame([(1,), (2,), (2,)], "k long")
    assert rows(violations(batch, table, seen)) == [(2, "repeats")]


# ------------------------------------------------------------------ consumers

def test_consumers_at_different_paces_get_the_same_net_changes(spark, tmp_dir):
    rnd = random.Random(4)
    table = BucketedTable(spark, f"{tmp_dir}/t", ["k"], 4)
    fast, slow = (Consumer(table, f"{tmp_dir}/c", n) for n in ("fast", "slow"))
    state, taken = {}, []
    for n in range(1, 5):
        table.upsert(spark.createDataFrame([(k, rnd.randint(1, 3)) for k in rnd.sample(range(30), 12)], "k long, x int"), track=["x"])
        state = dict(rows(table.rows(), "k", "x"))
        changes, upto = fast.pending()
        taken.append(cdc.with_batch(spark.createDataFrame(changes.collect(), changes.schema), n))
        fast.advance(upto)
        gone = trim(table, [fast, slow])
        # What the slow consumer has not read stays; replaced buckets go.
        assert not any("_kind=feed" in g for g in gone)
    assert dict(rows(table.rows(), "k", "x")) == state
    both = taken[0]
    for more in taken[1:]:
        both = both.unionByName(more)
    late, upto = slow.pending()
    assert sorted(map(tuple, cdc.net_changes(both, ["k"]).collect())) == sorted(map(tuple, late.collect()))
    slow.advance(upto)
    assert slow.pending()[0] is None
    assert sum("_kind=feed" in g for g in trim(table, [fast, slow])) == 4
    assert dict(rows(table.rows(), "k", "x")) == state and not os.path.exists(f"{table.path(2)}/_kind=feed")
    table.upsert(spark.createDataFrame([(99, 1)], "k long, x int"), track=["x"])
    assert rows(slow.pending()[0], "k") == [(99,)]


def test_one_consumer_cannot_be_moved_on_twice(spark, tmp_dir):
    table = BucketedTable(spark, f"{tmp_dir}/t", ["k"], 2)
    table.upsert(spark.createDataFrame([(1, 1)], "k long, x int"))
    one, two = Consumer(table, f"{tmp_dir}/c", "same"), Consumer(table, f"{tmp_dir}/c", "same")
    stale = two.offsets.version()
    one.advance(1)
    two.advance(1)  # already there: nothing to do
    assert two.offset() == 1
    with pytest.raises(CommitConflict):
        two.offsets.write(spark.range(1), consumed=1, based_on=stale)


# ------------------------------------------------------------------ lineage

@pytest.fixture()
def people(spark):
    df = spark.createDataFrame([(1, "Ann", "a@x", 5.0), (2, "Bob", "b@y", 7.0)], "id int, name string, email string, pay double")
    return privacy.tag(df, {"name": "PII", "email": "EMAIL", "pay": "PRICE"})


def tags(df):
    return {c: sorted(t) for c, t in privacy.lineage_tags(df).items() if t}


def test_tags_follow_expressions(people):
    out = people.select("id", F.upper("name").alias("u"), F.concat("name", "email").alias("both"), (F.col("pay") * 2).alias("twice"), F.lit(1).alias("one"),
                        F.col("email").alias("mail"))
    assert tags(out) == {"u": ["PII"], "both": ["EMAIL", "PII"], "twice": ["PRICE"], "mail": ["EMAIL"]}
    masked = privacy.mask_derived(out, unmasked=("u",))
    assert rows(masked, "u", "both", "twice", "mail") == [("ANN", "** PII **", 10.0, "** EAMIL **"), ("BOB", "** PII **", 14.0, "** EAMIL **")]


def test_tags_follow_joins_unions_aggregates_windows_and_generators(spark, people):
    other = spark.createDataFrame([(1, "x")], "key int, note string")
    joined = people.join(other, people.id == other.key, "left").filter("name <> 'q'").orderBy("pay")
    grouped = joined.groupBy("note").agg(F.max("email").alias("m"), F.count("*").alias("n"), F.collect_list("name").alias("names"))
    assert tags(grouped) == {"m": ["EMAIL"], "names": ["PII"]}
    assert tags(grouped.select("n", F.explode("names").alias("e"))) == {"e": ["PII"]}
    ranked = people.withColumn("before", F.lag("name").over(Window.orderBy("id"))).withColumn("rank", F.row_number().over(Window.orderBy("id")))
    assert tags(ranked)["before"] == ["PII"] and "rank" not in tags(ranked)
    plain = spark.createDataFrame([("z", 3)], "s string, id int")
    union = plain.select("s", "id").unionByName(people.select(F.col("name").alias("s"), "id"))
    assert tags(union) == {"s": ["PII"]}


def test_tags_follow_views_ctes_files_and_python(spark, people, tmp_dir):
    people.createOrReplaceTempView("people_of_test")
    out = spark.sql("WITH a AS (SELECT id, lower(email) AS e FROM people_of_test), b AS (SELECT e || '!' AS f, id FROM a) SELECT f, id FROM b UNION ALL SELECT 'x', 0")
    assert tags(out) == {"f": ["EMAIL"]}
    people.write.parquet(f"{tmp_dir}/p")
    back = spark.read.parquet(f"{tmp_dir}/p").select(F.substring("name", 1, 1).alias("initial"), "id")
    assert tags(back) == {"initial": ["PII"]}

    def same(batches):
        yield from batches

    assert set(tags(people.select("id", "name").mapInPandas(same, "id int, who string"))) == {"id", "who"}
