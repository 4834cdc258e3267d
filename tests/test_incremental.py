"""Marts folded from feeds; histories by event time."""

import itertools
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tierflow.operators.merge import ACTION, IS_UPDATE
from tierflow.operators.timeline import GONE, PART, Timeline
from tierflow.plans import incremental, marts
from tierflow.plans.incremental import MartStore
from tierflow.session import FREE_SHUFFLES, scratch_dir
from tierflow.sources.buckets import BucketedTable, key_bucket, partition_bucket
from tierflow.sources.tables import SnapshotTable
from tests.conftest import rows

LINE = "l_orderkey long, l_suppkey long, l_extendedprice double, l_discount double"
ORDER = "o_orderkey long, o_orderdate timestamp"


def feed(spark, data, schema):
    return spark.createDataFrame(data, f"{schema}, {ACTION} string, {IS_UPDATE} boolean")


class Facts:
    """Facts kept as plain lists, with the feeds of each change."""

    def __init__(self, spark):
        import datetime as dt

        self.spark, self.lines, self.orders = spark, {}, {}
        self.day = lambda n: dt.datetime(1995, 1, 1) + dt.timedelta(days=n)

    def batch(self, rnd, new=0, change=0, drop=0, move=0):
        lf, of = [], []
        for _ in range(new):
            o = len(self.orders) + 1000 * rnd.randint(0, 99)
            if o in self.orders:
                continue
            self.orders[o] = rnd.randint(0, 800)
            of.append((o, self.day(self.orders[o]), "INSERT", False))
            for n in range(rnd.randint(0, 4)):
                self.lines[o, n] = (o, rnd.randint(1, 4), float(rnd.randint(1, 900)), 0.25)
                lf.append((*self.lines[o, n], "INSERT", False))
        for key in rnd.sample(sorted(self.lines), min(change, len(self.lines))):
            old = self.lines[key]
            self.lines[key] = (old[0], rnd.randint(1, 4), float(rnd.randint(1, 900)), 0.5)
            lf += [(*old, "DELETE", True), (*self.lines[key], "INSERT", True)]
        fresh = {r[0] for r in of}  # a feed holds one change of a key
        for o in rnd.sample(sorted(set(self.orders) - fresh), min(move, len(self.orders))):
            was = self.orders[o]
            self.orders[o] = rnd.randint(0, 800)
            of += [(o, self.day(was), "DELETE", True), (o, self.day(self.orders[o]), "INSERT", True)]
        moved = {r[0] for r in of}
        # Largest orders go first: their groups lose their maximum.
        for o in [o for o in sorted(self.orders, key=lambda o: -sum(v[2] for k, v in self.lines.items() if k[0] == o)) if o not in moved][:drop]:
            of.append((o, self.day(self.orders.pop(o)), "DELETE", False))
            changed = {k: [r for r in lf if r[:4] == v and r[4] == "INSERT"] for k, v in self.lines.items() if k[0] == o}
            for k in changed:
                lf.append((*self.lines.pop(k), "DELETE", False))
        return feed(self.spark, lf, LINE), feed(self.spark, of, ORDER)

    def tables(self):
        return (self.spark.createDataFrame(list(self.lines.values()), LINE),
                self.spark.createDataFrame([(o, self.day(n)) for o, n in self.orders.items()], ORDER))


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.select(*a.columns).collect()), key=repr)


def test_marts_after_many_feeds_equal_the_full_build(spark, tmp_dir):
    facts, store, rnd = Facts(spark), MartStore(spark, tmp_dir, 4, 4), random.Random(3)
    names = spark.createDataFrame([(i, f"s{i}") for i in range(1, 5)], "s_suppkey long, s_name string")
    recomputed = 0
    for n, kind in enumerate([{"new": 120}, {"new": 10, "change": 30}, {"drop": 12}, {"move": 20, "change": 5, "drop": 4}], 1):
        store.apply(*facts.batch(rnd, **kind), n)
        recomputed += store.marts["monthly"].marker()["recomputed"]
    lines, orders = facts.tables()
    same(store.monthly(), marts.monthly_kpis(lines, orders))
    same(store.yearly(), marts.yearly_kpis(lines, orders))
    same(store.monthly_by_restaurant(names), marts.monthly_by_restaurant(lines, orders, names))
    assert recomputed > 0


def test_lagging_mart_takes_all_it_missed_and_replays_do_nothing(spark, tmp_dir, monkeypatch):
    facts, store, rnd = Facts(spark), MartStore(spark, tmp_dir, 4, 4), random.Random(5)
    first, second, third = facts.batch(rnd, new=60), facts.batch(rnd, change=20, drop=5), facts.batch(rnd, move=10, new=5)
    store.apply(*first, 1)
    monkeypatch.setattr(MartStore, "fold_mart", lambda self, name: (_ for _ in ()).throw(OSError("lost")))
    for n, batch in ((2, second), (3, third)):
        with pytest.raises(OSError):
            store.apply(*batch, n)
    monkeypatch.undo()
    store.apply(*third, 3)
    store.apply(*second, 2)
    lines, orders = facts.tables()
    same(store.monthly(), marts.monthly_kpis(lines, orders))
    assert store.totals.version() == 3 and store.fold_mart("monthly") is None


def test_lines_before_their_order_and_an_order_that_empties(spark, tmp_dir):
    store = MartStore(spark, tmp_dir, 2, 2)
    facts = Facts(spark)
    none = feed(spark, [], ORDER)
    store.apply(feed(spark, [(1, 1, 100.0, 0.0, "INSERT", False)], LINE), none, 1)
    assert store.monthly().count() == 0
    store.apply(feed(spark, [], LINE), feed(spark, [(1, facts.day(3), "INSERT", False)], ORDER), 2)
    assert rows(store.monthly(), "year", "month", "total_orders") == [(1995, 1, 1)]
    store.apply(feed(spark, [(1, 1, 100.0, 0.0, "DELETE", False)], LINE), none, 3)
    assert store.monthly().count() == 0 and store.yearly().count() == 0


# ------------------------------------------------------------------ timeline

ROW = f"k long, val string, w int, at timestamp, {GONE} boolean"


def history(events):
    """Versions from the definition: all events of a key in time order."""
    out, per = [], {}
    for k, v, w, at, gone in events:
        if k is None or at is None:
            continue
        state = (gone, None if gone else v, None if gone else w)
        best = per.setdefault(k, {})
        rank = lambda s: (s[0], s[1] is not None, s[1] or "", s[2] is not None, s[2] or 0)
        if at not in best or rank(state) > rank(best[at]):
            best[at] = state
    for k, seen in per.items():
        turns, was = [], (True, None, None)
        for at in sorted(seen):
            if seen[at] != was:
                turns.append((at, seen[at]))
                was = seen[at]
        for (at, state), nxt in itertools.zip_longest(turns, turns[1:]):
            if not state[0]:
                out.append((k, state[1], state[2], at, nxt[0] if nxt else None, nxt is None))
    return sorted(out, key=repr)


def events(n, seed, keys=6):
    import datetime as dt

    rnd = random.Random(seed)
    return [(rnd.choice([*range(keys), None]), rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]),
             None if rnd.random() < 0.03 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 60)), rnd.random() < 0.1) for _ in range(n)]


def spliced(spark, root, batches):
    line = Timeline(spark, root, ["k"], ["val", "w"], "at", buckets=4)
    for n, batch in enumerate(batches, 1):
        line.splice(spark.createDataFrame(batch, ROW), consumed=n)
    return line


def test_any_arrival_order_gives_one_history(spark, tmp_dir):
    data = events(90, 1)
    want = history(data)
    parts = [data[:40], data[40:70], data[70:]]
    for i, order in enumerate([(0, 1, 2), (2, 0, 1), (1, 2, 0)]):
        line = spliced(spark, f"{tmp_dir}/{i}", [parts[j] for j in order])
        assert sorted(map(tuple, line.dimension().collect()), key=repr) == want


def test_confirmed_value_becomes_a_version_when_a_late_row_splits_it(spark, tmp_dir):
    import datetime as dt

    day = lambda n: dt.datetime(2024, 1, n)
    line = spliced(spark, tmp_dir, [[(1, "a", 1, day(1), False)], [(1, "a", 1, day(5), False)]])
    assert rows(line.dimension(), "val", "eff_start", "eff_end") == [("a", day(1), None)]
    line.splice(spark.createDataFrame([(1, "b", 1, day(3), False)], ROW))
    assert rows(line.dimension(), "val", "eff_start", "eff_end") == [("a", day(1), day(3)), ("a", day(5), None), ("b", day(3), day(5))]
    assert rows(line.as_of(day(4)), "val") == [("b",)]
    line.splice(spark.createDataFrame([(1, None, None, day(6), True)], ROW))
    assert line.dimension().filter("is_current").count() == 0 and rows(line.as_of(day(5)), "val") == [("a",)]


def test_hot_key_over_many_ranges_and_untouched_keys(spark, tmp_dir):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    hot = [(7, "ab"[i // 3 % 2], 1, base + dt.timedelta(minutes=i), False) for i in range(600)]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 23)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        line = spliced(spark, tmp_dir, [hot[::2] + [(8, "x", 1, base, False)], hot[1::2]])
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, line.dimension().collect()), key=repr) == history(hot + [(8, "x", 1, base, False)])
    # Rows that only confirm what is in force are kept, but are no versions.
    assert line.table.rows().filter(F.col(PART) == "seen").count() == 400


def test_a_fold_deals_rows_by_order_once(spark, tmp_dir, monkeypatch):
    plans, plain = [], BucketedTable.write_buckets
    monkeypatch.setattr(BucketedTable, "write_buckets", lambda self, rows, *a, **k: plans.append(
        rows._jdf.queryExecution().executedPlan().toString()) or plain(self, rows, *a, **k))
    facts, store, rnd = Facts(spark), MartStore(spark, tmp_dir, 4, 4), random.Random(7)
    for n, kind in enumerate([{"new": 20}, {"change": 5, "move": 3}], 1):
        lines, orders = facts.batch(rnd, **kind)
        store.fold_totals(lines, orders, n)
    assert [p.count("hashpartitioning(l_orderkey") for p in plans] == [1, 1]


# ------------------------------------------------------------------ disk of the marts

def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in blocks.mkString("\n").splitlines() if name.startswith("shuffle_")}


def names_under(root):
    return {os.path.relpath(base, root) for base, _, files in os.walk(root) if any(f.endswith(".parquet") for f in files)}


def test_a_fold_leaves_no_shuffle_files_and_no_intermediate_tables(spark, tmp_dir):
    facts, store, rnd = Facts(spark), MartStore(spark, tmp_dir, 4, 4), random.Random(11)
    batches = [facts.batch(rnd, **kind) for kind in ({"new": 60}, {"change": 15, "drop": 3})]
    scratch, files = set(os.listdir(scratch_dir(spark))), shuffle_files(spark)
    for n, batch in enumerate(batches, 1):
        store.apply(*batch, n)
    for _ in range(50):  # files go in the background
        left = shuffle_files(spark) - files
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert set(os.listdir(scratch_dir(spark))) == scratch
    assert spark.conf.get(FREE_SHUFFLES) == "false"


def test_totals_keep_only_what_is_still_read(spark, tmp_dir, monkeypatch):
    facts, store, rnd = Facts(spark), MartStore(spark, tmp_dir, 4, 4), random.Random(12)
    store.apply(*facts.batch(rnd, new=60), 1)
    plain = MartStore.fold_mart
    monkeypatch.setattr(MartStore, "fold_mart", lambda self, name: plain(self, name) if name == "monthly" else (_ for _ in ()).throw(OSError("lost")))
    for n, kind in ((2, {"change": 20}), (3, {"drop": 5, "new": 5})):
        with pytest.raises(OSError):
            store.apply(*facts.batch(rnd, **kind), n)
    # One mart has not taken the feeds of versions 2 and 3.
    assert {"v=00000002/_kind=feed", "v=00000003/_kind=feed"} <= {n.rsplit("/", 1)[0] for n in names_under(f"{tmp_dir}/totals")}
    monkeypatch.undo()
    store.apply(*facts.batch(rnd, move=4), 4)
    held = {f"v={v:08d}/_kind=row/_bucket={b}" for b, v in store.totals.where().items()}
    assert names_under(f"{tmp_dir}/totals") == held
    lines, orders = facts.tables()
    names = spark.createDataFrame([(i, f"s{i}") for i in range(1, 5)], "s_suppkey long, s_name string")
    same(store.monthly(), marts.monthly_kpis(lines, orders))
    same(store.monthly_by_restaurant(names), marts.monthly_by_restaurant(lines, orders, names))


def test_a_fold_in_rounds_and_in_one_give_the_same(spark, tmp_dir, monkeypatch):
    written, plain = [], SnapshotTable._commit
    monkeypatch.setattr(SnapshotTable, "_commit", lambda self, df, consumed, based_on, notes, more=(): written.append(
        (self.root.rsplit("/", 1)[1], 1 + len(more))) or plain(self, df, consumed, based_on, notes, more))
    by_months, months = MartStore._by_months, []
    monkeypatch.setattr(MartStore, "_by_months", lambda self, df, rounds, make, written, name: months.append((name, rounds)) or by_months(self, df, rounds, make, written, name))
    kinds, found = [{"new": 50}, {"new": 5, "change": 20, "drop": 6}, {}], []
    for size, root in ((incremental.ROWS_OF_ROUND, "one"), (40, "many")):
        monkeypatch.setattr(incremental, "ROWS_OF_ROUND", size)
        facts, store, rnd = Facts(spark), MartStore(spark, f"{tmp_dir}/{root}", 4, 4), random.Random(13)
        for n, kind in enumerate(kinds, 1):
            store.apply(*facts.batch(rnd, **kind), n)
        found.append(store)
    lines, orders = facts.tables()
    names = spark.createDataFrame([(i, f"s{i}") for i in range(1, 5)], "s_suppkey long, s_name string")
    for store in found:
        same(store.monthly(), marts.monthly_kpis(lines, orders))
        same(store.monthly_by_restaurant(names), marts.monthly_by_restaurant(lines, orders, names))
    assert max(k for name, k in months if name == "mart-delta") > 1 < max(k for name, k in months if name == "mart-tops")
    same(found[0].totals.rows().drop("v"), found[1].totals.rows().drop("v"))
    rounds = [k for name, k in written if name == "totals"]
    assert rounds[:3] == [1] * 3 and max(rounds[3:]) > 1


def test_rows_dealt_by_order_are_written_as_they_are(spark, tmp_dir):
    keys = spark.range(5000).select((F.col("id") - 2500).alias("k")).unionByName(spark.sql("select cast(null as bigint) k"))
    dealt = keys.withColumn("b", partition_bucket(keys, ["k"], 6)).repartition(18, "k").withColumn("p", F.spark_partition_id())
    assert dealt.groupBy("p").agg(F.countDistinct("b").alias("n")).filter("n > 1").isEmpty()
    facts, store, rnd = Facts(spark), MartStore(spark, tmp_dir, 16, 4), random.Random(14)
    store.fold_totals(*facts.batch(rnd, new=300), 1)
    files = [f for _, _, names in os.walk(f"{tmp_dir}/totals") for f in names if f.endswith(".parquet")]
    assert len(files) == 32  # one for the rows and one for the feed of each bucket


@pytest.mark.parametrize("buckets", [4, 400])
def test_a_store_dealt_by_the_former_hash_goes_on(spark, tmp_dir, buckets):
    facts, store, rnd = Facts(spark), MartStore(spark, tmp_dir, buckets, 4), random.Random(15)
    store.totals.bucket = key_bucket
    store.apply(*facts.batch(rnd, new=40), 1)
    marker = f"{tmp_dir}/totals/v=00000001/_COMMITTED"
    with open(marker) as f:
        content = json.load(f)
    del content["by"]  # as it was written then
    os.remove(f"{os.path.dirname(marker)}/._COMMITTED.crc")
    with open(marker, "w") as f:
        json.dump(content, f)
    for n, kind in enumerate([{"change": 10, "new": 3}, {"drop": 3}], 2):
        store = MartStore(spark, tmp_dir, buckets, 4)
        assert store.totals.bucket is key_bucket
        store.apply(*facts.batch(rnd, **kind), n)
    lines, orders = facts.tables()
    same(store.monthly(), marts.monthly_kpis(lines, orders))
    fresh = MartStore(spark, f"{tmp_dir}/new", buckets, 4)
    fresh.apply(*[df.selectExpr("*", f"'INSERT' {ACTION}", f"false {IS_UPDATE}") for df in (lines, orders)], 1)
    assert MartStore(spark, f"{tmp_dir}/new").totals.bucket is partition_bucket
    same(fresh.monthly(), store.monthly())
