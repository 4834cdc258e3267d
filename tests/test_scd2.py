"""SCD2 semantics in both modes."""

from pyspark.sql import functions as F

from tierflow.operators import cdc, merge, scd2

SCHEMA = "k long, a string, b string, batch long"
VALUES = ["k", "a", "b"]
T = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-04 00:00:00"]


def _run(spark, batches, mode, match_cols=None, on_delete="ignore"):
    """Apply a sequence of source batches: clean upsert, then dimension."""
    table = spark.createDataFrame([], SCHEMA)
    dim = None
    for i, data in enumerate(batches):
        src = spark.createDataFrame(data, SCHEMA)
        r = merge.upsert(table, src, ["k"])
        table = r.table.checkpoint()
        feed = cdc.with_batch(r.feed.select(*VALUES, merge.ACTION, merge.IS_UPDATE), i + 1)
        if dim is None:
            dim = scd2.empty_dim(feed, VALUES, "hk")
        dim = scd2.apply(dim, feed, keys=["k"], value_cols=VALUES, hash_cols=VALUES, hash_col="hk",
                         as_of=T[i], mode=mode, match_cols=match_cols, on_delete=on_delete).checkpoint()
    return dim


def _current(dim, k):
    return dim.filter((F.col("k") == k) & F.col("is_current")).count()


def test_null_attribute(spark):
    b = [[(1, "x", None, 1)], [(1, "y", None, 2)]]
    ref = _run(spark, b, "reference")
    sound = _run(spark, b, "sound")
    assert _current(ref, 1) == 2          # old NULL version never matched, stays current
    assert _current(sound, 1) == 1
    assert sound.filter("k = 1").count() == 2


def test_revert_a_b_a(spark):
    b = [[(1, "A", "p", 1)], [(1, "B", "p", 2)], [(1, "A", "p", 3)]]
    ref = _run(spark, b, "reference")
    sound = _run(spark, b, "sound")
    assert _current(ref, 1) == 0          # new A matched the closed A: nothing inserted
    assert _current(sound, 1) == 1
    assert sound.filter("k = 1").count() == 3
    assert sound.filter("k = 1 AND is_current").first().a == "A"


def test_revert_gets_new_hash_key_in_sound_mode(spark):
    b = [[(1, "A", "p", 1)], [(1, "B", "p", 2)], [(1, "A", "p", 3)]]
    sound = _run(spark, b, "sound")
    assert sound.select("hk").distinct().count() == 3


def test_noop_replay(spark):
    b = [[(1, "A", "p", 1)], [(1, "A", "p", 2)]]
    ref = _run(spark, b, "reference")
    sound = _run(spark, b, "sound")
    assert _current(ref, 1) == 0          # DELETE closes, INSERT matches the closed row
    assert _current(sound, 1) == 1 and sound.count() == 1


def test_partial_match_location_trap(spark):
    # match on (k, b) only: a change of `a` with `b` unchanged closes and never reopens
    b = [[(1, "zip1", "Yes", 1)], [(1, "zip2", "Yes", 2)]]
    ref = _run(spark, b, "reference", match_cols=["k", "b"])
    assert _current(ref, 1) == 0
    b2 = [[(1, "zip1", "Yes", 1)], [(1, "zip1", "No", 2)]]
    ref2 = _run(spark, b2, "reference", match_cols=["k", "b"])
    assert _current(ref2, 1) == 1 and ref2.filter("k = 1 AND is_current").first().b == "No"


def test_pure_delete_ignored_or_expired(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k long, a string, b string")
    new = old.filter("k = 1")
    feed = cdc.diff_snapshots(old, new, ["k"])
    init = merge.upsert(old.limit(0), old, ["k"]).feed
    kw = dict(keys=["k"], value_cols=VALUES, hash_cols=VALUES, hash_col="hk", mode="sound")
    dim = scd2.apply(scd2.empty_dim(init, VALUES, "hk"), init, as_of=T[0], **kw).checkpoint()
    ignored = scd2.apply(dim, feed, as_of=T[1], on_delete="ignore", **kw)
    expired = scd2.apply(dim, feed, as_of=T[1], on_delete="expire", **kw)
    assert _current(ignored, 2) == 1
    assert _current(expired, 2) == 0 and expired.filter("k = 2").first().eff_end is not None
    ref = scd2.apply(dim, feed, as_of=T[1], **dict(kw, mode="reference"))
    assert _current(ref, 2) == 1


def test_sound_invariants_on_a_sequence(spark):
    b = [
        [(k, f"a{k}", None if k % 2 else "p", 1) for k in range(20)],
        [(k, f"b{k}", "q", 2) for k in range(0, 20, 3)] + [(k, f"a{k}", None if k % 2 else "p", 2)
                                                            for k in range(1, 20, 3)],
        [(k, f"a{k}", None if k % 2 else "p", 3) for k in range(0, 20, 3)] + [(25, "new", None, 3)],
    ]
    dim = _run(spark, b, "sound")
    per_key = dim.groupBy("k").agg(F.sum(F.col("is_current").cast("int")).alias("c")).collect()
    assert all(r.c == 1 for r in per_key)
    assert {r.k for r in per_key} == set(range(20)) | {25}
    # intervals of a key do not overlap: end of one version = start of the next
    w = dim.filter("NOT is_current").alias("x").join(
        dim.alias("y"), (F.col("x.k") == F.col("y.k")) & (F.col("y.eff_start") == F.col("x.eff_end")))
    assert w.count() == dim.filter("NOT is_current").count()
