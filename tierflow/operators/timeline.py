"""Type 2 history by event time: versions are spliced in wherever they belong.

``scd2.apply`` opens versions at the time a batch is applied. Here each row
brings the time from which it holds, and batches may come in any order: a late
row splits the version that was in force at its time. To end at the same
history whatever the order, rows that repeat the value in force are kept too
(``_part='seen'``): what they confirm can later turn out to be a version of its
own. Of rows with the same key and time the greatest counts, so ties do not
depend on the order either. ``_gone`` rows end a version without opening one.

The history is kept by hash buckets of the key (sources/buckets.py). A batch
reads and writes the buckets of its keys, and works only on the keys it brings;
the other rows of those buckets are passed through. Neighbours in time are
found in two steps, inside the parts of a range partitioning by (key, time) and
between the parts, so that a key with very many versions is many tasks' work.

Rows with a NULL in the key or without a time have no place in a history and
are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.functions.keys import hash_key
from tierflow.operators.merge import ACTION, IS_UPDATE, KIND, has_null
from tierflow.session import unique_scratch
from tierflow.sources.buckets import BUCKET, BucketedTable

GONE, PART = "_gone", "_part"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = unique_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, keys, at: str) -> DataFrame:
    """``df`` written in ranges of (key, time), with the number ``__p`` of the range."""
    rows = df.repartitionByRange(*keys, at).withColumn("__p", F.spark_partition_id())
    return _written(rows, "timeline-ranges")


def neighbour(df: DataFrame, keys, at: str, value: Column, name: str, ahead: bool) -> DataFrame:
    """Add ``value`` of the row before (or, ``ahead``, after) in the time of each key.

    ``df`` has the range number ``__p``. Inside a range a window finds it; the
    first row of a key in a range takes it from the key's last row in the range
    before: one row per key and range.
    """
    order = F.desc(at) if ahead else F.asc(at)
    inside = Window.partitionBy(*keys, "__p").orderBy(order)
    rows = df.withColumn("__v", F.struct(value.alias("v"))).withColumn(name, F.lag("__v").over(inside))
    pick = F.min_by("__v", at) if ahead else F.max_by("__v", at)
    edges = rows.groupBy(*keys, "__p").agg(pick.alias("__e"))
    parts = Window.partitionBy(*keys).orderBy(F.desc("__p") if ahead else F.asc("__p"))
    edges = edges.withColumn("__before", F.lag("__e").over(parts)).drop("__e")
    joined = rows.join(edges, [*keys, "__p"])
    return joined.withColumn(name, F.coalesce(name, "__before")).drop("__v", "__before")


class Timeline:
    """The history of keyed rows under one root.

    keys, values   key columns, and columns whose change makes a version
    at             column that says from when a row holds
    """

    def __init__(self, spark: SparkSession, root: str, keys, values, at: str, buckets: int = 16):
        self.table = BucketedTable(spark, root, keys, buckets)
        self.keys, self.values, self.at = list(keys), list(values), at

    def splice(self, batch: DataFrame, consumed: int = 0) -> int:
        """Put a batch of rows (keys, values, time, and ``_gone`` if any were deleted) into the history."""
        table, based_on = self.table, self.table.version()
        cols = [*self.keys, *self.values, self.at, GONE]
        gone = F.coalesce(F.col(GONE), F.lit(False)) if GONE in batch.columns else F.lit(False)
        rows = batch.withColumn(GONE, gone).select(*cols).filter(~has_null([*self.keys, self.at]))
        # A deleted row has no values: what it says is that there are none from now on.
        rows = rows.select(*self.keys, *[F.when(~F.col(GONE), F.col(c)).alias(c) for c in self.values], self.at, GONE)
        bucket = table.bucket(rows.select(*self.keys), self.keys, table.buckets())
        new = _written(rows.withColumn(BUCKET, bucket), "timeline-batch")
        touched = table.touched(new)
        held = table.rows(touched, based_on) if based_on else None
        passed = None
        if held is not None:
            known = new.select(*self.keys).distinct()
            passed = held.drop("v").join(known, self.keys, "left_anti")
            new = new.unionByName(held.join(known, self.keys, "left_semi").select(*cols, BUCKET))
        history = self.versions(new)
        if passed is not None:
            history = history.unionByName(passed.select(*history.columns))
        out = history.withColumns({ACTION: F.lit(None).cast("string"), IS_UPDATE: F.lit(None).cast("boolean"), KIND: F.lit("row")})
        return table.write_buckets(out, touched, consumed=consumed, based_on=based_on)

    def versions(self, seen: DataFrame) -> DataFrame:
        """Versions and confirming rows from all that was seen of some keys."""
        best = F.max(F.struct(GONE, *self.values)).alias("m")
        one = seen.groupBy(*self.keys, self.at, BUCKET).agg(best)
        one = one.select(*self.keys, *[F.col(f"m.{c}").alias(c) for c in [*self.values, GONE]], self.at, BUCKET)
        state = F.struct(GONE, *self.values)
        before = neighbour(ranged(one, self.keys, self.at), self.keys, self.at, state, "__was", ahead=False)
        same = reduce(lambda a, b: a & b, [F.col(f"__was.v.{c}").eqNullSafe(F.col(c)) for c in [GONE, *self.values]])
        nothing = F.col("__was").isNull() & F.col(GONE)
        turns = before.withColumn("__turn", ~(F.coalesce(F.col("__was").isNotNull() & same, F.lit(False)) | nothing)).drop("__was")
        turns = _written(turns, "timeline-turns")
        turning = neighbour(turns.filter("__turn"), self.keys, self.at, F.col(self.at), "__next", ahead=True)
        start, end = F.col(self.at).alias("eff_start"), F.col("__next.v").alias("eff_end")
        kind = F.when(F.col(GONE), "gone").when(F.col("__next").isNull(), "current").otherwise("closed")
        shared = [*self.keys, *self.values, self.at, GONE, BUCKET]
        kept = turning.select(*shared, start, end, kind.alias(PART))
        rest = turns.filter("not __turn").select(*shared, start, F.lit(None).cast(_type(turns, self.at)).alias("eff_end"), F.lit("seen").alias(PART))
        return kept.unionByName(rest)

    def dimension(self, hash_col: str | None = None) -> DataFrame:
        """Versions with their span; the current one of a key has no end."""
        rows = self.table.rows().filter(F.col(PART).isin("current", "closed"))
        out = rows.select(*self.keys, *self.values, "eff_start", "eff_end", (F.col(PART) == "current").alias("is_current"))
        return out.withColumn(hash_col, hash_key([*self.keys, *self.values, "eff_start"])) if hash_col else out

    def as_of(self, moment) -> DataFrame:
        """The rows in force at a moment."""
        when = F.lit(moment).cast("timestamp")
        return self.dimension().filter((F.col("eff_start") <= when) & (F.col("eff_end").isNull() | (F.col("eff_end") > when)))


def _type(df: DataFrame, col: str):
    return df.schema[col].dataType
