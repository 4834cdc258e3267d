"""Uniqueness of a key kept over time, without regrouping the table.

``KeyFilter`` is a Bloom filter of all keys seen so far, as a table of bitmaps:
a key sets ``hashes`` bits out of ``bits``, and each slot of 32,768 bits is one
row, made and merged by Spark's bitmap aggregates. It is kept by buckets
(sources/buckets.py), so a batch reads and rewrites the slots its keys fall
into. A key that misses one of its bits is new. What is left, the keys of the
table and a small share of others, is confirmed exactly against the table's own
buckets of those keys, so the verdict has no error.

Keys that hold a NULL are no keys and never repeat. The filter is sized for the
rows to come: with 10 bits a key and 4 hashes about one new key in eighty is
looked up in vain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators import merge
from tierflow.operators.merge import ACTION, IS_UPDATE, KIND
from tierflow.session import unique_scratch
from tierflow.sources.buckets import BUCKET, BucketedTable

#: Bits of one bitmap of Spark's bitmap functions.
SLOT_BITS = 32_768


def _written(df: DataFrame, name: str) -> DataFrame:
    path = unique_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class KeyFilter:
    def __init__(self, spark: SparkSession, root: str, keys, bits: int = 1 << 24, hashes: int = 4, buckets: int = 4):
        """``bits`` and ``hashes`` count for a new filter; one that exists keeps its own."""
        self.table = BucketedTable(spark, root, ["slot"], buckets)
        self.keys = list(keys)
        marker = self.table.marker()
        self.bits, self.hashes = marker.get("bits", bits), marker.get("hashes", hashes)

    def positions(self, keys: DataFrame) -> DataFrame:
        """One row for each bit of each key: slot, and bit in the slot."""
        at = F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(i), *self.keys), F.lit(self.bits)) for i in range(self.hashes)]))
        place = keys.select(*self.keys, at.alias("at"))
        return place.select(*self.keys, F.floor(F.col("at") / SLOT_BITS).alias("slot"), (F.col("at") % SLOT_BITS).alias("bit"))

    def add(self, batch: DataFrame, consumed: int = 0) -> int:
        """Set the bits of a batch's keys."""
        based_on = self.table.version()
        keys = batch.select(*self.keys).filter(~merge.has_null(self.keys))
        new = self.positions(keys).groupBy("slot").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
        new = _written(self.table.placed(new), "filter-bits")
        touched = self.table.touched(new)
        rows = new
        if based_on:
            rows = rows.unionByName(self.table.rows(touched, based_on).drop("v"))
        rows = rows.groupBy("slot", BUCKET).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        rows = rows.withColumns({ACTION: F.lit(None).cast("string"), IS_UPDATE: F.lit(None).cast("boolean"), KIND: F.lit("row")})
        return self.table.write_buckets(rows, touched, consumed=consumed, based_on=based_on, bits=self.bits, hashes=self.hashes)

    def suspects(self, batch: DataFrame) -> DataFrame:
        """Distinct keys of a batch all of whose bits are set: those seen before, and a few others."""
        keys = batch.select(*self.keys).filter(~merge.has_null(self.keys)).distinct()
        head = self.table.version()
        if not head:
            return keys.limit(0)
        asked = _written(self.table.placed(self.positions(keys)), "filter-asked")
        held = self.table.rows(self.table.touched(asked), head).select(F.col("slot").alias("__s"), "bitmap")
        byte = F.expr("conv(hex(substring(bitmap, int(bit div 8) + 1, 1)), 16, 10)").cast("int")
        is_set = F.expr("shiftright(__byte, int(bit % 8)) & 1") == 1
        told = asked.join(held, F.col("slot") == F.col("__s"), "left").withColumn("__byte", byte)
        return told.groupBy(*self.keys).agg(F.bool_and(F.coalesce(is_set, F.lit(False))).alias("__all")).filter("__all").drop("__all")


def violations(batch: DataFrame, existing: BucketedTable, keys_seen: KeyFilter) -> DataFrame:
    """(keys, reason): keys that repeat in the batch (``repeats``) or are in the table (``exists``).

    Only the table's buckets that suspects fall into are read, and of those the
    key columns.
    """
    keys = keys_seen.keys
    twice = merge.duplicate_keys(batch.filter(~merge.has_null(keys)), keys).select(*keys, F.lit("repeats").alias("reason"))
    maybe = keys_seen.suspects(batch)
    maybe = _written(existing.placed(maybe), "suspects")
    held = existing.rows(existing.touched(maybe))
    if held is None:
        return twice
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col("__t_" + k) for k in keys])
    found = maybe.select(*keys).join(held.select(*[F.col(k).alias("__t_" + k) for k in keys]), same, "left_semi")
    return twice.unionByName(found.withColumn("reason", F.lit("exists")))
