"""Snapshot tables kept by hash bucket of the key, of which a batch rewrites only some.

Rows lie under ``v=<version>/_kind=row/_bucket=<b>``. A version holds the buckets
that its batch touched; the marker of each version says for every bucket which
version holds it (a map as long as the fixed number of buckets), so the current
table is read from exactly those folders. An upsert reads the buckets that the
delta's keys fall into, joins only them and writes only them; what a batch costs
follows the buckets it touches, not the table. Feed rows of a batch lie beside
them under ``_kind=feed``, as in any snapshot table.

The bucket is a hash of the key; a row with a NULL in its key, which never
matches, goes by the hash of the whole row, so such rows spread as well. A row
keeps the bucket it was inserted into.

Take so many buckets that one is a task's work (half a gigabyte or so; the
default is for small tables); ``rebucket`` rewrites the table once with another number when it has outgrown it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tierflow.functions.keys import ROW_ID, numbered, with_row_id
from tierflow.operators import merge
from tierflow.operators.merge import KIND
from tierflow.session import unique_scratch
from tierflow.sources.tables import SnapshotTable, _fs, path_exists

BUCKET = "_bucket"
BUCKETS = 4


def key_bucket(df: DataFrame, keys, n: int) -> Column:
    """Bucket 0 … n-1 of each row of ``df``."""
    keys = list(keys)
    value = F.when(merge.has_null(keys), F.xxhash64(*df.columns)).otherwise(F.xxhash64(*keys))
    return F.pmod(value, F.lit(n)).cast("int")


def partition_bucket(df: DataFrame, keys, n: int) -> Column:
    """Bucket 0 … n-1 by the hash that ``repartition`` deals rows by.

    Of ``repartition(n * k, *keys)`` each partition holds rows of one bucket only,
    so rows that a job has dealt by key are written as they are.
    """
    return F.pmod(F.hash(*keys), F.lit(n)).cast("int")


class BucketedTable(SnapshotTable):
    def __init__(self, spark: SparkSession, root: str, keys, buckets: int = BUCKETS, bucket=key_bucket, options: dict | None = None):
        """``buckets`` counts for a new table; one that exists keeps the number it has."""
        super().__init__(spark, root, partition_by=[KIND, BUCKET], options=options)
        self.keys = list(keys)
        self.bucket = bucket
        self._new = buckets

    def buckets(self) -> int:
        return int(self.marker().get("buckets", self._new))

    def where(self, version: int | None = None) -> dict[int, int]:
        """The version that holds each bucket."""
        return {int(b): v for b, v in self.marker(version).get("where", {}).items()}

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with the bucket of each row."""
        return df.withColumn(BUCKET, self.bucket(df, self.keys, self.buckets()))

    def touched(self, delta: DataFrame) -> list[int]:
        """Buckets that a placed delta falls into (at most their fixed number)."""
        return sorted(r[BUCKET] for r in delta.select(BUCKET).distinct().collect())

    def rows(self, buckets: list[int] | None = None, version: int | None = None) -> DataFrame | None:
        """Rows of these buckets (default: all) as of a version, with ``v`` and their bucket."""
        head = self.version() if version is None else version
        if not head:
            return None
        marker = self.marker(head)
        where = {int(b): v for b, v in marker["where"].items() if buckets is None or int(b) in set(buckets)}
        written = StructType.fromJson(json.loads(marker["schema"]))
        fields = [f for f in written.fields if f.name not in (KIND, BUCKET)]
        data = StructType([*fields, StructField("v", IntegerType()), StructField(KIND, StringType()), StructField(BUCKET, IntegerType())])
        if not where:
            return self.spark.createDataFrame([], data).drop(KIND, *merge.FEED_COLS)
        paths = [f"{self.path(v)}/{KIND}=row/{BUCKET}={b}" for b, v in sorted(where.items())]
        return self.spark.read.schema(data).option("basePath", self.root).parquet(*paths).drop(KIND, *merge.FEED_COLS)

    def write_buckets(self, rows: DataFrame, touched: list[int], *, consumed: int = 0, based_on: int | None = None,
                      buckets: int | None = None, dealt: bool = False, more: Sequence[DataFrame] = (), **notes) -> int:
        """Commit placed rows and feed (``_kind``) as all that the touched buckets hold from now on.

        ``dealt``: partitions of ``rows`` hold few buckets each and are written as they are.
        ``more``: rows of further buckets of the same commit, written one frame after the other.
        """
        base = self.version() if based_on is None else based_on
        n, before = buckets or self.buckets(), self.where(base) if base else {}
        if not dealt:
            rows, more = rows.repartition(KIND, BUCKET), [r.repartition(KIND, BUCKET) for r in more]

        def said(draft: str, version: int) -> dict:
            after = {b: v for b, v in before.items() if b not in set(touched)}
            return {"buckets": n, "by": self.bucket.__name__, "where": after | {b: version for b in _listed(self.spark, f"{draft}/{KIND}=row")}} | notes

        return self._commit(rows, consumed, base, said, more)

    def upsert(self, delta: DataFrame, *, consumed: int = 0, empty: DataFrame | None = None, check=None, finish=None,
               **options) -> int:
        """Merge a delta into the buckets it touches (options: ``merge.merge_rows``); the new version.

        The delta is written once: its buckets, the join and new surrogate keys
        all read that. ``empty`` has the columns of a table that does not exist
        yet (default: those of the delta). ``check`` gets the touched rows and the
        delta before the merge, ``finish`` the merged rows before they are written.
        """
        based_on, before = self.version(), self.marker()
        placed = with_row_id(self.placed(delta))
        path = unique_scratch(self.spark, "delta")
        placed.write.parquet(path)
        delta = self.spark.read.schema(placed.schema).parquet(path)
        counts = {r[BUCKET]: r["n"] for r in delta.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}
        touched = sorted(counts)
        surrogate, notes = options.get("surrogate"), {}
        if surrogate:
            top = int(before.get("max_key", 0))
            delta = numbered(delta, merge.NEW_KEY, top)
            notes["max_key"] = top + sum(counts.values())
        else:
            delta = delta.drop(ROW_ID)
        if based_on:
            target = self.rows(touched, based_on).drop("v")
            target = target if empty is None else target.select(*empty.columns, BUCKET)
        else:
            target = (delta.drop(BUCKET, merge.NEW_KEY) if empty is None else empty).limit(0).withColumn(BUCKET, F.lit(None).cast("int"))
            if surrogate and surrogate not in target.columns:
                target = target.withColumn(surrogate, F.lit(None).cast("bigint"))
        if check:
            check(target, delta)
        if options.get("insert_cols") is not None:
            options["insert_cols"] = [*options["insert_cols"], BUCKET]
        if options.get("update_cols") is None:
            options["update_cols"] = [c for c in target.columns if c in delta.columns and c not in (*self.keys, BUCKET)]
        rows = merge.merge_rows(target, delta, self.keys, **options)
        rows = finish(rows) if finish else rows
        return self.write_buckets(rows, touched, consumed=consumed, based_on=based_on, **notes)

    def rebucket(self, n: int) -> int:
        """Rewrite the whole table into ``n`` buckets (no feed: nothing changed)."""
        base = self.version()
        marker = self.marker(base)
        rows = self.rows(version=base).drop("v", BUCKET)
        none = [F.lit(None).cast(t).alias(c) for c, t in zip(merge.FEED_COLS, ("string", "boolean"))]
        schema = StructType.fromJson(json.loads(marker["schema"]))
        placed = rows.withColumn(BUCKET, self.bucket(rows, self.keys, n)).withColumn(KIND, F.lit("row")).select("*", *none)
        ordered = placed.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema.fields])
        notes = {"max_key": marker["max_key"]} if "max_key" in marker else {}
        return self.write_buckets(ordered, list(self.where(base)), consumed=marker["consumed"], based_on=base, buckets=n, **notes)


def _listed(spark: SparkSession, folder: str) -> list[int]:
    """Buckets that a written folder holds."""
    if not path_exists(spark, folder):
        return []
    fs, path, _ = _fs(spark, folder)
    names = (status.getPath().getName() for status in fs.listStatus(path))
    return sorted(int(name.split("=")[1]) for name in names if name.startswith(f"{BUCKET}="))
