"""A persisted listing of a landing folder, refreshed by difference.

The listing is a table kept by buckets of the prefix (a folder directly under
the landing folder). A refresh asks the file system for the prefixes and their
modification times, one call, and lists only prefixes that are new or changed;
Spark lists many of them as a job. Rows of the other prefixes stay as they are,
rows of vanished ones go. The marker of each version holds the prefixes' times,
so a refresh without changes writes nothing.

A folder's time changes when files are added to it or removed, not when one is
overwritten in place on some file systems, nor with what happens in folders
below it: ``refresh(full=True)`` lists everything again. Files directly in the
landing folder are part of the one call and always up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.operators.merge import ACTION, IS_UPDATE, KIND
from tierflow.session import unique_scratch
from tierflow.sources import ingest
from tierflow.sources.buckets import BUCKET, BucketedTable
from tierflow.sources.tables import _fs

COLS = ["prefix", "path", "length", "modification_time", "file_key"]


class Directory:
    def __init__(self, spark: SparkSession, folder: str, root: str, buckets: int = 16):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.table = BucketedTable(spark, root, ["prefix"], buckets)

    def prefixes(self) -> tuple[dict[str, int], list[str]]:
        """Folders directly under the landing folder with their time, and the files there."""
        fs, path, _ = _fs(self.spark, self.folder)
        times, files = {}, []
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if status.isDirectory():
                times[name] = status.getModificationTime()
            else:
                files.append(name)
        return times, files

    def refresh(self, full: bool = False) -> list[str]:
        """Bring the listing up to date; the prefixes that were listed for it."""
        times, top = self.prefixes()
        based_on, before = self.table.version(), self.table.marker().get("prefixes", {})
        changed = sorted(n for n in times if full or times[n] != before.get(n))
        gone = sorted(n for n in before if n not in times)
        had_top = bool(self.table.marker().get("top"))
        if based_on and not changed and not gone and not top and not had_top:
            return []
        # The times are those from before the listing: what changes during it is listed again.
        names = self.table.placed(self.spark.createDataFrame([(n,) for n in [*changed, *gone, ""]], "prefix string"))
        touched = self.table.touched(names)
        rows = self.fresh(changed, top)
        if based_on:
            kept = self.table.rows(touched, based_on).drop("v").join(names.select(F.col("prefix").alias("__p")), F.col("prefix") == F.col("__p"), "left_anti")
            rows = rows.unionByName(kept)
        rows = rows.withColumns({ACTION: F.lit(None).cast("string"), IS_UPDATE: F.lit(None).cast("boolean"), KIND: F.lit("row")})
        self.table.write_buckets(rows, touched, based_on=based_on, prefixes=times, top=len(top))
        return changed

    def fresh(self, changed: list[str], top: list[str]) -> DataFrame:
        """Listed files of changed prefixes, with the bucket of their prefix."""
        paths = [*(f"{self.folder}/{n}" for n in changed), *(f"{self.folder}/{n}" for n in top)]
        if paths:
            rows = ingest.list_files(self.spark, paths)
            # The part of the path below the folder, whose place in it is the same in every path.
            _, root, _ = _fs(self.spark, self.folder)
            below = F.expr(f"substring(path, {len(root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toString()) + 2})")
            prefix = F.when(F.instr(below, "/") > 0, F.substring_index(below, "/", 1)).otherwise(F.lit(""))
            rows = rows.withColumn("prefix", prefix).select(*COLS)
        else:
            rows = self.spark.createDataFrame([], "prefix string, path string, length long, modification_time timestamp_ntz, file_key string")
        path = unique_scratch(self.spark, "directory")
        placed = rows.withColumn(BUCKET, self.table.bucket(rows.select("prefix"), ["prefix"], self.table.buckets()))
        placed.write.parquet(path)
        return self.spark.read.schema(placed.schema).parquet(path)

    def files(self) -> DataFrame | None:
        """The listing: path, length, modification_time, file_key, as ``ingest.list_files`` gives it."""
        rows = self.table.rows()
        return None if rows is None else rows.select(*COLS[1:])
