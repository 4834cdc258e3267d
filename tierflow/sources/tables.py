"""Reading the driver's tables and keeping versioned table snapshots.

A snapshot table is a folder with one sub-folder per version
(``v=00000001`` ...). A version is written into a draft folder of its own, with
a small JSON marker that also says which input it consumed, and then put in
place by one rename that fails where the version exists. Data and consumer
offset are therefore one atomic step: a job that fails before it leaves a draft
that nobody reads, and of two writers that start from the same version one gets
a ``CommitConflict`` and has changed nothing. The folder has to be on a file
system with an atomic rename (HDFS, a local or shared disk), not on a bare
object store. A job that reads version n can safely write n+1 (Spark cannot
overwrite a path it is reading from).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

COMMITTED = "_COMMITTED"
VERSION = "v"


class CommitConflict(RuntimeError):
    """Another writer has committed the version that this one was to become."""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables, e.g. ``read_table(spark, d, 'orders')``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath, jvm


def head_version(spark: SparkSession, root: str) -> int:
    """The latest committed version under ``root`` (0 if none).

    One listing of the folder; markers are looked for from the top, so no more
    than the attempts that failed since the last commit are probed.
    """
    fs, hroot, jvm = _fs(spark, root)
    if not fs.exists(hroot):
        return 0
    names = (status.getPath().getName() for status in fs.listStatus(hroot))
    for v in sorted((int(n[2:]) for n in names if n.startswith("v=")), reverse=True):
        if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/v={v:08d}/{COMMITTED}")):
            return v
    return 0


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath, _ = _fs(spark, path)
    return bool(fs.exists(hpath))


def _write_marker(spark: SparkSession, folder: str, content: dict) -> None:
    fs, path, _ = _fs(spark, f"{folder}/{COMMITTED}")
    out = fs.create(path, False)
    try:
        out.write(bytearray(json.dumps(content), "utf-8"))
    finally:
        out.close()


def _publish(spark: SparkSession, draft: str, folder: str) -> None:
    """Put a finished draft in its place, unless something is there already."""
    _, source, jvm = _fs(spark, draft)
    target = jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), conf).rename(source, target, options)
    except Py4JJavaError as error:
        if not path_exists(spark, folder):
            raise
        raise CommitConflict(f"{folder} was committed by another writer") from error
    if path_exists(spark, draft) or not path_exists(spark, f"{folder}/{COMMITTED}"):
        raise RuntimeError(f"{draft} could not be put in place as {folder}")


def _read_marker(spark: SparkSession, folder: str) -> dict:
    fs, path, jvm = _fs(spark, f"{folder}/{COMMITTED}")
    source = fs.open(path)
    try:
        size = fs.getFileStatus(path).getLen()
        return json.loads(bytes(source.readNBytes(size)).decode("utf-8"))
    finally:
        source.close()


class SnapshotTable:
    """A table stored as immutable parquet versions under one root folder."""

    def __init__(self, spark: SparkSession, root: str, partition_by: list[str] | None = None, options: dict | None = None):
        """``options`` of the Parquet writer."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = partition_by or []
        self.options = options or {}

    def version(self) -> int:
        return head_version(self.spark, self.root)

    def exists(self) -> bool:
        return self.version() > 0

    def path(self, version: int | None = None) -> str:
        v = self.version() if version is None else version
        return f"{self.root}/v={v:08d}"

    def marker(self, version: int | None = None) -> dict:
        """What was written with a version (empty if there is none)."""
        v = self.version() if version is None else version
        return _read_marker(self.spark, self.path(v)) if v else {}

    def consumed(self) -> int:
        """What the latest version had consumed of its input (0 if there is none)."""
        return int(self.marker().get("consumed", 0))

    def read(self, version: int | None = None) -> DataFrame:
        v = self.version() if version is None else version
        return self.read_versions(v, v).drop("v")

    def read_versions(self, first: int, last: int) -> DataFrame:
        """Rows of the versions first..last, with their number ``v``.

        The schema is the written one, so a version (or a partition of it)
        without rows reads as an empty frame.
        """
        schema = StructType.fromJson(json.loads(_read_marker(self.spark, self.path(last))["schema"]))
        paths = [self.path(last)] if first == last else [self.root]
        rows = (self.spark.read.schema(schema.add(StructField("v", IntegerType())))
                .option("basePath", self.root).parquet(*paths))
        return rows.filter(F.col("v").between(first, last))

    def write(self, df: DataFrame, consumed: int = 0, based_on: int | None = None) -> int:
        """Write ``df`` as the next version and return its number.

        ``based_on`` is the version the rows were computed from: if another one
        has been committed since, the write is refused.
        """
        return self._commit(df, consumed, based_on, lambda draft, version: {})

    def _commit(self, df: DataFrame, consumed: int, based_on: int | None, notes, more: Sequence[DataFrame] = ()) -> int:
        """``more``: frames of the same version, each written when the one before it is."""
        if VERSION in df.columns:
            raise ValueError(f"a column of a snapshot table cannot be named {VERSION!r}: that is its version")
        version = (self.version() if based_on is None else based_on) + 1
        draft = f"{self.root}/_draft-{uuid.uuid4().hex[:12]}"
        for frame in (df, *more):
            writer = frame.write.mode("append").options(**self.options)
            if self.partition_by:
                writer = writer.partitionBy(*self.partition_by)
            writer.parquet(draft)
        nullable = StructType([StructField(f.name, f.dataType, True, f.metadata) for f in df.schema.fields])
        content = {"consumed": int(consumed), "schema": nullable.json()} | notes(draft, version)
        _write_marker(self.spark, draft, content)
        _publish(self.spark, draft, self.path(version))
        return version
