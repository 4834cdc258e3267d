"""Per-entity batch runner: stage -> clean -> dimension.

Storage layout under one root (a shared folder on a cluster):

  stage/<entity>/_batch_id=<n>/              append-only text rows + audit columns
  clean/<entity>/v=<n>/_kind=row|feed/_bucket=<b>/
                                             buckets of the clean table that batch n touched, and its change feed
  consumption/<dim>/reference/v=<n>/         reference mode: whole dimension
  consumption/<dim>/sound/v=<n>/_part=...    sound mode: current versions, and those closed by n
  quarantine/<entity>/_batch_id=<n>/         rows that failed a rule
  quarantine/<entity>_load/_batch_id=<n>/    rows that could not be parsed
  common/load_ledger                         files loaded (see sources/ledger.py)

Each step writes its output in one Spark job. What a step has consumed is part
of the commit marker of the version it wrote (sources/tables.py), so data and
offset appear together: a step that fails anywhere is repeated from the same
inputs into the same version number, and a step without new input does nothing.
Dimensions net all feeds they have not seen before applying them once.

A clean table is kept by hash buckets of its key (sources/buckets.py): a batch
reads and rewrites only the buckets it touches. Feeds and old versions of
``reference`` dimensions are not read again once consumed; versions of a
``sound`` dimension hold its history and are kept.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tierflow.functions import privacy, quality
from tierflow.functions.keys import assign_surrogate
from tierflow.operators import merge, scd2
from tierflow.operators.cdc import BATCH, net_changes
from tierflow.plans.entities import AUDIT_COLS, Entity
from tierflow.session import unique_scratch
from tierflow.sources import ingest
from tierflow.sources.buckets import BUCKET, BUCKETS, BucketedTable
from tierflow.sources.ledger import Ledger
from tierflow.sources.tables import SnapshotTable, path_exists


def _now():
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        """``buckets``: hash buckets of a clean table that does not exist yet."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.ledger = Ledger(spark, f"{self.root}/common")

    def stage_path(self, e: Entity) -> str:
        return f"{self.root}/stage/{e.name}"

    def clean_table(self, e: Entity) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.root}/clean/{e.name}", e.keys, self.buckets)

    def dim_table(self, e: Entity, mode: str = "sound") -> SnapshotTable:
        partition_by = [scd2.PART] if mode == "sound" else None
        return SnapshotTable(self.spark, f"{self.root}/consumption/{e.dim_name}/{mode}", partition_by)

    # ------------------------------------------------------------ reads
    def stage(self, e: Entity, after: int = 0) -> DataFrame | None:
        """Committed stage rows of batches after ``after`` (append-only stream read)."""
        if not path_exists(self.spark, self.stage_path(e)):
            return None
        batches = self.ledger.committed_batches(e.name).select(F.col("batch_id").alias("__committed"))
        rows = self.spark.read.schema(stage_schema(e)).parquet(self.stage_path(e)).filter(F.col(BATCH) > after)
        return rows.join(batches, F.col(BATCH) == F.col("__committed"), "left_semi")

    def clean(self, e: Entity, version: int | None = None) -> DataFrame | None:
        rows = self.clean_table(e).rows(version=version)
        return None if rows is None else rows.select(e.surrogate, *e.clean_cols)

    def clean_feed(self, e: Entity, version: int) -> DataFrame:
        return self.clean_feeds(e, version, version)

    def clean_feeds(self, e: Entity, first: int, last: int) -> DataFrame:
        """Feeds of the versions first..last; ``_batch_id`` is the version."""
        rows = self.clean_table(e).read_versions(first, last).filter(F.col(merge.KIND) == "feed")
        return rows.withColumn(BATCH, F.col("v").cast("bigint")).drop("v", merge.KIND, BUCKET)

    def dim(self, e: Entity, mode: str = "sound") -> DataFrame | None:
        t = self.dim_table(e, mode)
        head = t.version()
        if not head:
            return None
        if mode == "reference":
            return t.read(head)
        rows = t.read_versions(1, head)
        return rows.filter((F.col(scd2.PART) == "closed") | (F.col("v") == head)).drop("v", scd2.PART)


def stage_schema(e: Entity) -> StructType:
    """Schema of the stage table: text columns, audit columns, batch id."""
    times = {"_stg_file_load_ts", "_copy_data_ts"}
    fields = [StructField(c, TimestampNTZType() if c in times else StringType()) for c in [*e.stage_cols, *AUDIT_COLS]]
    return StructType([*fields, StructField(BATCH, LongType())])


@dataclass
class LoadResult:
    batch_id: int | None
    files: int
    rows: int


def _next_batch_id(wh: Warehouse, e: Entity) -> int:
    row = wh.ledger.loads().filter(F.col("table_name") == e.name).agg(F.max("batch_id").alias("m")).first()
    last = int(row["m"]) if row and row["m"] is not None else 0
    # Never reuse an id whose folder exists (a load that failed before commit).
    fs_ids = []
    if path_exists(wh.spark, wh.stage_path(e)):
        jvm = wh.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(wh.stage_path(e))
        fs = p.getFileSystem(wh.spark.sparkContext._jsc.hadoopConfiguration())
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith(f"{BATCH}="):
                fs_ids.append(int(name.split("=", 1)[1]))
    return max([last, *fs_ids]) + 1


def append_stage(wh: Warehouse, e: Entity, rows: DataFrame, listing: DataFrame | None, as_of=None) -> LoadResult:
    """Write one stage batch and record its files in the ledger."""
    batch_id = _next_batch_id(wh, e)
    rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")) \
        .write.mode("append").partitionBy(BATCH).parquet(wh.stage_path(e))
    written = wh.spark.read.schema(stage_schema(e)).parquet(wh.stage_path(e)).filter(F.col(BATCH) == batch_id)
    counts = written.groupBy(F.col("_stg_file_md5").alias("file_key")).agg(
        F.count(F.lit(1)).alias("rows_loaded"), F.first("_stg_file_name").alias("file_name"))
    if listing is not None:
        content = F.col("content_key") if "content_key" in listing.columns else F.lit(None).cast("string")
        files = listing.select(F.col("path").alias("lname"), "file_key", content.alias("content_key")).join(counts, "file_key", "left")
        files = files.select(F.coalesce("file_name", "lname").alias("file_name"), "file_key",
                             F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"), "content_key")
    else:
        files = counts.withColumn("content_key", F.lit(None).cast("string"))
    at = as_of or _now()
    entries = files.select(
        F.lit(e.name).alias("table_name"), "file_name", "file_key",
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.col("rows_loaded").cast("bigint").alias("rows_loaded"),
        F.lit("LOADED").alias("status"),
        F.lit(at).cast("timestamp").alias("loaded_at"),
        "content_key",
    )
    wh.ledger.record_loads(entries)
    summary = wh.ledger.loads().filter((F.col("table_name") == e.name) & (F.col("batch_id") == batch_id)) \
        .agg(F.count(F.lit(1)).alias("files"), F.sum("rows_loaded").alias("rows")).first()
    return LoadResult(batch_id, int(summary["files"] or 0), int(summary["rows"] or 0))


MAX_FILES = 10_000


def copy_into(wh: Warehouse, e: Entity, path: str, *, as_of=None, bind_by: str = "position",
              file_cols=None, max_files: int = MAX_FILES, by_content: bool = True, listing: DataFrame | None = None,
              **reader_opts) -> LoadResult:
    """Load the files under ``path`` not loaded before into the stage table.

    The folder is listed once, or ``listing`` is taken (``sources.directory`` keeps one). The skip test is an anti join of the listing
    against the ledger; of files that are left, those whose path was loaded
    before with the same bytes are skipped as well and noted (``by_content``; only
    files that look new are read for it, in byte ranges). What remains is numbered
    and loaded ``max_files`` at a time, each round a batch of its own: that many
    paths come to the driver, to be handed to the reader. With
    ``on_error='continue'`` rows that cannot be parsed go to
    ``quarantine/<entity>_load`` with file and text, and are not loaded.
    """
    reader_opts.setdefault("multi_line", e.multi_line)
    found = ingest.list_files(wh.spark, path) if listing is None else listing
    new = found.join(wh.ledger.loaded_keys(e.name), "file_key", "left_anti")
    new = _staged(wh, new, "copy-listing")
    first = [r["path"] for r in new.select("path").limit(max_files + 1).collect()]
    rounds = 1 if first else 0
    if len(first) > max_files:
        numbered = assign_surrogate(new, "__n").withColumn("__round", F.floor((F.col("__n") - 1) / max_files)).drop("__n")
        new = _staged(wh, numbered, "copy-rounds")
        rounds = new.agg(F.max("__round").alias("m")).first()["m"] + 1
    batch_id, files, loaded = None, 0, 0
    for k in range(rounds):
        part, paths = new, first
        if rounds > 1:
            part = new.filter(F.col("__round") == k).drop("__round")
            paths = [r["path"] for r in part.select("path").collect()]
        if by_content:
            part, paths = _with_content(wh, e, part, paths, as_of)
        if not paths:
            continue
        rows = ingest.read_staged(wh.spark, paths, file_cols or e.stage_cols, target_cols=e.stage_cols,
                                  bind_by=bind_by, as_of=as_of, **reader_opts)
        if ingest.CORRUPT in rows.columns:
            bad = rows.filter(F.col(ingest.CORRUPT).isNotNull())
            bad.write.mode("overwrite").parquet(f"{wh.root}/quarantine/{e.name}_load/{BATCH}={_next_batch_id(wh, e)}")
            rows = rows.filter(F.col(ingest.CORRUPT).isNull()).drop(ingest.CORRUPT)
        done = append_stage(wh, e, rows, part, as_of)
        batch_id, files, loaded = done.batch_id, files + done.files, loaded + done.rows
    return LoadResult(batch_id, files, loaded)


def _staged(wh: Warehouse, df: DataFrame, name: str) -> DataFrame:
    path = unique_scratch(wh.spark, name)
    df.write.parquet(path)
    return wh.spark.read.schema(df.schema).parquet(path)


def _with_content(wh: Warehouse, e: Entity, new: DataFrame, paths: list[str], as_of) -> tuple[DataFrame, list[str]]:
    """New files with their content key, and their paths, without those loaded before under the same path with the same bytes."""
    keys = ingest.content_keys(wh.spark, paths)
    keyed = new.join(keys, "path", "left").withColumn("content_key", F.coalesce("content_key", F.when(F.col("length") == 0, F.lit("empty"))))
    known = wh.ledger.loaded_contents(e.name).withColumn("same", F.lit(True))
    keyed = _staged(wh, keyed.join(known, ["path", "content_key"], "left"), "copy-content")
    told = {r["path"]: bool(r["same"]) for r in keyed.select("path", "same").collect()}
    if any(told.values()):
        at = as_of or _now()
        wh.ledger.record_loads(keyed.filter("same").select(
            F.lit(e.name).alias("table_name"), F.col("path").alias("file_name"), "file_key", F.lit(None).cast("bigint").alias("batch_id"),
            F.lit(0).cast("bigint").alias("rows_loaded"), F.lit("SKIPPED").alias("status"), F.lit(at).cast("timestamp").alias("loaded_at"), "content_key"))
    return keyed.filter("same is null").drop("same"), sorted(p for p, same in told.items() if not same)


def _empty_clean(e: Entity, src: DataFrame) -> DataFrame:
    return src.select(F.lit(None).cast("bigint").alias(e.surrogate), *e.clean_cols).limit(0)


def run_clean(wh: Warehouse, e: Entity, *, as_of=None, mode: str = "sound", strategy: str = "shuffle",
              checks: str = "abort", not_older: str | None = None) -> int | None:
    """Merge staged batches not yet consumed into the clean table; returns the new version.

    ``not_older`` names a column by which rows older than the target's are left
    out (default: the last arrival wins, whatever its time).
    """
    table = wh.clean_table(e)
    last = table.consumed()
    # The batch to consume up to comes from the ledger: a batch may have no rows.
    max_batch = wh.ledger.committed_batches(e.name).agg(F.max("batch_id").alias("m")).first()["m"]
    if max_batch is None or max_batch <= last:
        return None
    stage = wh.stage(e, after=0 if e.source == "table" else last)
    if stage is None:
        return None
    src = e.conform(stage.drop(BATCH))
    rules = quality.rules_for(e.not_null, e.max_len)
    if checks == "abort":
        src = quality.enforce(src, rules)
    elif checks == "quarantine":
        src, bad = quality.split_valid(src, rules)
        bad.write.mode("overwrite").parquet(f"{wh.root}/quarantine/{e.name}/{BATCH}={max_batch}")
    if mode == "sound":
        src = merge.dedupe_latest(src, e.keys, e.order_cols)
    at = as_of or _now()
    stamp = {"_copy_data_ts": F.lit(at).cast("timestamp_ntz")}
    return table.upsert(
        src, consumed=max_batch, empty=_empty_clean(e, src),
        check=(lambda target, delta: merge.check_matched_unique(target, delta, e.keys)) if mode == "reference" else None,
        finish=lambda rows: privacy.tag(rows.withColumn(BATCH, F.lit(max_batch).cast("bigint")), e.tags),
        update_cols=e.update_cols,
        insert_cols=[c for c in e.clean_cols if c in src.columns],
        track=e.track,
        null_safe=(mode == "sound"),
        set_on_update=dict(e.set_on_update, **(stamp if e.stamp_copy_ts else {})),
        set_on_insert=dict(e.set_on_insert, **(stamp if e.stamp_copy_ts or e.insert_copy_ts else {})),
        surrogate=e.surrogate,
        strategy=strategy,
        not_older=not_older,
    )


def _dim_feed(wh: Warehouse, e: Entity, first: int, last: int) -> DataFrame:
    """One net change set of the clean versions first..last, in the dimension's columns."""
    cols = [F.col(c).cast(e.dim_overrides[c]).alias(c) if c in e.dim_overrides else F.col(c) for c in e.dim_values]
    feed = wh.clean_feeds(e, first, last).select(*cols, merge.ACTION, merge.IS_UPDATE, BATCH)
    return net_changes(feed, e.keys) if last > first else feed.drop(BATCH)


def run_dim(wh: Warehouse, e: Entity, *, as_of=None, mode: str = "sound", on_delete: str = "ignore") -> int:
    """Apply clean-table feeds not yet consumed to the dimension; returns the last clean version applied."""
    table = wh.dim_table(e, mode)
    last, head = table.consumed(), wh.clean_table(e).version()
    if last >= head:
        return head
    start, end, cur = e.dim_time
    at = as_of or _now()
    feed = _dim_feed(wh, e, last + 1, head)
    dim = wh.dim(e, mode)
    if dim is None:
        dim = scd2.empty_dim(feed, e.dim_values, e.dim_hash, start, end, cur)
    if mode == "reference":
        out = scd2.apply(dim, feed, keys=e.keys, value_cols=e.dim_values, hash_cols=e.dim_hash_cols,
                         hash_col=e.dim_hash, as_of=at, mode="reference", match_cols=e.dim_match,
                         start=start, end=end, current=cur)
    else:
        track = [c for c in e.dim_values if c not in e.keys]
        out = scd2.sound_rows(scd2.current_rows(dim, cur), feed, keys=e.keys, value_cols=e.dim_values, track=track,
                              hash_cols=e.dim_hash_cols, hash_col=e.dim_hash, as_of=at, on_delete=on_delete,
                              start=start, end=end, current=cur)
    table.write(privacy.tag(out, e.tags), consumed=head)
    return head


def run_batch(wh: Warehouse, e: Entity, path: str | None = None, *, as_of=None, mode: str = "sound",
              strategy: str = "shuffle", checks: str = "abort", bind_by: str = "position",
              not_older: str | None = None) -> dict:
    """Load new files (if ``path``), then clean merge, then dimension."""
    loaded = copy_into(wh, e, path, as_of=as_of, bind_by=bind_by) if path else LoadResult(None, 0, 0)
    version = run_clean(wh, e, as_of=as_of, mode=mode, strategy=strategy, checks=checks, not_older=not_older)
    run_dim(wh, e, as_of=as_of, mode=mode)
    return {"batch_id": loaded.batch_id, "files": loaded.files, "rows": loaded.rows,
            "clean_version": version}
