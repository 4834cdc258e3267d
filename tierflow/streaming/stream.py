"""Structured Streaming runner: landed CSV files -> stage -> clean -> dimension.

The file source and its checkpoint track which files were read; each
micro-batch runs the same batch steps as ``plans.batch``. ``foreachBatch``
is at-least-once, so the batch function first drops files whose key is
already in the load ledger: a replayed micro-batch adds nothing twice.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.plans import batch
from tierflow.plans.entities import Entity
from tierflow.sources import ingest


def entity_stream(spark: SparkSession, e: Entity, landing: str, *, as_of=None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of staged text rows with audit columns."""
    reader = ingest.csv_reader(spark, e.stage_cols, streaming=True, multi_line=e.multi_line) \
        .option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return ingest.with_audit(reader.load(landing), as_of)


def process_micro_batch(wh: batch.Warehouse, e: Entity, *, as_of=None, mode: str = "sound",
                        strategy: str = "shuffle", checks: str = "abort"):
    def run(df: DataFrame, epoch_id: int) -> None:
        # Files, not rows, are looked up in the ledger; the micro-batch is parsed once.
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            files = df.select("_stg_file_md5").distinct()
            fresh = files.join(wh.ledger.loaded_keys(e.name), files["_stg_file_md5"] == F.col("file_key"), "left_anti")
            if not fresh.isEmpty():
                batch.append_stage(wh, e, df.join(fresh, "_stg_file_md5", "left_semi"), None, as_of)
        finally:
            df.unpersist()
        batch.run_clean(wh, e, as_of=as_of, mode=mode, strategy=strategy, checks=checks)
        batch.run_dim(wh, e, as_of=as_of, mode=mode)
    return run


def run_entity(spark: SparkSession, wh: batch.Warehouse, e: Entity, landing: str, checkpoint: str, *,
               as_of=None, mode: str = "sound", available_now: bool = True,
               processing_time: str | None = None, max_files_per_trigger: int | None = None):
    """Start the stream; with ``available_now`` it processes what has landed and stops."""
    stream = entity_stream(spark, e, landing, as_of=as_of, max_files_per_trigger=max_files_per_trigger)
    writer = stream.writeStream.foreachBatch(process_micro_batch(wh, e, as_of=as_of, mode=mode)) \
        .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time or "1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
