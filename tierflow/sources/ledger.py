"""Load ledger, kept as a small append-only parquet table.

load ledger  one row per loaded file: (table_name, file_name, file_key,
             batch_id, rows_loaded, status, loaded_at, content_key). A file
             whose (table, key) is present is not loaded again, nor is one
             whose path and content are (status SKIPPED: same bytes under a new
             time); ``copy_history`` filters it by table and time.

What consumers have taken from the stage is not kept here but in the commit
marker of the version they wrote (sources/tables.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources.tables import path_exists

LEDGER_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_key", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()),
    T.StructField("content_key", T.StringType()),
])

class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.loads_path = f"{self.root}/load_ledger"

    # ------------------------------------------------------------ loads
    def loads(self) -> DataFrame:
        if not path_exists(self.spark, self.loads_path):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.loads_path)

    def record_loads(self, rows: DataFrame) -> None:
        """Append ledger rows (a DataFrame with LEDGER_SCHEMA's columns; ``content_key`` may be missing)."""
        if "content_key" not in rows.columns:
            rows = rows.withColumn("content_key", F.lit(None))
        rows.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA.fields]) \
            .write.mode("append").parquet(self.loads_path)

    def loaded_keys(self, table: str) -> DataFrame:
        return self.loads().filter((F.col("table_name") == table) & F.col("status").isin("LOADED", "SKIPPED")) \
            .select("file_key")

    def loaded_contents(self, table: str) -> DataFrame:
        """Paths loaded before, with the content they had."""
        return self.loads().filter((F.col("table_name") == table) & (F.col("status") == "LOADED") & F.col("content_key").isNotNull()) \
            .select(F.col("file_name").alias("path"), "content_key").distinct()

    def committed_batches(self, table: str) -> DataFrame:
        return self.loads().filter((F.col("table_name") == table) & (F.col("status") == "LOADED")) \
            .select("batch_id").distinct()

    def copy_history(self, table: str, since=None, now=None) -> DataFrame:
        """Load history of ``table`` (default: the last hour before ``now``)."""
        h = self.loads().filter(F.col("table_name") == table)
        if since is None:
            end = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
            since_col = end - F.expr("INTERVAL 1 HOUR")
        else:
            since_col = F.lit(since).cast("timestamp")
        return h.filter(F.col("loaded_at") >= since_col)
