"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings every tierflow job relies on. Time zone is pinned so that
# timestamp parsing and oracle comparisons do not depend on the host.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tierflow",
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with tierflow's defaults.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data
    (roughly input bytes / 128 MB), not to the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the shared checkpoint location named by the cluster.

    The location comes from ``spark.checkpoint.dir``. Where it is unset a
    fresh folder is made for a local master only; on a cluster that is an
    error, since executors do not share the driver's disk.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tierflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    path = base.rstrip("/")
    for part in parts:
        path = f"{path}/{part}"
    return path


def unique_scratch(spark: SparkSession, name: str) -> str:
    """A scratch folder no earlier run has used."""
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function that writes a frame to scratch and reads it back; on leaving, what it wrote is deleted.

    Inside, shuffle files go as soon as the query that made them has ended; else
    they stay until the driver happens to collect its garbage, which for a chain of
    large steps is too late. So what a step needs on disk is its own, not the sum
    of all steps before it.
    """
    made, before = [], spark.conf.get(FREE_SHUFFLES, None)

    def written(df: DataFrame, name: str) -> DataFrame:
        made.append(unique_scratch(spark, name))
        df.write.option("compression", "zstd").parquet(made[-1])
        return spark.read.schema(df.schema).parquet(made[-1])

    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield written
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
        for folder in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df):
    """Cut lineage: a reliable checkpoint into ``spark.checkpoint.dir``.

    Used between chained batch steps so plans do not grow with the number
    of steps; the files live in the shared folder, so a lost executor
    does not lose them (unlike a local checkpoint).
    """
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)
