"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import unique_scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Used where a result is read more than once: the files are on the shared
    store, so a lost executor costs no recomputation, and the planner sees the
    written size when it chooses between a broadcast and a shuffle join.
    """
    path = unique_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, unless their path has it.

    Functions sent to workers refer to its modules by name, so that caches of a
    worker (a vocabulary, say) live longer than one task.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    listed = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root in map(os.path.abspath, filter(None, listed)) or getattr(sc, "_tierflow_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="tierflow-"), "tierflow_package.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "tierflow")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    sc._tierflow_shipped = True


#: Rows of one Arrow batch: texts of a few kilobytes make it a few megabytes, in the JVM and in Python.
ARROW_ROWS = 2000


def arrow_map(df: DataFrame, run, schema) -> DataFrame:
    spark = df.sparkSession
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.mapInArrow(run, schema)


def held_out(doc_id) -> F.Column:
    """True for the rows that no label may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def text_blocks(batches, max_chars: int) -> Iterator[tuple[list, list[str]]]:
    """Regroup Arrow batches of (id, text) into blocks of about ``max_chars``.

    Memory in a task follows the block, not the Arrow batch; a null text
    counts as empty. A text longer than the bound forms a block of its own.
    """
    ids, texts, size = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 500):  # Python strings of a part of the batch at a time
            part = batch.slice(at, 500)
            for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                t = t or ""
                if texts and size + len(t) > max_chars:
                    yield ids, texts
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
    if texts:
        yield ids, texts


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 (uint64 in, uint64 out)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def gather_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of all positions of the ranges [start, start + length), in order."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed, with start and length of each text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, np.cumsum(sizes + 1) - sizes - 1, sizes


def labelled_sample(labels: DataFrame, column: str, most_per_class: int) -> DataFrame:
    """(doc_id, label, weight) of labelled training rows, at most so many of each class.

    Rows in the held-out fold never enter. The sample is the rows with the
    smallest hash of the id, so it is the same at every run; ``weight`` restores
    the share of each class. A document with several labels counts once, by its
    smallest label.
    """
    rows = (labels.select("doc_id", F.col(column).cast("int").alias("label"))
            .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min("label").alias("label")))
    total = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = []
    for label in (0, 1):
        n = total.get(label, 0)
        weight = max(1.0, n / most_per_class)
        parts.append(rows.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_per_class)
                     .withColumn("weight", F.lit(weight)))
    return parts[0].unionByName(parts[1])
