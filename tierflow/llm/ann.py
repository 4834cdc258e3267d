"""Approximate nearest neighbours on shifted space-filling curves (operator 4).

Every vector is projected onto a few random directions, shifted, and placed on
a Hilbert curve; ``CURVES`` independent projections and shifts give as many
orders of all vectors. Spark range-partitions and sorts each order, numbers its
rows, and cuts it into blocks of neighbouring keys. A query meets the blocks
within its window on either side, is compared there with every vector in
double precision, and its best of all windows and curves are merged.

Vectors that are equal are one entry of the index, with their smallest
``k + 1`` ids; so a vector that fills a third of the table costs one comparison,
and its copies still fill the ranks in order of their ids.

The window is a share of the rows (``WINDOW``): embeddings without clusters
(as the given ones nearly are) have neighbours all over any order, and recall
follows the share that is looked at. A window is ``REACH`` blocks to either
side; blocks grow with it up to ``MOST_BLOCK_ROWS`` rows, beyond which there are
more of them. A group of work is one block of one curve with one slice of the
queries that reach it, so groups stay bounded.

Inner product is the measure. Vectors that are null, zero, or hold null or
non-finite components take no part, neither do rows without an id; repeated
rows of one id and vector count once. Vectors of another length than the most
common one take no part either. An empty table gives an empty result; only the
id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.llm.common import arrow_map, ship, staged, table

NEIGHBOURS = 20
CURVES = 12
DIRECTIONS = 8
BITS = 7
WINDOW = 0.12
REACH = 4
MOST_BLOCK_ROWS = 1 << 15
#: Kept beyond k + 1 when lists are merged: scores of block products may differ in the last bit.
SPARE = 12
QUERY_SLICE = 1024


def curve_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (n, m) with ``bits`` bits each.

    The axes are turned to the transposed index by Skilling's method, one bit
    plane at a time for all points, then the planes are interleaved.
    """
    x = [c.astype(np.int64) for c in cells.T]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0]) ^ swap
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), np.int64)
    q = top
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    key = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | ((axis ^ turn) >> b & 1)
    return key


def index_entries(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """(entry, vector, ids): distinct usable vectors with their k + 1 smallest ids; entry is the smallest."""
    v = F.col("vector")
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
            .filter(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)))
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    if sizes:
        rows = rows.filter(F.size("vector") == sizes[0]["size"])
    # -0.0 and 0.0 are the same component.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))).distinct()
    first = Window.partitionBy("vector").orderBy("id")
    ranked = rows.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k + 1)
    return (ranked.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # k + 1 ids at most
            .select(F.col("ids")[0].alias("entry"), "vector", "ids"))


def numbered(entries: DataFrame, curves: int, seed: int) -> DataFrame:
    """(curve, entry, vector, place): the place of every entry in each order."""
    stats = entries.select(F.size("vector").alias("n"), F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x).alias("s")).agg(
        F.max("n").alias("width"), F.avg("s").alias("square")).first()
    width, spread = stats["width"], float(np.sqrt(stats["square"] / stats["width"]))
    m = min(DIRECTIONS, width)

    def draw(curve):
        rng = np.random.default_rng([seed, curve])
        return np.linalg.qr(rng.normal(size=(width, m)))[0], rng.uniform(0, 0.5, m)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = np.array(b.column(1).flatten()).reshape(b.num_rows, width)
            for curve in range(curves):
                directions, shift = draw(curve)
                # 3.5 spreads to either side fill half of the cube, the shift moves that half.
                unit = np.clip((x @ directions / (3.5 * spread) + 1) / 2, 0, 1)
                cells = np.minimum(((unit * 0.5 + shift) * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, curve, np.int32)), pa.array(curve_key(cells, BITS)), b.column(0)],
                                                 names=["curve", "key", "entry"])

    keyed = arrow_map(entries.select("entry", "vector"), run, "curve int, key long, entry long")
    ordered = keyed.repartitionByRange("curve", "key", "entry").sortWithinPartitions("curve", "key", "entry")
    ordered = staged(ordered.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "ann-order")
    # Rows before each partition of a curve: one row per curve and partition.
    parts = ordered.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("curve", "part", "first", before.alias("before"))
    return ordered.join(F.broadcast(parts), ["curve", "part"]).select("curve", "entry", (F.col("row") - F.col("first") + F.col("before")).alias("place"))


def nearest(vectors: DataFrame, query_filter, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS,
            curves: int = CURVES, window: float = WINDOW, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): k nearest of each row for which ``query_filter(id)`` holds."""
    spark = vectors.sparkSession
    ship(spark)
    empty = "query_id long, rank int, vec_id long, score double"
    entries = staged(index_entries(vectors, id_col, vector_col, k), "ann-entries")
    total = entries.count()
    if not total:
        return spark.createDataFrame([], empty)
    queries = (vectors.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("vector"))
               .filter(query_filter(F.col("query_id"))))
    queries = queries.withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))
    asked = staged(queries.join(entries.select("entry", "vector"), "vector").select("query_id", "entry").distinct(), "ann-queries")
    places = staged(numbered(entries, curves, seed), "ann-places")
    rows = min(MOST_BLOCK_ROWS, max(k + 1, int(np.ceil(window * total / 2 / REACH))))
    blocks = -(-total // rows)
    reach = int(np.ceil(window * total / 2 / rows))
    block = F.floor(F.col("place") / rows).cast("int")
    n_slices = max(1, -(-asked.count() * (2 * reach + 1) // blocks // QUERY_SLICE))
    vector_of = entries.select("entry", "vector")
    members = places.join(vector_of, "entry").select("curve", block.alias("block"), "entry", "vector", F.lit(False).alias("asks"))
    asking = places.join(asked.select("entry").distinct(), "entry").join(vector_of, "entry")
    at = block
    asking = (asking.select("curve", F.explode(F.sequence(F.greatest(F.lit(0), at - reach), F.least(F.lit(blocks - 1), at + reach))).alias("block"),
                            "entry", "vector", F.lit(True).alias("asks"))
              .withColumn("slice", F.pmod(F.xxhash64("entry"), F.lit(n_slices)).cast("int")))
    slices = asking.groupBy("curve", "block").agg(F.collect_set("slice").alias("slices"))  # as many as there are slices of queries
    members = members.join(slices, ["curve", "block"]).select("curve", "block", "entry", "vector", "asks", F.explode("slices").alias("slice"))
    work = members.unionByName(asking)

    def best(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy(bool)
        if not asks.any() or asks.all():
            return pd.DataFrame({"entry": np.empty(0, np.int64), "near": [], "score": []})
        ids = group["entry"].to_numpy(np.int64)
        q, c = np.stack(group["vector"][asks].to_list()), np.stack(group["vector"][~asks].to_list())
        take = min(k + 1 + SPARE, len(c))
        score = q @ c.T
        top = np.argpartition(-score, take - 1, axis=1)[:, :take]
        return pd.DataFrame({"entry": ids[asks], "near": list(ids[~asks][top]), "score": list(np.take_along_axis(score, top, 1))})

    # Merge the lists of all windows and curves.
    listed = (work.groupBy("curve", "block", "slice").applyInPandas(best, "entry long, near array<long>, score array<double>")
              .select("entry", F.explode(F.arrays_zip("near", "score")).alias("x")).select("entry", "x.near", "x.score")
              .groupBy("entry", "near").agg(F.max("score").alias("score")))
    closest = Window.partitionBy("entry").orderBy(F.desc("score"), "near")
    found = listed.withColumn("r", F.row_number().over(closest)).filter(F.col("r") <= k + 1 + SPARE).select("entry", "near")

    # Rerank: the measure itself, once for each pair of entries, then ids in order.
    pair = (found.join(vector_of.withColumnRenamed("vector", "q"), "entry")
            .join(entries.select(F.col("entry").alias("near"), F.col("vector").alias("c"), "ids"), "near"))

    def measure(batches):
        for b in batches:
            if not b.num_rows:
                continue
            q, c = (np.array(b.column(i).flatten()).reshape(b.num_rows, -1) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.einsum("ij,ij->i", q, c)), b.column(3)], names=["entry", "score", "ids"])

    scored = arrow_map(pair.select("entry", "q", "c", "ids"), measure, "entry long, score double, ids array<long>")
    order = Window.partitionBy("entry").orderBy(F.desc("score"), F.col("ids")[0])
    scored = scored.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    near = (asked.join(scored, "entry").select("query_id", "score", F.explode("ids").alias("vec_id"))
            .filter(F.col("query_id") != F.col("vec_id")))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
