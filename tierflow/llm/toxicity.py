"""Toxicity score (operator 5): a character n-gram linear classifier on naive Bayes features.

Features are the character n-grams present in a lower-cased text. Over the
labelled training rows Spark counts the documents of each class that hold an
n-gram; the most significant n-grams (G statistic) are kept, each present one
takes the value of its log-count ratio

    r = log((pos + a) / (all_pos + 2a)) - log((neg + a) / (all_neg + 2a))

and Spark ML fits a logistic regression on these values. Scoring is one pass
over all whole texts without a shuffle; the model sent to the tasks has at
most ``MOST_FEATURES`` entries.

The classifier is fitted on at most ``MOST_PER_CLASS`` labelled rows of each
class (weights restore the shares); no other step takes a sample. Labels of
held-out rows, language, source and id are never inputs.

Null and empty texts have no features and get the score of the intercept.
Ties in the choice of n-grams go to the smaller hash. Repeated rows get the
same score each. With an empty table of documents the result is empty; with no
label of one class every score is that of the share of toxic labels (0 if there
is none). Only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import arrow_map, code_points, held_out, labelled_sample, mix64, ship, staged, table, text_blocks

ORDERS = (3, 4, 5)
BLOCK_CHARS = 200_000
MOST_PER_CLASS = 10_000
MOST_FEATURES = 4096
SMOOTHING = 1.0
#: An n-gram is used from this G statistic on: chance gives 1 in 10,000 unrelated ones as much.
LEAST_G = 15.0


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of all character n-grams of the texts, and the text of each."""
    lowered = [t.lower() for t in texts]
    points, starts, sizes = code_points(lowered)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes + 1)
    points = points.astype(np.uint64)
    points[(points >= 9) & (points <= 13)] = 32
    keys, owners = [], []
    for n in ORDERS:
        if len(points) <= n:
            continue
        last = len(points) - n
        h = np.full(last, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + points[k:k + last]
        inside = owner[:last] == owner[n:n + last]  # the separator itself may close a gram
        keys.append((mix64(h[inside]) >> np.uint64(32)).astype(np.int64))
        owners.append(owner[:last][inside])
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    return np.concatenate(keys), np.concatenate(owners)


def present(keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Distinct (text, hash) pairs, packed as text << 32 | hash."""
    return np.unique(owners.astype(np.int64) << 32 | keys)


def class_counts(rows: DataFrame) -> DataFrame:
    """(gram, pos, neg): weighted documents of each class that hold a gram, summed within a task first."""

    def run(batches):
        held = [np.empty(0, np.int64), np.empty((0, 2))]

        def add(keys, values):
            both, where = np.unique(np.concatenate([held[0], keys]), return_inverse=True)
            values = np.concatenate([held[1], values])
            held[0] = both
            held[1] = np.stack([np.bincount(where, values[:, c], len(both)) for c in (0, 1)], 1)

        for batch in batches:
            label = np.array(batch.column(2).to_pylist(), np.int64)
            weight = np.array(batch.column(3).to_pylist(), np.float64)
            numbered = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows)), batch.column(1)], names=["i", "t"])
            for ids, texts in text_blocks([numbered], BLOCK_CHARS):
                pairs = present(*ngrams(texts))
                of = np.array(ids, np.int64)[pairs >> 32]
                grams, where = np.unique(pairs & 0xFFFFFFFF, return_inverse=True)
                add(grams, np.stack([np.bincount(where, weight[of] * (label[of] == c), len(grams)) for c in (1, 0)], 1))
        for at in range(0, len(held[0]), 100_000):
            part = held[1][at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(held[0][at:at + 100_000]), pa.array(part[:, 0]), pa.array(part[:, 1])],
                                             names=["gram", "pos", "neg"])

    counted = arrow_map(rows.select("doc_id", "text", "label", "weight"), run, "gram long, pos double, neg double")
    return counted.groupBy("gram").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def xlogy(x, y):
    return F.when(x > 0, x * F.log(x / y)).otherwise(F.lit(0.0))


class Model:
    """Weights of the chosen n-grams, sorted by hash, and the intercept."""

    def __init__(self, grams: np.ndarray, weights: np.ndarray, intercept: float):
        order = np.argsort(grams)
        self.grams, self.weights, self.intercept = grams[order].astype(np.int64), weights[order], float(intercept)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[self.grams & 0xFFFFF] = True

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, index of a chosen gram) pairs."""
        keys, owners = ngrams(texts)
        maybe = self.filter[keys & 0xFFFFF]
        keys, owners = keys[maybe], owners[maybe]
        at = np.minimum(np.searchsorted(self.grams, keys), max(0, len(self.grams) - 1))
        same = self.grams[at] == keys if len(self.grams) else np.zeros(len(keys), bool)
        pairs = np.unique(owners[same].astype(np.int64) << 32 | at[same])
        return pairs >> 32, pairs & 0xFFFFFFFF

    def score(self, texts: list[str]) -> np.ndarray:
        owner, at = self.hits(texts)
        z = self.intercept + np.bincount(owner, self.weights[at], len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", most_per_class: int = MOST_PER_CLASS,
        most_features: int = MOST_FEATURES) -> Model:
    spark = docs.sparkSession
    ship(spark)
    sample = staged(labelled_sample(labels, column, most_per_class), "toxicity-labels")
    # At most 2 * most_per_class rows of 20 bytes: a bound that does not grow with the data.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = staged(rows.repartition(spark.sparkContext.defaultParallelism * 2), "toxicity-rows")
    share = {r["label"]: (r["w"]) for r in rows.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    n_pos, n_neg = share.get(1, 0.0), share.get(0, 0.0)
    if not n_pos or not n_neg:
        odds = -700.0 if not n_pos else 700.0
        return Model(np.empty(0, np.int64), np.empty(0), odds)
    # G statistic of the table (class, present or not), on counts of sampled rows: weights would make chance look like evidence.
    weight = {r["label"]: r["w"] for r in rows.groupBy("label").agg(F.max("weight").alias("w")).collect()}
    of_pos, of_neg = n_pos / weight[1], n_neg / weight[0]
    pos, neg, n = F.col("pos") / weight[1], F.col("neg") / weight[0], of_pos + of_neg
    g = F.lit(0.0)
    for inside, of in ((pos, of_pos), (neg, of_neg)):
        g = g + 2 * xlogy(inside, (pos + neg) * of / n) + 2 * xlogy(F.lit(of) - inside, (F.lit(n) - pos - neg) * of / n)
    chosen = (class_counts(rows).withColumn("g", F.round(g, 9)).filter(F.col("g") >= LEAST_G)
              .orderBy(F.desc("g"), "gram").limit(most_features).select("gram", "pos", "neg").collect())
    grams = np.array([r["gram"] for r in chosen], np.int64)
    pos = np.array([r["pos"] for r in chosen])
    neg = np.array([r["neg"] for r in chosen])
    a = SMOOTHING
    ratio = np.log((pos + a) / (n_pos + 2 * a)) - np.log((neg + a) / (n_neg + 2 * a))
    if not len(grams):
        return Model(grams, np.empty(0), np.log(n_pos / n_neg))
    chooser = Model(grams, ratio, 0.0)
    size = len(grams)

    @F.udf(VectorUDT())
    def features(text):
        _, at = chooser.hits([text or ""])
        return SparseVector(size, at, chooser.weights[at])

    train = staged(rows.select(features("text").alias("features"), F.col("label").cast("double").alias("label"), "weight")
                   .repartition(spark.sparkContext.defaultParallelism), "toxicity-features")
    fitted = LogisticRegression(weightCol="weight", regParam=1e-4, elasticNetParam=0.0, maxIter=30, tol=1e-5,
                                standardization=False).fit(train)
    return Model(chooser.grams, fitted.coefficients.toArray() * chooser.weights, fitted.intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(shared.value.score(texts))],
                                             names=["doc_id", "score"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, score double")


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents, with all their columns, whose score stays below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            keep = []
            numbered = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["i", "t"])
            for _, block in text_blocks([numbered], BLOCK_CHARS):
                keep.append(shared.value.score(block) < threshold)
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return arrow_map(docs, run, docs.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
