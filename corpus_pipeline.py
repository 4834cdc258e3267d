"""Corpus preparation in five stages, each one operator of ``tierflow.llm``.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the docs of the next one. All but the last return the
columns they got.

1. toxicity (operator 5): documents scored as toxic go.
2. near_duplicates (operator 9): one document of each group stays.
3. decontamination (operator 2): documents that hold a test item go.
4. pii (operator 1): personal data and secrets are replaced by surrogates.
5. bpe (operator 3): texts are encoded; the result is one row of digests each.

Null and empty texts, repeated rows, null ids and empty tables are treated as
the operators say; a document with a null id passes through stages 2 and 3.
Where several texts share an id, each is a document of its own: stages 2 and 3
judge it apart from the others. Rows that repeat id and text are copies, one of
them leaves stage 2. Other columns may have any name but ``__row``, ``__text`` and
``__gone``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import bpe, decontaminate, neardup, surrogates, toxicity
from tierflow.llm.common import staged, table

BROADCAST_ROWS = 1_000_000


def without(docs: DataFrame, ids: DataFrame, column: str = "doc_id", how: str = "left_anti") -> DataFrame:
    """The rows whose ``column`` is not in ``ids`` (8 MB at most are broadcast, more are shuffled)."""
    ids = staged(ids.select(F.col("doc_id").alias("__gone")).distinct(), "pipeline-ids")
    gone = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    return docs.join(gone, F.col(column) == F.col("__gone"), how)


def rows_of(docs: DataFrame) -> DataFrame:
    """``docs`` with a key ``__row`` that tells texts under one id apart; repeats of id and text are dropped.

    An id of one text is its own key. Each text of an id with several gets the
    hash of both, under a salt that makes none equal to an id or to another key.
    """
    repeated = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = staged(repeated, "pipeline-repeated")
    plain = docs.withColumn("__row", F.col("doc_id").cast("long"))
    if repeated.isEmpty():
        return plain
    # Combined in the task first, so an id with many copies is no hot group.
    texts = without(docs, repeated, how="left_semi").withColumn("__text", F.sha2(F.coalesce(F.concat(F.lit("="), "text"), F.lit("")), 256))
    texts = staged(texts.dropDuplicates(["doc_id", "__text"]), "pipeline-texts")
    several = staged(texts.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "pipeline-several")
    salt = 0
    while True:
        key = F.xxhash64(F.lit(salt), "doc_id", "__text")
        of_several = staged(without(texts, several, how="left_semi").withColumn("__row", key), "pipeline-keys")
        taken = of_several.join(docs.select(F.col("doc_id").cast("long").alias("__gone")), F.col("__row") == F.col("__gone"), "left_semi")
        if taken.isEmpty() and of_several.groupBy("__row").count().filter("count > 1").isEmpty():
            break
        salt += 1
    one = without(texts, several).withColumn("__row", F.col("doc_id").cast("long"))
    return staged(without(plain, repeated).unionByName(one.drop("__text")).unionByName(of_several.drop("__text")), "pipeline-rows")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = rows_of(docs)
    groups = neardup.groups(rows.select(F.col("__row").alias("doc_id"), "text"))
    return without(rows, groups.filter("not kept"), "__row").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = rows_of(docs)
    found = decontaminate.contaminated(rows.select(F.col("__row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return without(rows, found, "__row").select(docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = surrogates.replaced(docs).select(docs.columns)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, bpe.default_vocabulary())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

# A fitted classifier, MinHash groups and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last result is the pipeline's."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
