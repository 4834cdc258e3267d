"""Exact length histogram of encoded documents (operator 7).

Every whole text is encoded with a byte-level vocabulary, documents are counted
by number of tokens, and suffix sums over the histogram give, for each length
that occurs taken as a context limit: documents and tokens in total, documents
and tokens that are longer, tokens left when longer texts are cut at the limit,
and the share of documents that fit (so the row of a quantile is the first whose
share reaches it). Between two lengths that occur nothing but the truncated
total changes, by one token for each longer document; ``at_limit`` answers any
limit exactly.

Documents are counted in the tasks that encode them before anything is
shuffled. Suffix sums run in two levels: within blocks of ``SPAN`` lengths
(a window over each block) and over the sums of the blocks, of which there are
at most the longest length / SPAN; no step puts all lengths in one task.

Null and empty texts have length 0 and are counted. Repeated rows count as often
as they occur; equal lengths are one row, so ties cannot arise. An empty table
gives an empty result. Only the text column is read, so others may have any name.
"""

from __future__ import annotations

import base64
import functools
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.llm.common import arrow_map, staged, table, text_blocks

BLOCK_CHARS = 500_000
SPAN = 512


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def histogram(docs: DataFrame, vocab_path: str, text_col: str = "text") -> DataFrame:
    """(length, documents): how many texts have each number of tokens."""

    def run(batches):
        counts = Counter()
        encode = encoder(vocab_path).encode_ordinary
        for _, texts in text_blocks(batches, BLOCK_CHARS):
            counts.update(len(encode(t)) for t in texts)
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
                                             names=["length", "documents"])

    rows = docs.select(F.lit(None).cast("long"), text_col)
    return arrow_map(rows, run, "length long, documents long").groupBy("length").agg(F.sum("documents").alias("documents"))


def limits(lengths: DataFrame) -> DataFrame:
    """Answers for every length of a (length, documents) histogram, written before."""
    rows = lengths.withColumn("block", F.floor(F.col("length") / SPAN)).withColumn("tokens", F.col("length") * F.col("documents"))
    blocks = staged(rows.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t")), "lengths-blocks")
    # One row per block of lengths: short even for very long documents.
    later = Window.orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = blocks.select("block", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_after") for c in "dt"],
                          *[F.sum(c).over(everything).alias(f"{c}_all") for c in "dt"])
    inside = Window.partitionBy("block").orderBy("length").rowsBetween(1, Window.unboundedFollowing)
    longer = [(F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"{c[0]}_after")).alias(f"longer_{c}") for c in ("documents", "tokens")]
    return (rows.join(after, "block").select("length", "documents", F.col("d_all").alias("total_documents"),
                                             F.col("t_all").alias("total_tokens"), *longer)
            .withColumn("truncated_tokens", F.col("total_tokens") - F.col("longer_tokens") + F.col("length") * F.col("longer_documents"))
            .withColumn("cut_tokens", F.col("total_tokens") - F.col("truncated_tokens"))
            .withColumn("share_fitting", 1 - F.col("longer_documents") / F.col("total_documents")))


def at_limit(answers: DataFrame, limit: int) -> DataFrame:
    """The answers for any context limit, from the next length at or below it."""
    below = answers.filter(F.col("length") <= limit).orderBy(F.desc("length")).limit(1)
    rest = F.lit(limit) - F.col("length")
    row = below.select(F.lit(limit).alias("limit"), "total_documents", "total_tokens", "longer_documents", "longer_tokens",
                       (F.col("truncated_tokens") + rest * F.col("longer_documents")).alias("truncated_tokens"))
    least = answers.orderBy("length").limit(1).filter(F.col("length") > limit)
    return row.unionByName(least.select(F.lit(limit).alias("limit"), "total_documents", "total_tokens", F.col("total_documents").alias("longer_documents"),
                                        F.col("total_tokens").alias("longer_tokens"), (F.lit(limit) * F.col("total_documents")).alias("truncated_tokens")))


def quantile(answers: DataFrame, share: float) -> DataFrame:
    """The least length within which this share of the documents fits."""
    return answers.filter(F.col("share_fitting") >= share - 1e-12).agg(F.min("length").alias("length"))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op7_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = staged(histogram(table(spark, sf_dir, "documents"), default_vocabulary()), "lengths-histogram")
    return limits(counted)
