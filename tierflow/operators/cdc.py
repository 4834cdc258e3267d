"""Change feeds: snapshot diffs, netting across batches, append-only reads.

A feed holds the table's columns plus ``_change_action`` ('INSERT' /
'DELETE') and ``_change_is_update``; feeds kept across batches also
carry ``_batch_id``. All operators are joins/aggregations keyed by the
business key; none gathers a key's history into one task: netting uses
min/max over packed structs, which Spark combines map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.operators.merge import ACTION, IS_UPDATE, has_null, spread

BATCH = "_batch_id"


def _image(cols, action, is_update):
    return F.struct(
        *cols,
        F.lit(action).cast("string").alias(ACTION),
        F.lit(is_update).cast("boolean").alias(IS_UPDATE),
    )


def _same(cols, a: str, b: str):
    terms = [F.col(a + c).eqNullSafe(F.col(b + c)) for c in cols]
    return reduce(lambda x, y: x & y, terms) if terms else F.lit(True)


def diff_snapshots(old: DataFrame, new: DataFrame, keys, compare=None) -> DataFrame:
    """Feed that turns snapshot ``old`` into ``new`` (full outer join on keys).

    Rows equal on ``compare`` (default: all columns, NULL-safe) give nothing.
    """
    keys = list(keys)
    cols = old.columns
    compare = [c for c in cols if c not in keys] if compare is None else list(compare)
    # Rows with a NULL key never match; their hash spreads them over the partitions.
    o = old.select(*[F.col(c).alias("__o_" + c) for c in cols], F.lit(True).alias("__o"),
                   (-F.abs(spread(old, keys))).alias("__os"))
    n = new.select(*[F.col(c).alias("__n_" + c) for c in cols], F.lit(True).alias("__n"),
                   F.abs(spread(new, keys)).alias("__ns"))
    cond = reduce(lambda a, b: a & b, [o["__o_" + k] == n["__n_" + k] for k in keys]) & (o["__os"] == n["__ns"])
    j = o.join(n, cond, "full_outer")
    before = [F.col("__o_" + c).alias(c) for c in cols]
    after = [F.col("__n_" + c).alias(c) for c in cols]
    o_in, n_in = F.col("__o").isNotNull(), F.col("__n").isNotNull()
    items = (
        F.when(o_in & ~n_in, F.array(_image(before, "DELETE", False)))
        .when(~o_in & n_in, F.array(_image(after, "INSERT", False)))
        .when(_same(compare, "__o_", "__n_"), F.lit(None))
        .otherwise(F.array(_image(before, "DELETE", True), _image(after, "INSERT", True)))
    )
    return j.select(F.explode(items).alias("__x")).select("__x.*")


def net_changes(feed: DataFrame, keys, compare=None, batch_col: str = BATCH) -> DataFrame:
    """Net several batches of changes per key into one change set.

    For each key: the first image (earliest batch, DELETE before INSERT)
    tells whether the key existed before the window; the last image tells
    whether it exists after. Existing both times -> update pair (dropped
    when equal on ``compare``); only before -> DELETE; only after -> INSERT.
    Changes of rows with a NULL key cannot be told apart and are kept as they are.
    """
    keys = list(keys)
    data = [c for c in feed.columns if c not in (ACTION, IS_UPDATE, batch_col)]
    others = [c for c in data if c not in keys]
    compare = others if compare is None else list(compare)
    seq = F.when(F.col(ACTION) == "DELETE", F.lit(0)).otherwise(F.lit(1))
    packed = F.struct(
        F.col(batch_col).alias("__b"), seq.alias("__q"), F.col(ACTION).alias("__a"),
        *[F.col(c) for c in others],
    )
    loose = feed.filter(has_null(keys)).select(*data, ACTION, IS_UPDATE)
    g = feed.filter(~has_null(keys)).groupBy(*keys).agg(F.min(packed).alias("__f"), F.max(packed).alias("__l"))
    existed = F.col("__f.__a") == "DELETE"
    exists = F.col("__l.__a") == "INSERT"
    before = [F.col(k) for k in keys] + [F.col(f"__f.{c}").alias(c) for c in others]
    after = [F.col(k) for k in keys] + [F.col(f"__l.{c}").alias(c) for c in others]
    same = reduce(lambda x, y: x & y, [F.col(f"__f.{c}").eqNullSafe(F.col(f"__l.{c}")) for c in compare]) \
        if compare else F.lit(True)
    items = (
        F.when(existed & exists & same, F.lit(None))
        .when(existed & exists, F.array(_image(before, "DELETE", True), _image(after, "INSERT", True)))
        .when(existed, F.array(_image(before, "DELETE", False)))
        .when(exists, F.array(_image(after, "INSERT", False)))
    )
    out = g.select(F.explode(items).alias("__x")).select("__x.*")
    return out.select(*data, ACTION, IS_UPDATE).unionByName(loose)


def appended_since(df: DataFrame, last_consumed: int, batch_col: str = BATCH) -> DataFrame:
    """Append-only stream read: rows of batches after the consumer's offset."""
    return df.filter(F.col(batch_col) > F.lit(last_consumed))


def peek_counts(feed: DataFrame) -> DataFrame:
    """Counts per (action, is_update) without moving any consumer offset."""
    return feed.groupBy(ACTION, IS_UPDATE).agg(F.count(F.lit(1)).alias("n"))


def with_batch(df: DataFrame, batch_id: int, batch_col: str = BATCH) -> DataFrame:
    return df.withColumn(batch_col, F.lit(batch_id).cast("bigint"))
