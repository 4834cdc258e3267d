"""Slowly changing dimension, type 2, driven by a change feed.

Two modes:

reference  The source's MERGE: feed rows are matched to *all* dimension
           rows on ``match_cols`` with plain ``=``. A matched DELETE image
           of an update closes the row (end = as_of, current = false); an
           unmatched INSERT image adds a version. Pure deletes are ignored.
           Known consequences are kept on purpose: NULL attributes never
           match (row stays current), A->B->A leaves no current row, a no-op
           replay closes the row, closed rows are closed again.

sound      Feed is netted per key first (no-op pairs vanish); only
           *current* rows are matched, by key; values compare NULL-safe. A
           changed key closes its current row and opens a new one; an
           unchanged one is left alone; pure deletes close the row when
           ``on_delete='expire'``. The hash key digests eff_start as well, so
           a reverted version gets a new key.

Closed rows never change in sound mode, so ``sound_rows`` gives only the
rows closed by this batch and the next current set, told apart by ``_part``,
from one join of the current set and the net changes: one write stores both.
Changes of rows with a NULL key are left out in sound mode: without a key there
is no entity whose versions could be kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.keys import hash_key
from tierflow.operators.cdc import BATCH, net_changes
from tierflow.operators.merge import ACTION, IS_UPDATE, has_null

START, END, CURRENT = "eff_start", "eff_end", "is_current"
PART = "_part"


def _ts(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def _and(terms):
    return reduce(lambda a, b: a & b, terms) if terms else F.lit(True)


def dim_columns(hash_col, value_cols, start=START, end=END, current=CURRENT):
    return [hash_col, *value_cols, start, end, current]


def empty_dim(feed: DataFrame, value_cols, hash_col: str, start=START, end=END, current=CURRENT) -> DataFrame:
    """An empty dimension typed from the feed's columns."""
    return feed.select(
        F.lit(None).cast("bigint").alias(hash_col),
        *value_cols,
        F.lit(None).cast("timestamp").alias(start),
        F.lit(None).cast("timestamp").alias(end),
        F.lit(None).cast("boolean").alias(current),
    ).limit(0)


def _new_versions(rows: DataFrame, value_cols, hash_cols, hash_col, as_of, start, end, current):
    out = rows.select(*value_cols).withColumn(start, _ts(as_of))
    return out.select(
        hash_key(list(hash_cols), sound=False).alias(hash_col),
        *value_cols,
        F.col(start),
        F.lit(None).cast("timestamp").alias(end),
        F.lit(True).alias(current),
    )


def apply_reference(dim, feed, *, value_cols, match_cols, hash_cols, hash_col, as_of,
                    start=START, end=END, current=CURRENT) -> DataFrame:
    match_cols = list(match_cols)
    dels = (
        feed.filter((F.col(ACTION) == "DELETE") & F.col(IS_UPDATE))
        .select(*[F.col(c).alias("__d_" + c) for c in match_cols])
        .dropDuplicates()
        .withColumn("__hit", F.lit(True))
    )
    cond = _and([F.col(c) == F.col("__d_" + c) for c in match_cols])
    marked = dim.join(dels, cond, "left")
    hit = F.col("__hit").isNotNull()
    expired = marked.select(
        *[F.col(c) for c in dim_columns(hash_col, value_cols, start, end, current)
          if c not in (end, current)],
        F.when(hit, _ts(as_of)).otherwise(F.col(end)).alias(end),
        F.when(hit, F.lit(False)).otherwise(F.col(current)).alias(current),
    )
    ins = feed.filter(F.col(ACTION) == "INSERT")
    existing = dim.select(*[F.col(c).alias("__e_" + c) for c in match_cols])
    unmatched = ins.join(existing, _and([F.col(c) == F.col("__e_" + c) for c in match_cols]), "left_anti")
    new = _new_versions(unmatched, value_cols, hash_cols, hash_col, as_of, start, end, current)
    return expired.unionByName(new)


def sound_rows(current_rows, feed, *, keys, value_cols, track, hash_cols, hash_col, as_of,
               on_delete="ignore", start=START, end=END, current=CURRENT) -> DataFrame:
    """Rows closed by this batch (``_part='closed'``) and the next current rows (``'current'``)."""
    keys = list(keys)
    if BATCH not in feed.columns:
        feed = feed.withColumn(BATCH, F.lit(0).cast("bigint"))
    feed = feed.filter(~has_null(keys))
    net = net_changes(feed.select(*value_cols, ACTION, IS_UPDATE, BATCH), keys, compare=track)
    gone = (F.col(ACTION) == "DELETE") & ~F.col(IS_UPDATE)
    net = net.filter((F.col(ACTION) == "INSERT") | gone) if on_delete == "expire" else net.filter(F.col(ACTION) == "INSERT")
    chg = net.select(*[F.col(c).alias("__n_" + c) for c in value_cols], F.col(ACTION).alias("__k"))
    cols = dim_columns(hash_col, value_cols, start, end, current)
    old = current_rows.select(*cols, F.lit(True).alias("__c"))
    j = old.join(chg, _and([F.col(k) == F.col("__n_" + k) for k in keys]), "full_outer")
    types = {f.name: f.dataType for f in current_rows.schema.fields}
    same = _and([F.col(c).eqNullSafe(F.col("__n_" + c)) for c in track])
    was, added = F.col("__c").isNotNull(), F.col("__k").eqNullSafe(F.lit("INSERT"))
    keep = was & (F.col("__k").isNull() | (added & same))
    # The hash key digests the values and the start of the version that opens.
    opened = {c: F.col("__n_" + c) for c in value_cols} | {start: _ts(as_of)}
    digest = [opened[c] for c in [*hash_cols, start]]

    def row(values, part):
        return F.struct(*[values[c].cast(types[c]).alias(c) for c in cols], F.lit(part).alias(PART))

    old_values = {c: F.col(c) for c in cols}
    new_values = opened | {hash_col: hash_key(digest, sound=True), end: F.lit(None), current: F.lit(True)}
    closed = row(old_values | {end: _ts(as_of), current: F.lit(False)}, "closed")
    new = row(new_values, "current")
    items = (
        F.when(keep, F.array(row(old_values, "current")))
        .when(was & added, F.array(closed, new))
        .when(was, F.array(closed))
        .when(added, F.array(new))
    )
    return j.select(F.explode(items).alias("__x")).select("__x.*")


def apply(dim, feed, *, keys, value_cols, hash_cols, hash_col, as_of, mode="sound",
          match_cols=None, track=None, on_delete="ignore",
          start=START, end=END, current=CURRENT) -> DataFrame:
    """Apply one feed batch to a dimension and return the new dimension.

    keys        business key
    value_cols  columns stored in the dimension (keys first)
    match_cols  reference mode: ON-clause columns (default: value_cols)
    track       sound mode: columns whose change makes a new version
                (default: value_cols minus keys)
    hash_cols   columns digested into the hash key
    """
    value_cols = list(value_cols)
    if mode == "reference":
        return apply_reference(
            dim, feed, value_cols=value_cols, match_cols=match_cols or value_cols,
            hash_cols=hash_cols, hash_col=hash_col, as_of=as_of,
            start=start, end=end, current=current,
        )
    if mode != "sound":
        raise ValueError(f"unknown mode {mode!r}")
    track = [c for c in value_cols if c not in keys] if track is None else list(track)
    cur = dim.filter(F.col(current))
    closed = dim.filter(~F.col(current))
    rows = sound_rows(
        cur, feed, keys=keys, value_cols=value_cols, track=track, hash_cols=hash_cols,
        hash_col=hash_col, as_of=as_of, on_delete=on_delete, start=start, end=end, current=current,
    )
    return closed.unionByName(rows.drop(PART))


def current_rows(dim: DataFrame, current: str = CURRENT) -> DataFrame:
    """The current version of every key."""
    return dim.filter(F.col(current))
