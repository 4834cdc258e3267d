"""Upsert (MERGE) of a source batch into a target table, with its change feed.

``merge_rows`` is the single-pass form: one join of target and source,
whose rows are exploded into (a) the rows of the new table and (b) the
change-feed rows, tagged by ``_kind``. A batch runner writes that frame
once, partitioned by ``_kind``; ``upsert`` splits it lazily.

Feed convention (one row per image):
  insert -> INSERT, is_update=false   (after image)
  update -> DELETE, is_update=true    (before image)
          + INSERT, is_update=true    (after image)

Join strategies:
  shuffle    full outer join on the key (sort-merge); reads and shuffles the
             target once, whatever the delta.
  auto       target left join delta, plus the delta's keys that the target does
             not hold. No hint and no guess of sizes: Spark broadcasts the
             delta if its statistics (of the written delta, or at run time) are
             under its threshold, and then the target is never shuffled.
  broadcast  like auto (kept as a name for callers that expect a small delta).

Rows with a NULL key never match; a hash of the whole row goes into the join
key with them, so they spread over all partitions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.keys import assign_surrogate, max_key

T = "__t_"
S = "__s_"
ACTION = "_change_action"
IS_UPDATE = "_change_is_update"
KIND = "_kind"
#: Column of a source that already brings the surrogate keys of its rows.
NEW_KEY = "__sk"
FEED_COLS = (ACTION, IS_UPDATE)

class DuplicateKeyError(ValueError):
    pass


def changed(cols, left: str = T, right: str = S, null_safe: bool = True) -> Column:
    """True when any tracked column differs between the two images.

    null_safe=False reproduces the source predicate ``a != b OR ...``:
    a NULL on either side yields NULL (not changed).
    """
    terms = []
    for c in cols:
        a, b = F.col(left + c), F.col(right + c)
        terms.append(~a.eqNullSafe(b) if null_safe else a != b)
    if not terms:
        return F.lit(False)
    return reduce(lambda x, y: x | y, terms)


def changed_keys(target: DataFrame, source: DataFrame, keys, track, null_safe: bool = True) -> DataFrame:
    """Keys present in both whose tracked columns differ (the update test)."""
    keys = list(keys)
    t = _prefixed(target, T, "__t")
    s = _prefixed(source, S, "__s")
    cond = reduce(lambda a, b: a & b, [t[T + k] == s[S + k] for k in keys])
    hit = t.join(s, cond, "inner").filter(changed(track, null_safe=null_safe))
    return hit.select(*[F.col(T + k).alias(k) for k in keys])


def dedupe_latest(df: DataFrame, keys, order_cols) -> DataFrame:
    """Keep one row per key: the greatest by ``order_cols`` (then all columns).

    Implemented as ``max(struct(order..., row...))`` per key, so partial
    aggregation collapses a hot key before the shuffle; ties on the order
    columns resolve on the remaining columns, deterministically. Rows with a
    NULL in the key have no identity to be the latest of: all are kept.
    """
    keys = list(keys)
    loose = df.filter(has_null(keys))
    df = df.filter(~has_null(keys))
    others = [c for c in df.columns if c not in keys]
    order = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order_cols)]
    packed = F.struct(*order, *[F.col(c) for c in others]).alias("__m")
    best = df.groupBy(*keys).agg(F.max(packed).alias("__m"))
    return best.select(*keys, *[F.col(f"__m.{c}").alias(c) for c in others]).select(*df.columns).unionByName(loose)


def has_null(keys) -> Column:
    """True for rows whose key holds a NULL."""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def spread(df: DataFrame, keys) -> Column:
    """0 for rows with a whole key, else a hash of the row: an extra join key."""
    return F.when(has_null(keys), F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("bigint"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys occurring more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_unique(df: DataFrame, keys) -> None:
    """Raise when a key occurs twice (the source errors on such updates)."""
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate source key in merge: {dup[0].asDict()}")


def check_matched_unique(target: DataFrame, source: DataFrame, keys) -> None:
    """Raise when a repeated source key matches a target row.

    The source warehouse's default: a target row joined by several source
    rows makes the update ambiguous and the statement fails; unmatched
    repeated keys are all inserted.
    """
    dup = duplicate_keys(source, keys).join(target.select(*keys), list(keys), "left_semi")
    hit = dup.limit(1).collect()
    if hit:
        raise DuplicateKeyError(f"repeated source key matches a target row: {hit[0].asDict()}")


@dataclass
class MergeResult:
    table: DataFrame
    feed: DataFrame
    rows: DataFrame  # combined single-pass frame with ``_kind``


def _prefixed(df: DataFrame, prefix: str, marker: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns], F.lit(True).alias(marker))


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys,
    *,
    update_cols=None,
    insert_cols=None,
    track=None,
    null_safe: bool = True,
    set_on_update: dict | None = None,
    set_on_insert: dict | None = None,
    surrogate: str | None = None,
    sk_base: int | None = None,
    strategy: str = "shuffle",
    not_older: str | None = None,
) -> DataFrame:
    """Joined, exploded upsert: table rows (``_kind='row'``) and feed rows (``'feed'``).

    keys           business key; plain equality (a NULL key never matches,
                   so such source rows are always inserted, as in the source)
    update_cols    target columns set from the source on update
                   (default: every shared non-key column)
    insert_cols    target columns taken from the source on insert
                   (default: every shared column)
    track          columns compared to decide whether a matched row is
                   updated; None updates every matched row
    null_safe      NULL-safe comparison of ``track`` (False = source ``!=``)
    set_on_update / set_on_insert   column -> expression overriding values
    surrogate      target column filled with a new unique key on insert
    not_older      column by which a matched source row must not be older than
                   the target row, else it changes nothing (a row without a
                   value counts as the oldest)
    """
    keys = list(keys)
    tcols = target.columns
    scols = set(source.columns)
    update_cols = [c for c in tcols if c in scols and c not in keys] if update_cols is None else list(update_cols)
    insert_cols = [c for c in tcols if c in scols] if insert_cols is None else list(insert_cols)
    set_on_update = dict(set_on_update or {})
    set_on_insert = dict(set_on_insert or {})
    ttypes = dict((f.name, f.dataType) for f in target.schema.fields)

    if surrogate and NEW_KEY not in source.columns:
        source = assign_surrogate(source, NEW_KEY, max_key(target, surrogate) if sk_base is None else sk_base)
    # Targets of a NULL key and sources of one must not meet: their hashes differ in sign.
    t = _prefixed(target.withColumn("__n", -F.abs(spread(target, keys))), T, "__t")
    s = _prefixed(source.withColumn("__n", F.abs(spread(source, keys))), S, "__s")
    cond = reduce(lambda a, b: a & b, [t[T + k] == s[S + k] for k in [*keys, "__n"]])

    if strategy in ("auto", "broadcast"):
        matched = t.join(s, cond, "left")
        keys_of = source.select(*[F.col(k).alias(S + k) for k in keys]).dropDuplicates()
        hit = target.select(*[F.col(k).alias(T + k) for k in keys]).join(
            keys_of, [F.col(T + k) == F.col(S + k) for k in keys], "left_semi").dropDuplicates()
        new = s.join(hit, reduce(lambda a, b: a & b, [s[S + k] == hit[T + k] for k in keys]), "left_anti")
        joined = matched.unionByName(new, allowMissingColumns=True)
    elif strategy == "shuffle":
        joined = t.join(s, cond, "full_outer")
    else:
        raise ValueError(f"unknown strategy {strategy!r}")

    t_in, s_in = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    chg = changed(track, null_safe=null_safe) if track is not None else F.lit(True)
    if not_older:
        chg = chg & (F.col(T + not_older).isNull() | F.coalesce(F.col(S + not_older) >= F.col(T + not_older), F.lit(False)))
    op = (
        F.when(~s_in, F.lit("keep"))
        .when(~t_in, F.lit("insert"))
        .when(chg, F.lit("update"))
        .otherwise(F.lit("keep"))
    )
    joined = joined.withColumn("__op", op)

    before, after = [], []
    for c in tcols:
        old = F.col(T + c)
        if c in set_on_update:
            upd = set_on_update[c]
        elif c in update_cols:
            upd = F.col(S + c)
        else:
            upd = old
        if surrogate and c == surrogate:
            ins = F.col(S + NEW_KEY)
        elif c in set_on_insert:
            ins = set_on_insert[c]
        elif c in insert_cols:
            ins = F.col(S + c)
        else:
            ins = F.lit(None)
        new_val = (
            F.when(F.col("__op") == "insert", ins.cast(ttypes[c]))
            .when(F.col("__op") == "update", upd.cast(ttypes[c]))
            .otherwise(old)
        )
        before.append(old.alias(c))
        after.append(new_val.alias(c))

    def image(cols, action, is_update, kind):
        return F.struct(
            *cols,
            F.lit(action).cast("string").alias(ACTION),
            F.lit(is_update).cast("boolean").alias(IS_UPDATE),
            F.lit(kind).alias(KIND),
        )

    row = image(after, None, None, "row")
    ins_feed = image(after, "INSERT", False, "feed")
    del_upd = image(before, "DELETE", True, "feed")
    ins_upd = image(after, "INSERT", True, "feed")
    items = (
        F.when(F.col("__op") == "keep", F.array(row))
        .when(F.col("__op") == "insert", F.array(row, ins_feed))
        .otherwise(F.array(row, del_upd, ins_upd))
    )
    out = joined.select(F.explode(items).alias("__x")).select("__x.*")
    return out


def split_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(table, feed) from a combined merge frame."""
    data_cols = [c for c in rows.columns if c not in (ACTION, IS_UPDATE, KIND)]
    table = rows.filter(F.col(KIND) == "row").select(*data_cols)
    feed = rows.filter(F.col(KIND) == "feed").select(*data_cols, ACTION, IS_UPDATE)
    return table, feed


def upsert(target: DataFrame, source: DataFrame, keys, **kw) -> MergeResult:
    """MERGE source into target on ``keys``; see ``merge_rows`` for options.

    ``on_duplicate``: 'error' raises when a source key repeats; 'matched'
    raises only when a repeated key matches a target row (the source
    warehouse's rule); 'latest' keeps the last version by ``order_cols``;
    'allow' passes them through.
    """
    on_duplicate = kw.pop("on_duplicate", "allow")
    order_cols = kw.pop("order_cols", None)
    if on_duplicate == "latest":
        source = dedupe_latest(source, keys, order_cols or [])
    elif on_duplicate == "error":
        check_unique(source, keys)
    elif on_duplicate == "matched":
        check_matched_unique(target, source, keys)
    rows = merge_rows(target, source, keys, **kw)
    table, feed = split_rows(rows)
    return MergeResult(table=table, feed=feed, rows=rows)
