"""Hash keys and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.session import unique_scratch

NULL_MARK = "\\N"     # the CSV null marker; cannot occur as data in a load
SEPARATOR = "\x1f"    # ASCII unit separator


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def digest_reference(cols) -> Column:
    """SHA-1 hex of the plain concatenation, as the source computes it.

    NULL if any part is NULL, and no separator (``'ab','c'`` equals
    ``'a','bc'``): kept for comparison with the source, not for new keys.
    """
    return F.sha1(F.concat(*[c.cast("string") for c in _cols(cols)]))


def digest_sound(cols) -> Column:
    """SHA-1 hex over separated parts with an explicit NULL marker."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in _cols(cols)]
    return F.sha1(F.concat_ws(SEPARATOR, *parts))


def hash_key(cols, sound: bool = True) -> Column:
    """64-bit dimension key: xxhash64 over the SHA-1 hex digest.

    The source uses its own 64-bit HASH over the same digest, so the 64-bit
    values differ from the source's; the digest itself is standard SHA-1.
    """
    digest = digest_sound(cols) if sound else digest_reference(cols)
    return F.xxhash64(digest)


def max_key(df: DataFrame, col: str) -> int:
    """Largest existing surrogate key (0 for an empty table): one scalar."""
    row = df.agg(F.max(col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


#: monotonically_increasing_id() puts the partition above, the row's number in it below.
ROW_BITS = 33


ROW_ID = "__row_id"


def with_row_id(df: DataFrame) -> DataFrame:
    """``df`` with the place of each row in the job that writes it."""
    return df.withColumn(ROW_ID, F.monotonically_increasing_id())


def numbered(rows: DataFrame, col: str, base: int = 0) -> DataFrame:
    """Keys ``base + 1 … base + rows`` for a written table that holds ``with_row_id``'s column.

    A count per partition (one row for each task of that write) gives the offset
    from which a partition's numbers run. No row is sorted, and keys are a function
    of the written rows, so a task that is repeated gives the same ones.
    """
    part = F.shiftright(ROW_ID, ROW_BITS)
    counts = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__from"))
    number = F.col("__from") + F.col(ROW_ID).bitwiseAND((1 << ROW_BITS) - 1) + 1
    cols = [c for c in rows.columns if c not in (col, ROW_ID)]
    return (rows.join(F.broadcast(offsets), part == F.col("__part"))
            .withColumn(col, (F.lit(base) + number).cast("bigint")).select(*cols, col))


def assign_surrogate(df: DataFrame, col: str, base: int = 0) -> DataFrame:
    """Unique keys ``base + 1 … base + rows``, in two passes: rows are written, then numbered."""
    path = unique_scratch(df.sparkSession, "keys")
    rows = with_row_id(df)
    rows.write.parquet(path)
    return numbered(df.sparkSession.read.schema(rows.schema).parquet(path), col, base)
