"""Named consumers of one change feed, each at its own pace.

A consumer's offset is a version of the table whose feed it reads. It is kept
under the consumer's name as a chain of small committed markers
(sources/tables.py), so of two processes that act for one consumer only one can
move it on from a given offset. ``pending`` shows what has come since, netted
per key, without moving; ``advance`` moves past exactly what was shown.

``trim`` removes what nobody needs any more: feeds that every consumer has
taken, and buckets that later versions have replaced. A feed that some consumer
has not read is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.operators.cdc import BATCH, net_changes
from tierflow.operators.merge import KIND
from tierflow.sources.buckets import BUCKET, BucketedTable
from tierflow.sources.tables import SnapshotTable, _fs, path_exists


class Consumer:
    def __init__(self, table: BucketedTable, root: str, name: str, start: int = 0):
        """``start``: the version after which a new consumer begins to read."""
        self.table, self.name, self.start = table, name, start
        self.offsets = SnapshotTable(table.spark, f"{root.rstrip('/')}/{name}")

    def offset(self) -> int:
        return self.offsets.consumed() if self.offsets.exists() else self.start

    def pending(self) -> tuple[DataFrame | None, int]:
        """Net changes since the offset (None if there are none), and the version they lead to."""
        last, head = self.offset(), self.table.version()
        if last >= head:
            return None, head
        rows = self.table.read_versions(last + 1, head).filter(F.col(KIND) == "feed")
        feed = rows.withColumn(BATCH, F.col("v").cast("bigint")).drop("v", KIND, BUCKET)
        return net_changes(feed, self.table.keys), head

    def advance(self, upto: int) -> None:
        """Move past the changes up to a version that ``pending`` named."""
        based_on = self.offsets.version()
        if upto > self.offset():
            said = self.table.spark.createDataFrame([(self.name, int(upto))], "consumer string, upto long")
            self.offsets.write(said, consumed=upto, based_on=based_on)


def trim(table: BucketedTable, consumers: list[Consumer], since: int = 0) -> list[str]:
    """Delete feeds that all consumers have taken and buckets no longer in use; the folders that went.

    Versions up to the smallest offset keep their marker. To be run when no job
    still reads an older version of the table. ``since``: the table was trimmed
    when this was its version, so only what has gone since is looked for.
    """
    head = table.version()
    least = min((c.offset() for c in consumers), default=head)
    kept = {f"v={v:08d}/{KIND}=row/{BUCKET}={b}" for b, v in table.where(head).items()} if head else set()
    gone = []
    versions = {*range(since, head + 1), *table.where(since).values()} if since else range(1, head + 1)
    for version in sorted(versions):
        folder = table.path(version)
        if version <= least and path_exists(table.spark, f"{folder}/{KIND}=feed"):
            gone.append(f"{folder}/{KIND}=feed")
        if version < head and path_exists(table.spark, f"{folder}/{KIND}=row"):
            fs, path, _ = _fs(table.spark, f"{folder}/{KIND}=row")
            names = [s.getPath().getName() for s in fs.listStatus(path)]
            gone += [f"{folder}/{KIND}=row/{n}" for n in names if n.startswith(f"{BUCKET}=") and f"v={version:08d}/{KIND}=row/{n}" not in kept]
    for folder in gone:
        fs, path, _ = _fs(table.spark, folder)
        fs.delete(path, True)
    return gone
