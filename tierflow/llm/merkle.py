"""Merkle manifest of a dataset with incremental witnesses (operator 13).

Each document is a leaf (SHA-256 over its fields with their lengths). Leaves of
a source ascend by id; runs of ``FAN`` nodes become their hash until one is
left, the subroot; subroots, ordered by source, likewise give the root.

The tree is built by streaming aligned append: ``OpenSubtrees`` takes one digest
after the other, keeps the open run of each level, and when a run closes hands
each of its members the siblings of that level, so that witnesses grow as
subtrees close. One stream covers an aligned block of ``FAN ** HEIGHT`` leaves,
so a source of any size is many blocks in many tasks. The roots of the blocks
are appended in the same way to streams of their own, round by round, until
each source has one node; the subroots are appended to one more tree. On the way
back the witness of a block root is attached to what its members gather inside
the block.

Positions come from a range partitioning by (source, id, leaf): rows are counted
in stream order within each partition, and only the first source of a partition
can have begun in earlier ones, so one offset per partition is all that is
joined (a table as long as the number of partitions).

``appended`` extends a manifest by documents that come after the present ones of
their sources: full blocks are taken over, only the open block of each source
that grew is streamed again.

Null fields count as ``-``. Null ids come first in their source, null sources
before all others. Rows that repeat an id are leaves of their own, ordered by
leaf digest (equal rows are interchangeable). A lone leaf is its subroot, a lone
subroot the root. An empty table gives an empty result. Other columns are not
read, so they may have any name.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tierflow.llm.common import arrow_map, staged, table

FAN = 16
#: Levels that one stream closes: blocks of 4,096 nodes, a few megabytes of witnesses in a task.
HEIGHT = 3
BLOCK = FAN ** HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of one range partition while positions are counted.
RANGE_ROWS = 200_000


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class OpenSubtrees:
    """Appends nodes from left to right and completes their witnesses as runs close.

    A node is [digest, parent or None, siblings to the left, siblings to the right];
    the last three are filled in when the run that holds it closes. ``whole`` says
    that the stream holds all nodes of its tree (it then ends at one node); otherwise
    it is an aligned block of a larger one and closes exactly ``HEIGHT`` levels.
    """

    def __init__(self):
        self.open = [[] for _ in range(HEIGHT + 1)]
        self.count = [0] * (HEIGHT + 1)

    def append(self, value: str, level: int = 0) -> list:
        node = [value, None, "", ""]
        self.open[level].append(node)
        self.count[level] += 1
        if level < HEIGHT and len(self.open[level]) == FAN:
            self.close(level)
        return node

    def close(self, level: int) -> None:
        run = self.open[level]
        values = [n[0] for n in run]
        self.open[level] = []
        parent = self.append(digest("".join(values)), level + 1)
        for i, node in enumerate(run):
            node[1:] = parent, "".join(values[:i]), "".join(values[i + 1:])

    def finish(self, whole: bool) -> str:
        """Close what is open; the root of the stream."""
        for level in range(HEIGHT):
            if whole and self.count[level] == 1:
                return self.open[level][0][0]
            if self.open[level]:
                self.close(level)
        return self.open[HEIGHT][0][0]


def witness(node: list) -> str:
    """Siblings of a node inside its stream: ``left,right;`` for each level."""
    out = []
    while node[1] is not None:
        out.append(f"{node[2]},{node[3]};")
        node = node[1]
    return "".join(out)


def folded(leaf: str, path: str) -> str:
    """The root that a leaf and its witness lead to."""
    for level in path.split(";")[:-1]:
        left, _, right = level.partition(",")
        leaf = digest(left + leaf + right)
    return leaf


def proof(path: str) -> str:
    return digest(path.replace(",", "").replace(";", ""))


def leaf_of(text) -> F.Column:
    """Digest of the fields of a document, with another text if wanted."""
    def part(value):
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(text if name == "text" else F.col(name)) for name in FIELDS]), 256)


def positioned(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``pos``: the place of each row in its group (from 0), by ``order``, nulls first.

    ``rows`` has to be a table read from files. Rows that are equal in all
    columns named are spread by their place in the files.
    """
    spark = rows.sparkSession
    n = max(1, -(-rows.count() // RANGE_ROWS), min(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    keys = [group, *order, "__tie"]
    ranged = (rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(n, *keys)
              .sortWithinPartitions(*keys).drop("__tie").withColumn("__part", F.spark_partition_id()))
    at = ranged.columns.index(group)

    def run(batches):
        before, seen = None, -1
        for batch in batches:
            places = []
            for value in batch.column(at).to_pylist():
                seen = seen + 1 if seen >= 0 and value == before else 0
                before = value
                places.append(seen)
            names = [*batch.schema.names, "__index"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=names)

    out = StructType([*ranged.schema.fields, StructField("__index", LongType())])
    counted = staged(arrow_map(ranged, run, out), "merkle-positions")
    # At most two rows for each partition: its first and its last group.
    place = F.struct(F.col(group).isNotNull(), F.col(group))
    spans = counted.groupBy("__part").agg(F.min(place).alias("low"), F.max(place).alias("high")).withColumnRenamed("__part", "__p")
    edges = (counted.groupBy("__part", group).agg(F.count("*").alias("n")).join(spans, F.col("__part") == F.col("__p"))
             .filter((place == F.col("low")) | (place == F.col("high"))).select("__part", group, "n"))
    later = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (edges.withColumn("offset", F.coalesce(F.sum("n").over(later), F.lit(0)))
               .filter("offset > 0").select("__part", F.col(group).alias("__group"), "offset"))
    joined = counted.alias("c").join(F.broadcast(offsets.withColumnRenamed("__part", "__p")),
                                     (F.col("c.__part") == F.col("__p")) & F.col(f"c.{group}").eqNullSafe(F.col("__group")), "left")
    return joined.select(*[f"c.{c}" for c in rows.columns], (F.col("__index") + F.coalesce("offset", F.lit(0))).alias("pos"))


def blocks_of(nodes: DataFrame) -> DataFrame:
    """Rows (grp, pos, digest, …) dealt by aligned block and in stream order."""
    keyed = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
    return keyed.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")


def block_roots(nodes: DataFrame) -> DataFrame:
    """(grp, pos, digest): the roots of aligned blocks, to be appended to the next round."""
    rows = blocks_of(nodes).select("grp", "block", "digest")

    def run(batches):
        key, tree, out = None, None, ([], [], [])

        def end():
            for column, value in zip(out, (*key, tree.finish(key[1] == 0))):
                column.append(value)

        for batch in batches:
            for group, block, value in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (group, block):
                    if tree:
                        end()
                    key, tree = (group, block), OpenSubtrees()
                tree.append(value)
            if len(out[0]) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.string()))], names=["grp", "pos", "digest"])
                out = ([], [], [])
        if tree:
            end()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.int64(), pa.string()))], names=["grp", "pos", "digest"])

    return arrow_map(rows, run, "grp string, pos long, digest string")


def block_witnesses(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """(grp, pos, path): witnesses of the nodes; ``above`` has those of the block roots, by (grp, pos)."""
    rows = (nodes.select("grp", "pos", "digest", F.lit(None).cast("string").alias("path"))
            .withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long")))
    heads = above.select("grp", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"), "path", F.col("pos").alias("block"))
    dealt = (rows.unionByName(heads).repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
             .select("grp", "block", "pos", "digest", "path"))

    def run(batches):
        for (group, _), upper, members in streams(batches, 3):
            paths = [witness(node) + upper for node, _ in members]
            yield pa.RecordBatch.from_arrays([pa.array([group] * len(members), pa.string()), pa.array([r[0] for _, r in members], pa.int64()),
                                              pa.array(paths, pa.string())], names=["grp", "pos", "path"])

    return arrow_map(dealt, run, "grp string, pos long, path string")


def streams(batches, width: int):
    """One ((grp, block), path of the block's root, [(node, (pos, …))]) for each block.

    Columns are grp, block, pos, digest, …, path; the row at place -1 comes first
    and brings the path. A block is the only thing held.
    """
    key, upper, tree, members = None, "", None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if key != row[:2]:
                if members:
                    tree.finish(key[1] == 0)
                    yield key, upper, members
                key, upper, tree, members = row[:2], "", OpenSubtrees(), []
            if row[2] < 0:
                upper = row[-1]
            else:
                members.append((tree.append(row[3]), row[2:-1]))
    if members:
        tree.finish(key[1] == 0)
        yield key, upper, members


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Append block roots round by round until each group has one node.

    Returns the nodes of each round (first the given ones) and (grp, digest) of
    the last. Rounds are the logarithm of the largest group to base 4,096.
    """
    rounds = [nodes]
    while True:
        roots = staged(block_roots(rounds[-1]), "merkle-roots")
        if (roots.agg(F.max("pos")).first()[0] or 0) == 0:
            return rounds, roots.select("grp", "digest")
        rounds.append(roots)


def descend(rounds: list[DataFrame], path: DataFrame) -> DataFrame:
    """(grp, pos, path) of the block roots of the first round, from (grp, path) of the groups' last nodes."""
    above = path.select("grp", F.lit(0).cast("long").alias("pos"), "path")
    for nodes in reversed(rounds[1:]):
        above = staged(block_witnesses(nodes, above), "merkle-paths")
    return above


def leaves(docs: DataFrame, group: str = "source", key: str = "doc_id") -> DataFrame:
    """(grp, id, digest, tampered): ``tampered`` only where every fifth id lower-cases its text."""
    text = F.col("text")
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0
    return docs.select(F.col(group).cast("string").alias("grp"), F.col(key).cast("long").alias("id"), leaf_of(text).alias("digest"),
                       F.when(chosen, leaf_of(lowered)).alias("tampered"))


def manifest(rows: DataFrame) -> dict:
    """Tree over staged leaves (grp, id, digest, …): placed leaves, rounds, subroots, top tree, root."""
    placed = staged(positioned(rows, "grp", ["id", "digest"]), "merkle-leaves")
    return grown(placed, *climb(placed))


def grown(placed: DataFrame, rounds: list[DataFrame], subroots: DataFrame) -> dict:
    named = staged(subroots.withColumn("one", F.lit("")), "merkle-subroots")
    order = positioned(named, "one", ["grp"])
    top = staged(order.select(F.col("one").alias("grp"), "pos", "digest", F.col("grp").alias("source")), "merkle-top")
    top_rounds, root = climb(top.select("grp", "pos", "digest"))
    found = root.first()
    return {"leaves": placed, "rounds": rounds, "top": top, "top_rounds": top_rounds, "root": found["digest"] if found else None}


def appended(tree: dict, rows: DataFrame) -> dict:
    """The manifest after streaming append of further leaves (grp, id, digest, …).

    New leaves have to come after the present ones of their source (a smaller id
    is an error). Roots of full blocks are taken over; the open block of a source
    that grew is streamed again, and the rounds above, 1/4,096 of the rows, are rebuilt.
    """
    old = tree["leaves"]
    fresh = staged(positioned(rows, "grp", ["id", "digest"]), "merkle-fresh")
    state = old.groupBy("grp").agg(F.count("*").alias("have"), F.max(F.struct(F.col("id").isNotNull(), "id")).alias("last"))
    state = staged(state.withColumnsRenamed({"grp": "__g"}), "merkle-state")
    joined = fresh.join(state, F.col("grp").eqNullSafe(F.col("__g")), "left")
    if not joined.filter(F.struct(F.col("id").isNotNull(), "id") < F.col("last")).isEmpty():
        raise ValueError("appended leaves must come after the present ones of their source")
    moved = staged(joined.withColumn("pos", F.col("pos") + F.coalesce("have", F.lit(0))).select(*old.columns), "merkle-moved")
    placed = old.unionByName(moved)
    # Blocks that are open before the append: the last one of each source that grew.
    touched = state.join(moved.select(F.col("grp").alias("__n")).distinct(), F.col("__g").eqNullSafe(F.col("__n")), "left_semi")
    touched = touched.select("__g", F.floor(F.col("have") / BLOCK).alias("__from"))
    open_rows = old.join(touched, F.col("grp").eqNullSafe(F.col("__g")) & (F.col("pos") >= F.col("__from") * BLOCK), "left_semi")
    again = block_roots(open_rows.select("grp", "pos", "digest").unionByName(moved.select("grp", "pos", "digest")))
    before = tree["rounds"][1] if len(tree["rounds"]) > 1 else block_roots(old.select("grp", "pos", "digest"))
    kept = before.join(touched, F.col("grp").eqNullSafe(F.col("__g")) & (F.col("pos") >= F.col("__from")), "left_anti")
    roots = staged(kept.select("grp", "pos", "digest").unionByName(again), "merkle-roots")
    if (roots.agg(F.max("pos")).first()[0] or 0) == 0:
        return grown(placed, [placed], roots.select("grp", "digest"))
    rounds, subroots = climb(roots)
    return grown(placed, [placed, *rounds], subroots)


def witnessed(tree: dict) -> DataFrame:
    """One row per leaf: id, leaf, subroot, root, proof and what its witness folds to."""
    placed, root = tree["leaves"], tree["root"]
    one = tree["top"].limit(1).select("grp", F.lit("").alias("path"))
    heads = descend(tree["top_rounds"], one)
    tops = staged(block_witnesses(tree["top"].select("grp", "pos", "digest"), heads), "merkle-top-paths")
    groups = staged(tree["top"].join(tops.drop("grp"), "pos").select(F.col("source").alias("grp"), "path", F.col("digest").alias("subroot")), "merkle-group-paths")
    above = descend(tree["rounds"], groups.select("grp", "path"))
    above = above.alias("a").join(groups.alias("g"), F.col("a.grp").eqNullSafe(F.col("g.grp"))).select(
        "a.grp", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("id"),
        F.lit(None).cast("string").alias("tampered"), F.concat("g.subroot", F.lit("|"), "a.path").alias("path"), F.col("a.pos").alias("block"))
    rows = placed.select("grp", "pos", "digest", "id", "tampered", F.lit(None).cast("string").alias("path"),
                         F.floor(F.col("pos") / BLOCK).cast("long").alias("block"))
    dealt = (rows.unionByName(above).repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
             .select("grp", "block", "pos", "digest", "id", "tampered", "path"))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(batches):
        for _, head, members in streams(batches, 5):
            subroot, _, upper = head.partition("|")
            out = []
            for node, (_, leaf, key, tampered) in members:
                path = witness(node) + upper
                back = folded(tampered or leaf, path)
                out.append((key, leaf, subroot, root, proof(path), back, back == root))
            types = (pa.int64(), *[pa.string()] * 5, pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return arrow_map(dealt, run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(leaves(table(spark, sf_dir, "documents")), "merkle-hashed")
    return witnessed(manifest(rows))


def oracle(levels: int = 5, top_levels: int = 2) -> str:
    """DuckDB SQL for the same rows, for sources of up to 16 ** levels documents."""
    def part(column):
        return f"coalesce(strlen({column}::varchar) || ':' || {column}::varchar, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(part(text if c == "text" else c) for c in FIELDS) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = ["""crc_table as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
      lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as t)""",
           f"""base as (select doc_id, source, {leaf('text')} as leaf, {leaf(lowered)} as lowered,
      xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(doc_id::varchar) + 1), lambda i: ascii(substr(doc_id::varchar, i, 1))::bigint)),
        lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 as chosen from documents, crc_table)""",
           """n0 as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos from base)""",
           "l0 as (select source, pos, leaf as h from n0)"]

    def climb_sql(name, group, count):
        rows, keys = [], f"{group}, " if group else ""
        parent = "case when nodes > 1 then pos // 16 else pos end"
        for i in range(count):
            beside = [f"""coalesce(case when nodes > 1 then string_agg(h, '') over (partition by {keys}pos // 16 order by pos
      rows between {span}) end, '') as {side}""" for side, span in (("lft", "unbounded preceding and 1 preceding"), ("rgt", "1 following and unbounded following"))]
            rows.append(f"{name}c{i} as (select *, count(*) over ({f'partition by {group}' if group else ''}) as nodes from {name}{i})")
            rows.append(f"""{name}{i + 1} as (select {keys}{parent} as pos,
      case when any_value(nodes) > 1 then sha256(string_agg(h, '' order by pos)) else any_value(h) end as h from {name}c{i} group by {keys}{parent})""")
            rows.append(f"{name}s{i} as (select {keys}pos, nodes, {', '.join(beside)} from {name}c{i})")
        return rows

    out += climb_sql("l", "source", levels)
    out.append(f"t0 as (select source, row_number() over (order by source nulls first) - 1 as pos, h from l{levels})")
    out += climb_sql("t", "", top_levels)
    # Walk from each leaf to the root: place at each level, siblings, folded digest.
    out.append("w0 as (select *, pos as place, case when chosen then lowered else leaf end as back, '' as path from n0)")
    for i in range(levels):
        out.append(f"""w{i + 1} as (select w.* replace (case when s.nodes > 1 then place // 16 else place end as place, path || lft || rgt as path,
      case when s.nodes > 1 then sha256(lft || back || rgt) else back end as back)
      from w{i} w join ls{i} s on w.source is not distinct from s.source and w.place = s.pos)""")
    out.append(f"x0 as (select w.* replace (t.pos as place), t.h as subroot from w{levels} w join t0 t on w.source is not distinct from t.source)")
    for i in range(top_levels):
        out.append(f"""x{i + 1} as (select w.* replace (case when s.nodes > 1 then place // 16 else place end as place, path || lft || rgt as path,
      case when s.nodes > 1 then sha256(lft || back || rgt) else back end as back) from x{i} w join ts{i} s on w.place = s.pos)""")
    body = ",\n".join(out)
    return f"""with {body}
select doc_id, leaf, subroot, r.h as root, sha256(path) as proof_sha256, back as folded_root, back = r.h as verified
from x{top_levels}, t{top_levels} r"""


ORACLE = oracle()
