"""MinHash near-duplicate groups by an LSH forest (operator 9).

Documents are sets of word shingles. Those with equal sets form one class, and
only one document of a class goes on. Its MinHash labels make ``TREES`` label
sequences; every tree is one sorted order of all documents by their sequence
(range-partitioned and sorted by Spark). Documents whose sets are alike stand
near each other, because they share a long prefix; how long it must be to tell
them from strangers depends on how crowded the region is, and looking at
neighbours in order, instead of at buckets of a fixed depth, adapts to that.

Rounds of candidates:

1. each document with its next ``NEAREST`` neighbours in each order that pass
   a filter on set sizes, on a bit sketch of the labels and on parities: with
   one bit for each of ``PARITIES`` cells, whether the set has an odd number of
   hashes there, two sets differ in at least as many elements as bits, so too
   many different bits rule a link out without error;
2. after components are known, only for rows that share their first two labels
   with at least ``LEAST_REGION`` others, themselves included (of fewer, round 1
   has seen all): neighbours within a wider window that lie in different
   components. In a dense group nearly all members are joined by then, so the
   work is that of the few which are not, and never all pairs;
3. where more rows than the wide window begin with the same two labels (many
   documents over one template, say), their order says little and the window
   ends too early. Pairs of documents from such regions are left out of the
   second round and joined on rare shingles by prefix and position filters, which
   lose no link: see ``sharing``.

How many rows a region holds is counted over all documents, whatever partitions
they are in. Round 2 sees no pair across the border of two range partitions; such
a pair meets in the other orders.

Every candidate is confirmed on the full shingle sets, in integers. Components
come from star contraction of the links in Spark. No link, component or
fingerprint passes through the driver.

A document with null or empty text, or no words, has an empty set and is linked
with nothing. Equal texts always share a component. Repeated rows with one id
give repeated results. A null id takes no part (component null, kept). An empty
table gives an empty result. Only the id and text columns are read, so others
may have any name.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import arrow_map, mix64, staged, table, text_blocks

TREES = 20
DEPTH = 10
LABELS = TREES * DEPTH
LABEL_BYTES = LABELS // 8
PARITIES = 512
SKETCH_BYTES = LABEL_BYTES + PARITIES // 8
BLOCK_CHARS = 200_000
COUNT_CHARS = 2_000_000
NEAREST = 2
WINDOW = 64
WIDE_WINDOW = 256
LEAST_REGION = 4
#: Lowest estimate from the sketch that still goes to the exact check: 0.8 less about seven standard errors, so that
#: fewer than one in a hundred million links at the threshold are lost by it.
LEAST_ESTIMATE = 0.5
BROADCAST_IDS = 1_000_000
#: Shingles are counted in two rows of cells; their order in prefixes follows the smaller count, then the hash. Any order
#: of the shingles is exact. Whatever the data, the counts are 8 MB in a task and on the driver.
CELLS = 1 << 19
SLICES = 64

BASE = 0x9E3779B97F4A7C15 | 1
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


@functools.lru_cache(maxsize=1)
def constants():
    rng = np.random.default_rng(20240607)
    odd = rng.integers(0, 2**32, LABELS, dtype=np.uint32) | np.uint32(1)
    turn = rng.integers(0, 2**32, LABELS, dtype=np.uint32)
    letters = rng.integers(0, 2**64, 256, dtype=np.uint64)
    blank = np.zeros(256, bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    return odd, turn, letters, blank


@functools.lru_cache(maxsize=1)
def _powers(size: int):
    inverse = pow(BASE, -1, 2**64)
    up, down = np.full(size, BASE, np.uint64), np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(size: int):
    """Powers of the base and of its inverse modulo 2^64; kept for the usual size of a block."""
    usual = 1 << 19
    return _powers(usual) if size <= usual else _powers.__wrapped__(size)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    _, _, letters, blank = constants()
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    raw = np.frombuffer((b"\n".join(parts) + b"\n").translate(LOWER), np.uint8)
    gap = blank[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    up, down = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(letters[raw] * up[:len(raw)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h = mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    owner = np.searchsorted(np.cumsum(sizes + 1), starts, side="right")
    return h, np.bincount(owner, minlength=len(texts))


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each text."""
    h, counts = word_hashes(texts)
    out, at = [], 0
    for n in counts.tolist():
        own = h[at:at + n]
        at += n
        if n == 0:
            out.append(own)
            continue
        k = min(width, n)
        last = n - k + 1
        s = np.full(last, k, np.uint64)
        for j in range(k):
            s = mix64(s * np.uint64(BASE) + own[j:j + last]) if j == k - 1 else s * np.uint64(BASE) + own[j:j + last]
        out.append(np.unique(s))
    return out


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """32-bit minima of the non-empty sets under each of LABELS orders."""
    odd, turn, _, _ = constants()
    h = np.concatenate(sets)
    h = (h ^ (h >> np.uint64(32))).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), LABELS), np.uint32)
    buffer = np.empty_like(h)
    for k in range(LABELS):
        np.bitwise_xor(h, turn[k], out=buffer)
        np.multiply(buffer, odd[k], out=buffer)
        out[:, k] = np.minimum.reduceat(buffer, starts)
    return out


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, digest, labels, sketch); the last three are null for empty sets."""

    def run(batches):
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            sets = shingle_sets(texts, width)
            full = [i for i, s in enumerate(sets) if len(s)]
            digest, labels, sketch = ([None] * len(ids) for _ in range(3))
            if full:
                least = minhash([sets[i] for i in full])
                mixed = least * np.uint32(0x9E3779B1)
                mixed ^= mixed >> np.uint32(15)
                short = (mixed >> np.uint32(16)).astype(">u2")
                odd = np.stack([np.bincount((sets[i] >> np.uint64(55)).astype(np.int64), minlength=PARITIES) & 1 for i in full])
                bits = np.packbits(np.concatenate([(mixed >> np.uint32(7)) & np.uint32(1), odd], axis=1).astype(np.uint8), axis=1)
                for row, i in enumerate(full):
                    digest[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                    labels[i], sketch[i] = short[row].tobytes(), bits[row].tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(labels, pa.binary()), pa.array(sketch, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "labels", "sketch"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run,
                     "doc_id long, n_shingles long, digest binary, labels binary, sketch binary")


def regions(reps: DataFrame) -> DataFrame:
    """(doc_id, trees, crowded) of documents that share two labels with LEAST_REGION or more rows of a tree.

    ``trees`` are those orders; ``crowded`` says that one of the regions holds more rows than the wide window.
    """
    at = [F.substring("labels", tree * 2 * DEPTH + 1, 4) for tree in range(TREES)]
    slim = reps.select("doc_id", F.posexplode(F.array(*at)).alias("tree", "two"))
    counts = staged(slim.groupBy("tree", "two").agg(F.count("*").alias("rows")).filter(F.col("rows") >= LEAST_REGION), "neardup-regions")
    members = slim.join(counts, ["tree", "two"]).groupBy("doc_id").agg(
        F.collect_set("tree").alias("trees"), (F.max("rows") > WIDE_WINDOW).alias("crowded"))
    return staged(members, "neardup-members")


def neighbours(rows: DataFrame, window: int, nearest: int | None) -> DataFrame:
    """(a, b) with a < b: likely pairs of documents near each other in some tree.

    ``rows``: doc_id, n, labels, sketch, part, trees, crowded. Only the orders in
    ``trees`` are looked at (null: all). Pairs of the same part (a component, or
    null) and of two crowded documents are left out. ``nearest``: how many passing
    successors a document takes in each tree; None takes all within the window.
    """
    key = "tree int, key binary, doc_id long, n long, sketch binary, part long, crowded boolean"

    def plant(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            labels, trees = batch.column(2).to_pylist(), batch.column(5).to_pylist()
            for tree in range(TREES):
                at = tree * 2 * DEPTH
                own = [i for i, t in enumerate(trees) if t is None or tree in t]
                if not own:
                    continue
                part = batch.take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), tree, np.int32)), pa.array([labels[i][at:at + 2 * DEPTH] for i in own], pa.binary()),
                     part.column(0), part.column(1), part.column(3), part.column(4), part.column(6)],
                    names=["tree", "key", "doc_id", "n", "sketch", "part", "crowded"])

    def walk(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            for at in range(0, batch.num_rows, 20_000):
                b = batch.slice(at, 20_000)
                now = (np.array(b.column(0)), np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, 2 * DEPTH),
                       np.array(b.column(2)), np.array(b.column(3)),
                       np.frombuffer(b"".join(b.column(4).to_pylist()), np.uint8).reshape(-1, SKETCH_BYTES),
                       np.array([-1 - i if p is None else p for i, p in enumerate(b.column(5).to_pylist())], np.int64),
                       np.array(b.column(6).to_pylist(), bool))
                fresh = 0
                if held is not None:
                    fresh = len(held[0][0])
                    now = tuple(np.concatenate([x, y]) for x, y in zip(held[0], now))
                taken = np.zeros(len(now[0]), np.int64)
                if held is not None:
                    taken[:fresh] = held[1]
                a, c = pairs(now, taken, fresh, window, nearest)
                held = (tuple(x[-window:] for x in now), taken[-window:])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, c)), pa.array(np.maximum(a, c))], names=["a", "b"])

    planted = arrow_map(rows.select("doc_id", "n", "labels", "sketch", "part", "trees", "crowded"), plant, key)
    ordered = planted.repartitionByRange("tree", "key", "doc_id").sortWithinPartitions("tree", "key", "doc_id")
    return arrow_map(ordered, walk, "a long, b long").distinct()


def pairs(rows, taken, fresh, window, nearest):
    """Passing pairs (i, i + step) of sorted rows, not both crowded; the first ``fresh`` rows were there before."""
    tree, key, ids, n, sketch, part, full = rows
    size = len(ids)
    same = (tree[1:] == tree[:-1]) & (key[1:, 0] == key[:-1, 0]) & (key[1:, 1] == key[:-1, 1])
    shared = same.copy()  # rows i and i + step have at least the first label in common
    left, right = [], []
    for step in range(1, min(window, size - 1) + 1):
        if step > 1:
            shared = shared[:-1] & same[step - 1:]
        at = np.flatnonzero(shared)
        at = at[at + step >= fresh]
        if nearest is not None:
            at = at[taken[at] < nearest]
        if not len(at):
            if not shared.any():
                break
            continue
        to = at + step
        ok = (part[at] != part[to]) & (ids[at] != ids[to]) & ~(full[at] & full[to])
        ok &= 5 * np.minimum(n[at], n[to]) >= 4 * np.maximum(n[at], n[to])
        at, to = at[ok], to[ok]
        if not len(at):
            continue
        differ = np.bitwise_count(sketch[at] ^ sketch[to])
        ok = 1 - 2 * differ[:, :LABEL_BYTES].sum(1) / LABELS >= LEAST_ESTIMATE
        # 100 * both >= 80 * either means that at most a ninth of all elements differ.
        ok &= 9 * differ[:, LABEL_BYTES:].sum(1, dtype=np.int64) <= n[at] + n[to]
        at, to = at[ok], to[ok]
        taken[at] += 1
        left.append(ids[at])
        right.append(ids[to])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def cells(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each shingle in both rows: two ranges of bits of its hash."""
    return (shingles >> np.uint64(45)).astype(np.int64), (shingles >> np.uint64(26)).astype(np.int64) & (CELLS - 1)


def sharing(docs: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """(a, b) with a < b: every pair of ``rows`` (doc_id, part) in different parts that can be linked.

    All shingles have one order, rare ones first. A link of sets of n and m <= n
    elements shares at least 4/9 (n + m), so its first common shingle stands at a
    place i of the larger and j of the smaller one with
    9 min(n - i, m - j) >= 4 (n + m); hence 5 i <= n and 9 j <= m. Only those
    places are joined. Documents over one template that are not links have more
    than a ninth of their own, and do not meet on the template's shingles.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(rows, "doc_id")
    texts = staged(texts.dropDuplicates(["doc_id"]).select(F.struct("doc_id", "part").alias("id"), "text"), "neardup-crowded")

    def spread(batches):
        # What a task says of its shingles is bounded: its cells, packed into one row for each slice.
        seen = np.zeros((2, CELLS), np.int64)
        for _, block in text_blocks(batches, COUNT_CHARS):
            for counts, at in zip(seen, cells(np.concatenate(shingle_sets(block, width)))):
                counts += np.bincount(at, minlength=CELLS)
        for k, part in enumerate(seen.reshape(SLICES, -1)):
            at = np.flatnonzero(part)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([at.astype(np.int32).tobytes()], pa.binary()), pa.array([part[at].tobytes()], pa.binary())],
                    names=["slice", "at", "n"])

    def total(key, part):
        whole = np.zeros(2 * CELLS // SLICES, np.int64)
        for at, n in zip(part.column("at").to_pylist(), part.column("n").to_pylist()):
            whole[np.frombuffer(at, np.int32)] += np.frombuffer(n, np.int64)
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([whole.tobytes()], pa.binary())})

    slices = arrow_map(texts, spread, "slice int, at binary, n binary").groupBy("slice").applyInArrow(total, "slice int, n binary").collect()
    counts = np.zeros((SLICES, 2 * CELLS // SLICES), np.int64)
    for r in slices:
        counts[r["slice"]] = np.frombuffer(r["n"], np.int64)
    shared = spark.sparkContext.broadcast(counts.reshape(2, CELLS))

    def prefixes(batches):
        counts = shared.value
        for ids, block in text_blocks(batches, BLOCK_CHARS):
            out = []
            for i, s in zip(ids, shingle_sets(block, width)):
                rank = np.minimum(*(n[at] for n, at in zip(counts, cells(s))))
                first = s[np.lexsort((s, rank))][:len(s) // 5 + 1].view(np.int64)
                of = np.ones(len(first), np.int64)
                out.append((first, np.arange(len(first)), of * len(s), of * i["doc_id"], of * i["part"]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["token", "place", "n", "doc_id", "part"])

    entries = staged(arrow_map(texts, prefixes, "token long, place long, n long, doc_id long, part long"), "neardup-prefixes")
    # A shingle that only one component has makes no pair.
    mixed = entries.groupBy("token").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo != hi").select("token")
    entries = staged(entries.join(mixed, "token", "left_semi"), "neardup-mixed")
    larger, smaller = entries.alias("x"), entries.filter("9 * place <= n").alias("y")
    met = larger.join(smaller, F.expr("""x.token = y.token and x.part != y.part
        and (x.n > y.n or x.n = y.n and x.doc_id > y.doc_id) and 5 * y.n >= 4 * x.n
        and 9 * least(x.n - x.place, y.n - y.place) >= 4 * (x.n + y.n)"""))
    return met.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct()


def confirmed(docs: DataFrame, candidates: DataFrame, width: int) -> DataFrame:
    """The candidates whose full shingle sets are at least 0.8 alike."""
    ids = staged(candidates.select(F.col("a").alias("doc_id")).union(candidates.select("b")).distinct(), "neardup-ids")
    n = ids.count()
    wanted = F.broadcast(ids) if n <= BROADCAST_IDS else ids  # 8 MB at most; beyond, Spark chooses
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
    texts = staged(texts.dropDuplicates(["doc_id"]), "neardup-texts")
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    both = candidates.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")

    def run(batches):
        last, own = None, None
        for batch in batches:
            keep = []
            for a, text_a, text_b in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if a != last:
                    last, own = a, shingle_sets([text_a], width)[0]
                other = shingle_sets([text_b], width)[0]
                shared = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(100 * shared >= 80 * (len(own) + len(other) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return arrow_map(both, run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, part): the smallest id that each linked document reaches, by star contraction."""
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "neardup-edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Every larger neighbour is tied to the smallest one around.
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")),
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("e")).select("e.*").filter("u != v").distinct()
        edges = staged(small, "neardup-edges")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if (state["n"], state["h"]) == seen:
            return edges.groupBy(F.col("u").alias("doc_id")).agg(F.min("v").alias("part"))
        seen = (state["n"], state["h"])


def groups(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    every = staged(signatures(docs, width), "neardup-signatures")
    classes = every.filter("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = staged(classes, "neardup-classes")
    reps = every.join(classes, (every.digest == classes.digest) & (every.doc_id == classes.rep)).select(
        "doc_id", F.col("n_shingles").alias("n"), "labels", "sketch", every.digest)
    reps = staged(reps.dropDuplicates(["doc_id"]), "neardup-reps")
    every_tree = {"part": F.lit(None).cast("long"), "trees": F.lit(None).cast("array<int>"), "crowded": F.lit(False)}
    first = staged(neighbours(reps.withColumns(every_tree), WINDOW, NEAREST), "neardup-near")
    links = staged(confirmed(docs, first, width), "neardup-links")
    parts = staged(components(links), "neardup-parts")
    members = regions(reps)
    # Who is in no component yet is one of its own.
    own = reps.join(members, "doc_id").join(parts, "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id"))
    second = staged(neighbours(own, WIDE_WINDOW, None).join(first, ["a", "b"], "left_anti"), "neardup-second")
    full = members.filter("crowded").select("doc_id")
    some = not full.isEmpty()
    links = links.union(confirmed(docs, second, width))
    parts = staged(components(links), "neardup-parts")
    if some:
        rows = staged(full.join(parts, "doc_id", "left").withColumn("part", F.coalesce("part", "doc_id")), "neardup-full")
        third = staged(sharing(docs, rows, width).join(first, ["a", "b"], "left_anti"), "neardup-third")
        new = staged(confirmed(docs, third, width), "neardup-links")
        parts = staged(components(parts.filter("doc_id != part").toDF("a", "b").union(new)), "neardup-parts")
    final = classes.join(parts, classes.rep == parts.doc_id, "left").select("digest", F.coalesce("part", "rep").alias("component_id"))
    return (every.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(final, "digest", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"), width=4)
