"""Groups of spelling variants by k-d trees over letter counts (operator 12).

Two words are near if one inserted, deleted or replaced code point makes one
the other. An edit changes the vector of letter counts little: a replacement
adds one and takes one away, an insertion adds one. So the near words of a word
lie in a small box around its vector, among the words of its own length and of
the next one (a shorter partner finds the longer one). For each of these length
pairs a range search goes down the k-d tree of that length, leaves out every box
that would take more than one added (or removed) letter to reach, and the order
of the letters is verified on what remains.

The trees are distributed: their upper levels, fitted on a bounded sample of
words (``SAMPLE_WORDS``; it decides only where the borders lie), deal all words
out into cells. A word lives in one cell and asks in every cell whose region it
can reach, so no link is lost whatever the sample. Below, each task builds the
tree of a cell with tight boxes. A cell that holds more than ``CELL_WORDS``
words or ``CELL_CHARS`` characters (many words of equal letters, say) is split
into chunks by the hash of the word, and questions go to each chunk. Tasks return
counts and the best partner of each word, not pairs.

Words and their counts are made by built-in functions, counted map-side. The
root of a word is found by pointer jumping: counts at least double along the
forms, so chains are short and a few rounds of joins do.

Null texts have no words; a null id counts as an empty one in the checksum.
Repeated rows count as often as they occur. Ties between partners of equal count
go to the first in code-point order. Vectors fold letters other than a to z into
six counters and stop counting at 100, which only widens the search. An empty
table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import arrow_map, gather_ranges, staged, table

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ONE_IN = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
FOLDED, MOST_OF_ONE = 6, 100
DIMS = 26 + FOLDED
SAMPLE_WORDS = 100_000
CELL_WORDS, CELL_CHARS = 8192, 4_000_000
#: Cells of all trees at most; beyond that, cells grow and are split into chunks.
MOST_CELLS = 16_384
LEAF = 16
BATCH_WORDS = 2048
PAIR_CHARS = 8_000_000


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_in: int = ONE_IN) -> DataFrame:
    """(word, n): lower-cased runs, one in ``one_in`` of a document's with a letter left out, and their counts."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text_col, F.lit(RUN), 0)).alias("run")).filter(F.char_length("run") >= LEAST_LENGTH)
    lowered = runs.select("id", F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    hashed = lowered.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.expr("int(h % char_length(run))")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("run"))
    return (hashed.select(word.alias("word")).filter(F.char_length("word") >= LEAST_LENGTH)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT))


def letters(listed: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(listed).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(listed), length)


def vectors(points: np.ndarray) -> np.ndarray:
    """Letter counts of each row of code points."""
    dim = np.where((points >= 97) & (points <= 122), points - 97, 26 + points % FOLDED).astype(np.int64)
    flat = np.bincount((np.arange(len(points))[:, None] * DIMS + dim).ravel(), minlength=len(points) * DIMS)
    return np.minimum(flat, MOST_OF_ONE).astype(np.int16).reshape(len(points), DIMS)


class Tree:
    """K-d tree over integer vectors: cuts, boxes of the nodes, and the rows of each leaf.

    ``tight`` boxes enclose the vectors given; otherwise boxes are the regions
    between the cuts, and hold for any vector.
    """

    def __init__(self, rows: np.ndarray, leaf: int, tight: bool):
        self.dim, self.cut, self.child, self.low, self.high, self.first, self.size = [], [], [], [], [], [], []
        self.order = np.arange(len(rows))
        self.rows, self.leaf, self.tight = rows, leaf, tight
        everything = np.full(DIMS, 2 * MOST_OF_ONE, np.int16)
        todo = [(0, len(rows), -everything, everything, None)]
        while todo:
            start, end, low, high, parent = todo.pop()
            node = len(self.dim)
            if parent is not None:
                self.child[parent[0]][parent[1]] = node
            part = self.rows[self.order[start:end]]
            if tight:
                low, high = part.min(0), part.max(0)
            dim, cut = self.split(part)
            for column, value in zip((self.dim, self.cut, self.child, self.low, self.high, self.first, self.size), (dim, cut, [-1, -1], low, high, start, end - start)):
                column.append(value)
            if dim < 0:
                continue
            left = part[:, dim] <= cut
            here = self.order[start:end]
            self.order[start:end] = np.concatenate([here[left], here[~left]])
            middle = start + int(left.sum())
            low_high, high_low = high.copy(), low.copy()
            low_high[dim], high_low[dim] = cut, cut + 1
            todo += [(start, middle, low, low_high, (node, 0)), (middle, end, high_low, high, (node, 1))]
        self.dim, self.cut, self.child = np.array(self.dim), np.array(self.cut, np.int16), np.array(self.child)
        self.low, self.high = np.array(self.low, np.int16).reshape(-1, DIMS), np.array(self.high, np.int16).reshape(-1, DIMS)
        self.first, self.size = np.array(self.first), np.array(self.size)

    def split(self, part: np.ndarray) -> tuple[int, int]:
        """Dimension and cut that halve the rows best, or (-1, 0) for a leaf."""
        if len(part) <= self.leaf:
            return -1, 0
        spread = part.std(0)
        dim = int(spread.argmax())
        if spread[dim] == 0:
            return -1, 0
        values = part[:, dim]
        middle = int(np.sort(values)[(len(values) - 1) // 2])
        return dim, middle if middle < values.max() else middle - 1

    def home(self, rows: np.ndarray) -> np.ndarray:
        """The leaf whose region holds each row."""
        node = np.zeros(len(rows), np.int64)
        while (inner := self.dim[node] >= 0).any():
            at = node[inner]
            right = rows[inner, self.dim[at]] > self.cut[at]
            node[inner] = self.child[at, right.astype(np.int64)]
        return node

    def reached(self, rows: np.ndarray, more: int, less: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for the leaves in whose box one gets by ``more`` added and ``less`` removed letters."""
        who, node, out = np.arange(len(rows)), np.zeros(len(rows), np.int64), []
        while len(who):
            q, low, high = rows[who], self.low[node], self.high[node]
            ok = (np.maximum(low - q, 0).sum(1) <= more) & (np.maximum(q - high, 0).sum(1) <= less)
            who, node = who[ok], node[ok]
            leaf = self.dim[node] < 0
            out.append((who[leaf], node[leaf]))
            who, node = np.repeat(who[~leaf], 2), self.child[node[~leaf]].ravel()
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def upper_levels(counted: DataFrame) -> dict[int, Tree]:
    """Upper levels of the tree of each length, from at most about ``SAMPLE_WORDS`` words.

    Words enter by their hash. Of a length that the sample misses there is one cell.
    """
    lengths = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(lengths.values())
    some = counted.filter(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, SAMPLE_WORDS / max(total, 1))))
    # Words of very many letters would fill the driver; their lengths are rare and keep one cell.
    chosen: dict[int, list[str]] = {}
    for r in some.filter("length <= 64").select("word", "length").toLocalIterator():
        chosen.setdefault(r["length"], []).append(r["word"])
    cell = max(CELL_WORDS, -(-total // MOST_CELLS))
    out = {}
    for length in lengths:
        listed = chosen.get(length, [])
        rows = vectors(letters(listed, length)) if listed else np.zeros((0, DIMS), np.int16)
        # So many sampled words stand for the words of a cell; under 8 the median says little.
        share = max(8, len(rows) * cell // max(lengths[length], 1))
        tree = Tree(rows, share, tight=False)
        tree.rows = tree.order = None
        out[length] = tree
    return out


def by_length(batch) -> dict[int, tuple[list[str], list[int]]]:
    out: dict[int, tuple[list[str], list[int]]] = {}
    for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        listed, counts = out.setdefault(len(word), ([], []))
        listed.append(word)
        counts.append(n)
    return out


ROUTED = "length int, cell int, asks boolean, word string, n long"


def routed(counted: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Each word at home in one cell, and as a question in every cell it can reach."""

    def run(batches):
        for batch in batches:
            for length, (listed, counts) in by_length(batch).items():
                rows = vectors(letters(listed, length))
                parts = [(length, np.arange(len(rows)), trees[length].home(rows), False), (length, *trees[length].reached(rows, 1, 1), True)]
                if length + 1 in trees:
                    parts.append((length + 1, *trees[length + 1].reached(rows, 1, 0), True))
                for tree, who, cell, asks in parts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(who), tree, np.int32)), pa.array(cell.astype(np.int32)), pa.array(np.full(len(who), asks)),
                         pa.array(listed).take(pa.array(who)), pa.array(np.array(counts, np.int64)[who])],
                        names=["length", "cell", "asks", "word", "n"])

    return arrow_map(counted.select("word", "n"), run, ROUTED)


def one_edit(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Whether the rows differ by one replaced letter, or by one inserted into the shorter."""
    if longer.shape[1] == shorter.shape[1]:
        return (longer != shorter).sum(1) == 1
    same = longer[:, :-1] == shorter
    before = np.where(same.all(1), same.shape[1], same.argmin(1))
    same = (longer[:, 1:] == shorter)[:, ::-1]
    after = np.where(same.all(1), same.shape[1], same.argmin(1))
    return before + after >= shorter.shape[1]


class Cell:
    """The words of one chunk, its tree, and what their shorter partners have added so far."""

    def __init__(self, listed: list[str], counts: list[int]):
        self.words, self.length = sorted(zip(listed, counts)), len(listed[0])
        self.counts = np.array([n for _, n in self.words], np.int64)
        self.points = letters([w for w, _ in self.words], self.length)
        rows = vectors(self.points)
        self.vectors, inverse = np.unique(rows, axis=0, return_inverse=True)
        by = np.argsort(inverse.ravel(), kind="stable")
        sizes = np.bincount(inverse.ravel(), minlength=len(self.vectors))
        # Words listed by vector; of each vector where they start and how many there are.
        self.by, self.start, self.size = by, np.cumsum(sizes) - sizes, sizes
        self.tree = Tree(self.vectors, LEAF, tight=True)
        self.norm = (self.vectors.astype(np.float32) ** 2).sum(1)
        self.folded = (self.vectors[:, 26:].sum(1) > 0) | (self.vectors.max(1) >= MOST_OF_ONE)
        self.near = np.zeros(len(self.words), np.int64)
        self.best: dict[int, tuple[int, str]] = {}

    def pairs(self, points: np.ndarray):
        """(question, own word) index pairs that are one edit apart, in parts."""
        same = points.shape[1] == self.length
        rows, back = np.unique(vectors(points), axis=0, return_inverse=True)
        back = back.ravel()
        who, leaf = self.tree.reached(rows, 1, 1 if same else 0)
        if not len(who):
            return
        sizes = self.tree.size[leaf]
        at, who = self.tree.order[gather_ranges(self.tree.first[leaf], sizes)], np.repeat(who, sizes)
        norm = (rows.astype(np.float32) ** 2).sum(1)
        apart = norm[who] + self.norm[at] - 2 * np.einsum("ij,ij->i", rows[who].astype(np.float32), self.vectors[at].astype(np.float32))
        # Anagrams are never one edit apart, unless their counts are folded.
        ok = (apart < (2.5 if same else 1.5)) & ((apart > 0.5) | self.folded[at])
        who, at = who[ok], at[ok]
        asked = np.argsort(back, kind="stable")
        many = np.bincount(back, minlength=len(rows))
        begin = np.cumsum(many) - many
        left, right = many[who], self.size[at]
        total = np.cumsum(left * right)
        step, done = max(1, PAIR_CHARS // self.length), 0
        while done < len(who):
            upto = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + step, "right")))
            part = slice(done, upto)
            done = upto
            # All words of the one vector with all of the other, a bounded number at a time.
            n = left[part] * right[part]
            for lo in range(0, int(n.sum()), step):
                if n.sum() <= step:
                    k = np.repeat(np.arange(len(n)), n)
                    place = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
                else:  # one pair of vectors with very many words
                    place = np.arange(lo, min(lo + step, int(n.sum())))
                    k = np.zeros(len(place), np.int64)
                q = asked[begin[who[part][k]] + place // right[part][k]]
                w = self.by[self.start[at[part][k]] + place % right[part][k]]
                ok = one_edit(self.points[w], points[q])
                yield q[ok], w[ok]

    def ask(self, listed: list[str], counts: list[int]) -> list[tuple]:
        """(word, near, best n, best word) of questions of one length; keeps what they are to own words."""
        found = list(self.pairs(letters(listed, len(listed[0]))))
        q = np.concatenate([a for a, _ in found]) if found else np.zeros(0, np.int64)
        w = np.concatenate([b for _, b in found]) if found else np.zeros(0, np.int64)
        if not len(q):
            return []
        out = []
        order = np.lexsort((w, -self.counts[w], q))  # own words are sorted, so the index breaks ties
        who, first, many = np.unique(q[order], return_index=True, return_counts=True)
        for i, b, n in zip(who.tolist(), w[order][first].tolist(), many.tolist()):
            out.append((listed[i], n, self.words[b][1], self.words[b][0]))
        if len(listed[0]) < self.length:
            self.near += np.bincount(w, minlength=len(self.near))
            rank = np.argsort(np.argsort(np.array(listed, object), kind="stable"))
            number = np.array(counts, np.int64)
            order = np.lexsort((rank[q], -number[q], w))
            own, first = np.unique(w[order], return_index=True)
            for i, b in zip(own.tolist(), q[order][first].tolist()):
                self.best[i] = min(self.best.get(i, (1, "")), (-counts[b], listed[b]))
        return out

    def rest(self) -> list[tuple]:
        return [(self.words[i][0], int(self.near[i]), -n, word) for i, (n, word) in self.best.items()]


def searched(dealt: DataFrame) -> DataFrame:
    """(word, near, best_n, best): near words of each word by chunk; rows sorted by chunk, its own words first."""
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["word", "near", "best_n", "best"])

    def run(batches):
        key, own, cell, waiting = None, ([], []), None, {}

        def flush(least):
            for length, (listed, counts) in list(waiting.items()):
                if len(listed) >= least:
                    del waiting[length]
                    if cell is not None and (out := cell.ask(listed, counts)):
                        yield rows(out)

        for batch in batches:
            for length, at, chunk, asks, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (length, at, chunk):
                    yield from flush(1)
                    if cell is not None and (out := cell.rest()):
                        yield rows(out)
                    key, own, cell = (length, at, chunk), ([], []), None
                if not asks:
                    own[0].append(word)
                    own[1].append(n)
                    continue
                if cell is None and own[0]:
                    cell = Cell(*own)
                if cell is not None:
                    listed, counts = waiting.setdefault(len(word), ([], []))
                    listed.append(word)
                    counts.append(n)
                    if len(listed) >= min(BATCH_WORDS, max(1, PAIR_CHARS // len(word))):
                        yield from flush(len(listed))
        yield from flush(1)
        if cell is not None and (out := cell.rest()):
            yield rows(out)

    return arrow_map(dealt, run, "word string, near long, best_n long, best string")


def near_words(counted: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): how many near words each word has, and the commonest.

    ``counted`` is a written table (word, n); words with no near word are left out.
    """
    sized = counted.withColumn("length", F.char_length("word"))
    trees = upper_levels(sized)
    at = staged(routed(counted, trees), "variants-routed")
    room = F.greatest(F.lit(1), F.least(F.lit(CELL_WORDS), F.lit(CELL_CHARS) / F.col("length")))
    chunks = (at.filter("not asks").groupBy("length", "cell").agg(F.ceil(F.count("*") / F.first(room)).cast("int").alias("chunks")))
    chunks = staged(chunks, "variants-chunks")
    joined = at.join(chunks, ["length", "cell"])
    own = F.array(F.pmod(F.xxhash64("word"), "chunks").cast("int"))
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    dealt = (joined.withColumn("chunk", F.explode(F.when(F.col("asks"), every).otherwise(own)))
             .repartition("length", "cell", "chunk").sortWithinPartitions("length", "cell", "chunk", "asks")
             .select("length", "cell", "chunk", "asks", "word", "n"))
    best = F.min(F.struct(-F.col("best_n"), F.col("best")))
    return (searched(dealt).groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.col1")).alias("best_n"), F.col("b.best").alias("best")))


def roots(edges: DataFrame) -> DataFrame:
    """(word, root) from written (word, form): pointer jumping, a round doubles the step."""
    at = edges.select("word", F.col("form").alias("root"))
    while True:
        ahead = at.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        step = staged(at.join(ahead, F.col("root") == F.col("__w"), "left")
                      .select("word", F.coalesce("__r", "root").alias("root"), F.col("__r").isNotNull().alias("moved")), "variants-roots")
        at = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return at


def variants(counted: DataFrame) -> DataFrame:
    """Form and root of each word of a written table (word, n)."""
    found = near_words(counted)
    known = F.col("best_n") >= 2 * F.col("n")
    joined = staged(counted.join(found, "word", "left").select(
        "word", F.when(known, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(known, F.col("best_n")).alias("form_n")), "variants-forms")
    to = roots(joined.filter("form is not null").select("word", "form"))
    return joined.join(to, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(staged(words(table(spark, sf_dir, "documents")), "variants-words"))


ORACLE = """with recursive crc_table as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as t),
runs as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) as run from documents),
lowered as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
  from runs where length(run) >= 5 group by all),
coded as (select run, n, flatten(list_transform(regexp_extract_all(coalesce(doc_id::varchar, '') || ':' || run, '.'),
  lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [192 + unicode(c) // 64, 128 + unicode(c) % 64]::bigint[] end)) as b from lowered),
hashed as (select run, n, xor(list_reduce(list_prepend(4294967295::bigint, b), lambda c, x: xor(c // 256, t[(xor(c, x) & 255) + 1])), 4294967295) as h from coded, crc_table),
left_out as (select case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n from hashed),
w as (select word, sum(n)::bigint as n from left_out where length(word) >= 5 group by word having sum(n) >= 3),
cut as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as d from (select word, n, unnest(range(1, length(word) + 1))::int as i from w)),
near as (select distinct * from (
  select a.word, b.word as other, b.n from cut a join cut b on a.i = b.i and a.d = b.d and a.word <> b.word
  union all select a.word, b.word, b.n from cut a join w b on a.d = b.word
  union all select b.word, a.word, a.n from cut a join w b on a.d = b.word)),
best as (select word, count(*) as n_near, first(other order by n desc, encode(other)) as other, max(n) as top from near group by word),
formed as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when top >= 2 * w.n then other end as form, case when top >= 2 * w.n then top end as form_n
  from w left join best using (word)),
walk as (select word, word as root, form as nxt from formed
  union all select walk.word, f.word, f.form from walk join formed f on walk.nxt = f.word)
select f.word, f.form, walk.root, f.n, f.n_near, f.form_n from formed f join walk on f.word = walk.word and walk.nxt is null"""
