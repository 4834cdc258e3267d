"""Benchmark decontamination (operator 2): size-partitioned MinHash containment search.

A document is contaminated by a test item when it holds at least ``THRESHOLD``
of the item's distinct word shingles (five words; an item of fewer words is one
shingle of that width). Words are runs of letters and digits, lower-cased.

Jaccard similarity says nothing here: a short item inside a long document has
one near zero. So both sides are partitioned by size and every partition has
its own MinHash cut-off:

* Items fall into classes by their number of shingles q. All shingles are put
  in the order of one hash. If a document holds t * q of an item's shingles, it
  holds one of the item's k = q - ceil(t * q) + 1 smallest: these are the
  item's MinHash sketch, and the class's cut-off is the largest hash in a
  sketch of the class.
* Documents fall into classes by their number of shingles; a document too short
  for an item class need not look at it. Its sketch is the shingles under the
  largest cut-off of the classes it can hold.

A pair with a common sketch value is a candidate, and by the counting argument
no contaminated pair is missed. Candidates are verified on the shingles
themselves, as text. Everything is DataFrame functions; there is no Python in
the plan. The sketch of the items is broadcast only if its counted rows are few
(``BROADCAST_ROWS``), else the join shuffles.

Null and empty texts, and texts with fewer words than a shingle has, hold no
item; items without a word are never found. Repeated rows of documents with one
id are reported once, as are repeated items of one id (their shingles are
united). Null ids never take part. Empty tables give an empty result. Only id
and text columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import staged, table

WIDTH = 5
THRESHOLD = 0.8
BROADCAST_ROWS = 500_000


def normal(text) -> Column:
    """Lower-cased words, one blank between them, a blank at either end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def word_list(text) -> Column:
    return F.filter(F.split(F.trim(text), " "), lambda w: w != "")


def shingle_hashes(hashes, width: int) -> Column:
    """64-bit hashes of the runs of ``width`` words, from the hashes of the words."""
    last = F.size(hashes) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        F.lit(width), *[F.get(hashes, i + k) for k in range(width)])))


def computed(df: DataFrame, name: str, value: Column, *others: str) -> DataFrame:
    """``others`` and one more column that is computed once for each row.

    The optimiser copies a plain column's expression into filters and lambdas
    above it, where it would run once for each element; a generated column stays.
    """
    return df.select(*others, F.explode(F.array(value)).alias(name))


def item_shingles(items: DataFrame, width: int) -> DataFrame:
    """(item_id, width, shingle, h): distinct shingles, written out as ' a b c d e '."""
    words = word_list(normal(F.col("text")))
    rows = (items.filter(F.col("item_id").isNotNull()).select("item_id", words.alias("w"))
            .withColumn("width", F.least(F.lit(width), F.size("w"))).filter(F.col("width") > 0)
            .withColumn("i", F.explode(F.sequence(F.lit(1), F.expr("size(w) - width + 1"))))
            .select("item_id", "width", F.expr("slice(w, i, width)").alias("s")))
    hashes = F.transform("s", lambda w: F.xxhash64(w))
    return rows.select(
        "item_id", "width", F.concat(F.lit(" "), F.array_join("s", " "), F.lit(" ")).alias("shingle"),
        F.coalesce(*[F.when(F.col("width") == k, F.xxhash64(F.lit(k), *[F.get(hashes, F.lit(j)) for j in range(k)]))
                     for k in range(1, width + 1)]).alias("h")).distinct()


def sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """(item_id, width, class, least, h): the MinHash sketch of each item and its size class."""
    of_item = (shingles.groupBy("item_id", "width")
               .agg(F.sort_array(F.collect_set("h")).alias("hs"))  # one item: a short text
               .withColumn("q", F.size("hs"))
               .withColumn("least", F.ceil(F.lit(threshold) * F.col("q") - 1e-9).cast("int"))
               .withColumn("class", F.floor(F.log2("q")).cast("int")))
    return of_item.select("item_id", "width", "class", "least", F.explode(F.expr("slice(hs, 1, q - least + 1)")).alias("h"))


def contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) of every contaminated pair."""
    shingles = staged(item_shingles(items, width), "decontaminate-shingles")
    sketch = staged(sketches(shingles, threshold), "decontaminate-sketches")
    # One row per width and size class, so a few dozen at most.
    cuts = sketch.groupBy("width", "class").agg(F.max("h").alias("cut"), F.min("least").alias("least")).collect()
    empty = "doc_id long, item_id long, shared int, item_shingles int, containment double"
    if not cuts:
        return docs.sparkSession.createDataFrame([], empty)
    found = None
    words = F.transform(word_list(normal(F.col("text"))), lambda w: F.xxhash64(w))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    hashed = computed(rows, "hw", words, "doc_id")
    for k in sorted({c["width"] for c in cuts}):
        steps = sorted((c["least"], c["cut"]) for c in cuts if c["width"] == k)
        # A document takes part in the size classes it is long enough for.
        cut = F.greatest(*[F.when(F.size("hs") >= least, F.lit(c)) for least, c in steps], F.lit(-2**63))
        values = (computed(hashed, "hs", shingle_hashes(F.col("hw"), k), "doc_id")
                  .select("doc_id", cut.alias("cut"), F.explode("hs").alias("h")).filter("h <= cut").select("doc_id", "h"))
        values = values.withColumn("width", F.lit(k))
        found = values if found is None else found.union(values)
    narrow = sketch.select("item_id", "width", "h")
    if sketch.count() <= BROADCAST_ROWS:  # 20 bytes a row: 10 MB
        narrow = F.broadcast(narrow)
    pairs = staged(found.join(narrow, ["width", "h"]).select("doc_id", "item_id").distinct(), "decontaminate-pairs")
    return verified(docs, pairs, shingles, threshold).select(*[x.split()[0] for x in empty.split(", ")])


def verified(docs: DataFrame, pairs: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """Count, for each candidate pair, the item's shingles in the document's own text."""
    ids = pairs.select("doc_id").distinct()
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
             .transform(lambda df: computed(df, "t", normal(F.col("text")), "doc_id")))
    items = shingles.groupBy("item_id").agg(F.collect_set("shingle").alias("s"))  # one item: a short text
    both = pairs.join(texts, "doc_id").join(items, "item_id")
    shared = F.size(F.expr("filter(s, x -> contains(t, x))"))
    return (both.select("doc_id", "item_id", shared.alias("shared"), F.size("s").alias("item_shingles"))
            .groupBy("doc_id", "item_id").agg(F.max("shared").alias("shared"), F.max("item_shingles").alias("item_shingles"))
            .withColumn("containment", F.col("shared") / F.col("item_shingles"))
            .filter(F.col("shared") >= F.lit(threshold) * F.col("item_shingles") - 1e-9))


def without_leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that hold no test item."""
    leaked = staged(contaminated(docs, items, width, threshold).select("doc_id").distinct(), "decontaminate-leaked")
    if leaked.count() <= BROADCAST_ROWS:
        leaked = F.broadcast(leaked)
    return docs.join(leaked.withColumnRenamed("doc_id", "_leaked"), F.col("doc_id") == F.col("_leaked"), "left_anti")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
with w as (
  select doc_id as id, list_filter(string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '') as w
  from documents where doc_id is not null
), v as (
  select item_id as id, list_filter(string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '') as w
  from benchmark where item_id is not null
), items as (
  select distinct id, least(5, len(w)) as width, list_slice(w, i, i + least(5, len(w)) - 1) as s
  from (select id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) as i from v where len(w) > 0)
), sizes as (select id, count(*) as q from items group by id),
shingles as (
  select distinct id, width, list_slice(w, i, i + width - 1) as s
  from (select id, w, width, unnest(range(1, len(w) - width + 2)) as i
        from w, (select distinct width from items) where len(w) >= width)
)
select d.id as doc_id, i.id as item_id, cast(count(*) as int) as shared, cast(max(q) as int) as item_shingles,
       count(*) / max(q)::double as containment
from items i join shingles d on d.width = i.width and d.s = i.s join sizes on sizes.id = i.id
group by d.id, i.id having count(*) >= 0.8 * max(q) - 1e-9
"""
