"""Marts kept up to date from change feeds of the facts.

Two tables are maintained:

  totals   one row per (order, supplier): revenue, items, year and month, and one
           row per order that carries its date; kept by hash buckets of the order
           (sources/buckets.py), so a batch reads and writes only buckets of the
           orders it mentions
  marts    monthly and monthly-by-restaurant measures, kept by buckets of the month;
           the yearly mart is rolled up from the monthly one

Feed rows of the facts are folded with their sign (before images subtract, after
images add; counts and exact decimals, so nothing drifts). What an order was and
what it has become goes into the feed of ``totals`` in the same commit, and the
marts fold that feed in turn. Each commit marker names the input it has
consumed: a step that fails is repeated from the same feed into the same
version, and a mart that lags takes all feeds it has not seen, netted per order.

Disk: a batch holds what it reads, what it writes and the shuffle of a part of
that, not the remains of steps before it. Large batches are dealt and written some
buckets after the others, in rounds of one commit, and folded into the marts some
months after the others. Shuffle files and intermediate tables go with the step
that made them, and once both marts have taken a batch, ``apply`` removes the feeds
and buckets of ``totals`` that nobody needs any more. Versions of the marts are
kept, as readers may be at work on them.

Sums and counts can be subtracted, the largest order cannot: a group whose
maximum left and was not reached again in the same batch is computed anew from
``totals``; only such groups are.
"""

from __future__ import annotations

import math
from functools import reduce
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.operators.cdc import BATCH, net_changes
from tierflow.operators.consumers import trim
from tierflow.operators.merge import ACTION, IS_UPDATE, KIND
from tierflow.plans import marts
from tierflow.session import passing_scratch
from tierflow.sources.buckets import BUCKET, BucketedTable, key_bucket, partition_bucket

ORDER_LEVEL, SUPPLIER_LEVEL = "order", "supplier"
LEVELS = {"monthly": (ORDER_LEVEL, ["year", "month"]), "monthly_by_restaurant": (SUPPLIER_LEVEL, ["year", "month", "l_suppkey"])}
VALUES = ["year", "month", "order_revenue", "n_items"]

#: Rows of ``totals`` dealt at a time: about 1.5 GB of shuffle files.
ROWS_OF_ROUND = 64_000_000
#: Order keys and revenues hardly repeat, so a dictionary of them only costs.
PACKED = {"compression": "zstd"}
PACKED_TOTALS = PACKED | {"parquet.enable.dictionary#l_orderkey": "false", "parquet.enable.dictionary#order_revenue": "false"}


def signed() -> F.Column:
    return F.when(F.col(ACTION) == "INSERT", F.lit(1)).otherwise(F.lit(-1))


def _equal(keys, left: str, right: str) -> F.Column:
    return reduce(lambda a, b: a & b, [F.col(left + k).eqNullSafe(F.col(right + k)) for k in keys])


class MartStore:
    """The tables under one root; ``apply`` takes a batch of feeds through all of them."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, month_buckets: int = 16):
        self.spark = spark
        self.totals = BucketedTable(spark, f"{root}/totals", ["l_orderkey"], buckets, partition_bucket, PACKED_TOTALS)
        if self.totals.exists() and self.totals.marker().get("by", key_bucket.__name__) == key_bucket.__name__:
            self.totals.bucket = key_bucket  # a store from before; rows stay in their buckets
        self.marts = {name: BucketedTable(spark, f"{root}/{name}", ["year", "month"], month_buckets, options=PACKED) for name in LEVELS}

    def apply(self, lines: DataFrame, orders: DataFrame, batch: int) -> None:
        """Fold one batch of line and order feeds; a batch that was folded before is left out."""
        taken = min(table.consumed() for table in self.marts.values())
        if self.totals.consumed() < batch:
            self.fold_totals(lines, orders, batch)
        for name in LEVELS:
            self.fold_mart(name)
        trim(self.totals, [SimpleNamespace(offset=table.consumed) for table in self.marts.values()], since=taken)

    # ------------------------------------------------------------ totals
    def fold_totals(self, lines: DataFrame, orders: DataFrame, batch: int) -> int:
        """Feeds: lines (l_orderkey, l_suppkey, l_extendedprice, l_discount), orders (o_orderkey, o_orderdate)."""
        with passing_scratch(self.spark) as written:
            return self._fold_totals(lines, orders, batch, written)

    def _fold_totals(self, lines: DataFrame, orders: DataFrame, batch: int, written) -> int:
        based_on = self.totals.version()
        change = lines.groupBy("l_orderkey", "l_suppkey").agg(
            F.sum(signed() * marts.line_revenue()).cast(marts.REVENUE_TYPE).alias("revenue"), F.sum(signed()).cast("bigint").alias("items"))
        # The last image of an order says whether it is there and when it was made.
        last = F.max(F.struct(F.col(ACTION) == "INSERT", F.col("o_orderdate").cast("date").alias("date")))
        dated = orders.groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(last.alias("m"))
        dated = dated.select("l_orderkey", F.when(F.col("m.col1"), F.col("m.date")).alias("date"))
        none = F.lit(None)
        work = change.select("l_orderkey", "l_suppkey", F.lit(False).alias("is_order"), "revenue", "items", none.cast("date").alias("date"))
        work = work.unionByName(dated.select("l_orderkey", none.cast("bigint").alias("l_suppkey"), F.lit(True).alias("is_order"),
                                             none.cast(marts.REVENUE_TYPE).alias("revenue"), none.cast("bigint").alias("items"), "date"))
        work = written(work.withColumn(BUCKET, self.totals.bucket(work.select("l_orderkey"), ["l_orderkey"], self.totals.buckets())), "mart-work")
        touched = self.totals.touched(work)
        new = work.select("l_orderkey", "l_suppkey", "is_order", BUCKET, F.lit(True).alias("new"), none.cast("int").alias("year"),
                          none.cast("int").alias("month"), F.col("revenue").alias("order_revenue"), F.col("items").alias("n_items"), "date")
        held = self.totals.rows(touched, based_on) if based_on else None
        if held is not None:
            new = held.select("l_orderkey", "l_suppkey", "is_order", BUCKET, F.lit(False).alias("new"), *VALUES, none.cast("date").alias("date")).unionByName(new)
        count, buckets = new.count(), self.totals.buckets()
        parts = max(self.spark.sparkContext.defaultParallelism, math.ceil(count / marts.ROWS_OF_TASK))
        of_bucket = math.ceil(parts / max(1, len(touched)))
        # As many tasks for each bucket; where few of many are touched most of these would be empty.
        dealt = self.totals.bucket is partition_bucket and buckets * of_bucket <= 4 * max(parts, len(touched))
        rounds = max(1, min(len(touched), math.ceil(count / ROWS_OF_ROUND)))
        in_rounds = [new.filter(F.col(BUCKET).isin(touched[r::rounds])) for r in range(rounds)] if rounds > 1 else [new]
        rows = [self._images(some, buckets * of_bucket if dealt else math.ceil(parts / rounds)) for some in in_rounds]
        return self.totals.write_buckets(rows[0], touched, consumed=batch, based_on=based_on, dealt=dealt, more=rows[1:])

    def _images(self, new: DataFrame, parts: int) -> DataFrame:
        """Rows and feed of some buckets, from the rows they hold (``new`` is false) and what came for them."""
        # One exchange and one pass by order serve the sums, the dates, the order totals, all images and the write;
        # partitions follow the rows, so that what a task sorts and hashes does not grow with the table.
        none = F.lit(None)
        measures = (("order_revenue", marts.REVENUE_TYPE), ("n_items", "bigint"))
        old, is_order, date = ~F.col("new"), F.col("is_order"), F.col("date")
        sums = new.repartition(parts, "l_orderkey").groupBy("l_orderkey", "l_suppkey", "is_order", BUCKET).agg(
            F.max(F.when(old, F.col("year"))).alias("old_year"), F.max(F.when(old, F.col("month"))).alias("old_month"),
            F.bool_or("new").alias("dated"), F.max("date").alias("date"),
            *[F.coalesce(F.sum(F.when(old, F.col(c))), F.lit(0)).cast(t).alias(f"old_{c}") for c, t in measures],
            *[F.sum(c).cast(t).alias(f"new_{c}") for c, t in measures])
        # The date is on the row of the order itself, whose measures become those of all its lines.
        one, known = Window.partitionBy("l_orderkey"), F.col("l_orderkey").isNotNull()
        head = {"old_year": F.col("old_year"), "old_month": F.col("old_month"),
                "new_year": F.when(F.col("dated"), F.year(date)).otherwise(F.col("old_year")),
                "new_month": F.when(F.col("dated"), F.month(date)).otherwise(F.col("old_month"))}
        both = sums.select(
            "l_orderkey", "l_suppkey", "is_order", BUCKET,
            *[F.when(known, F.max(F.when(is_order, c)).over(one)).alias(name) for name, c in head.items()],
            F.when(is_order, head["new_year"]).alias("head_year"), F.when(is_order, head["new_month"]).alias("head_month"),
            *[F.when(is_order, F.sum(F.when(~is_order, F.col(f"{w}_{c}"))).over(one)).otherwise(F.col(f"{w}_{c}")).cast(t).alias(f"{w}_{c}")
              for w in ("old", "new") for c, t in measures])

        def image(values, level, row_of_order, action, is_update, kind):
            return F.struct(F.col("l_orderkey"), F.col("l_suppkey"), row_of_order.alias("is_order"), *[v.alias(c) for c, v in zip(VALUES, values)],
                            level.cast("string").alias("level"), F.col(BUCKET), F.lit(action).cast("string").alias(ACTION),
                            is_update.cast("boolean").alias(IS_UPDATE), F.lit(kind).alias(KIND))

        def there(which):
            return F.coalesce((F.col(f"{which}_n_items") > 0) & F.col(f"{which}_year").isNotNull(), F.lit(False))

        was, now = there("old"), there("new")
        same = reduce(lambda a, b: a & b, [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in VALUES])
        level, before, after = F.when(is_order, ORDER_LEVEL).otherwise(SUPPLIER_LEVEL), *([F.col(f"{w}_{c}") for c in VALUES] for w in ("old", "new"))
        line = image(after, F.lit(SUPPLIER_LEVEL), F.lit(False), None, none, "row")
        dated_order = image([F.col("head_year"), F.col("head_month"), F.lit(0).cast(marts.REVENUE_TYPE), F.lit(0).cast("bigint")], none, F.lit(True), None, none, "row")
        images = F.array(F.when(was & ~(now & same), image(before, level, F.lit(False), "DELETE", now, "feed")),
                         F.when(now & ~(was & same), image(after, level, F.lit(False), "INSERT", was, "feed")),
                         F.when(is_order & F.col("head_year").isNotNull(), dated_order).when(~is_order & (F.col("new_n_items") != 0), line))
        return both.select(F.explode(images).alias("x")).filter("x is not null").select("x.*")

    # ------------------------------------------------------------ marts
    def changes(self, level: str, after: int, upto: int) -> DataFrame:
        """Net images of one level in the versions of ``totals`` after ``after``."""
        rows = self.totals.read_versions(after + 1, upto).filter((F.col(KIND) == "feed") & (F.col("level") == level))
        feed = rows.select("l_orderkey", "l_suppkey", *VALUES, ACTION, IS_UPDATE, F.col("v").cast("bigint").alias(BATCH))
        if upto == after + 1:
            return feed.drop(BATCH)
        return net_changes(feed, ["l_orderkey"] if level == ORDER_LEVEL else ["l_orderkey", "l_suppkey"])

    def fold_mart(self, name: str) -> int | None:
        """Fold the feeds of ``totals`` that this mart has not consumed."""
        with passing_scratch(self.spark) as written:
            return self._fold_mart(name, written)

    def _fold_mart(self, name: str, written) -> int | None:
        level, keys = LEVELS[name]
        table, head = self.marts[name], self.totals.version()
        based_on, seen = table.version(), table.consumed()
        if seen >= head:
            return None
        gain, loss = F.col(ACTION) == "INSERT", F.col(ACTION) == "DELETE"

        def grouped(some) -> DataFrame:
            delta = some(self.changes(level, seen, head)).groupBy(*keys).agg(
                F.sum(signed() * F.col("order_revenue")).cast(marts.REVENUE_TYPE).alias("d_revenue"), F.sum(signed()).cast("bigint").alias("d_orders"),
                F.sum(signed() * F.col("n_items")).cast("bigint").alias("d_items"),
                F.max(F.when(gain, F.col("order_revenue"))).alias("top_in"), F.max(F.when(loss, F.col("order_revenue"))).alias("top_out"))
            return delta.withColumn(BUCKET, table.bucket(delta.select("year", "month"), ["year", "month"], table.buckets()))

        # Months are summed where they are read; groups that grow with the facts are not, so these go in rounds,
        # unless several versions have to be netted first, which takes all of them in each round.
        feed = self.totals.read_versions(seen + 1, head).filter(F.col(KIND) == "feed")
        rounds = math.ceil(feed.count() / ROWS_OF_ROUND) if level == SUPPLIER_LEVEL and head == seen + 1 else 1
        delta = self._by_months(self.changes(level, seen, head).select("year", "month"), rounds, grouped, written, "mart-delta")
        touched = table.touched(delta)
        measures = [("total_revenue", "d_revenue"), ("total_orders", "d_orders"), ("total_items", "d_items")]
        held = table.rows(touched, based_on) if based_on else None
        if held is None:
            held = delta.limit(0).select(*keys, *[F.col(d).alias(m) for m, d in measures], F.col("top_in").alias("max_order_value"), BUCKET)
        held = held.select(*[F.col(c).alias("o_" + c) for c in [*keys, *[m for m, _ in measures], "max_order_value", BUCKET]], F.lit(True).alias("was"))
        zero = F.lit(0)
        j = held.join(delta, _equal(keys, "o_", ""), "full_outer")
        top, into, out = F.col("o_max_order_value"), F.col("top_in"), F.col("top_out")
        # The maximum has left, and no order of this batch reaches it.
        lost = F.coalesce((out >= top) & F.coalesce(into < top, F.lit(True)), F.lit(False))
        folded = j.select(
            *[F.coalesce(F.col(k), F.col("o_" + k)).alias(k) for k in keys],
            *[(F.coalesce(F.col("o_" + m), zero) + F.coalesce(F.col(d), zero)).cast("bigint" if d != "d_revenue" else marts.REVENUE_TYPE).alias(m) for m, d in measures],
            F.when(~lost, F.greatest(top, into)).cast(marts.REVENUE_TYPE).alias("max_order_value"),
            F.coalesce(F.col(BUCKET), F.col("o_" + BUCKET)).alias(BUCKET), lost.alias("lost")).filter("total_orders > 0")
        folded = written(folded, "mart-folded")
        again = folded.filter("lost").select(*[F.col(k).alias("g_" + k) for k in keys])
        if not again.isEmpty():
            folded = folded.join(self.tops(level, keys, again, head, written), _equal(keys, "", "g_"), "left")
            folded = folded.withColumn("max_order_value", F.coalesce("max_order_value", "top")).drop("top", *again.columns)
        rows = folded.drop("lost").withColumns({ACTION: F.lit(None).cast("string"), IS_UPDATE: F.lit(None).cast("boolean"), KIND: F.lit("row")})
        return table.write_buckets(rows, touched, consumed=head, based_on=based_on, recomputed=again.count())

    def tops(self, level: str, keys, groups: DataFrame, version: int, written) -> DataFrame:
        """Largest order of these groups, from ``totals``."""
        held = self.totals.rows(version=version)
        in_groups = ["year", "month"] if level == ORDER_LEVEL else keys

        def largest(some) -> DataFrame:
            rows = some(held.filter("not is_order and year is not null and n_items > 0"))
            semi = rows.join(some(groups, "g_").select(*["g_" + k for k in in_groups]).distinct(), _equal(in_groups, "", "g_"), "left_semi")
            if level == ORDER_LEVEL:
                semi = semi.groupBy("l_orderkey", "year", "month").agg(F.sum("order_revenue").alias("order_revenue"))
            return semi.groupBy(*[F.col(k).alias("g_" + k) for k in keys]).agg(F.max("order_revenue").cast(marts.REVENUE_TYPE).alias("top"))

        return self._by_months(groups.select("g_year", "g_month"), math.ceil(held.count() / ROWS_OF_ROUND), largest, written, "mart-tops")

    def _by_months(self, months: DataFrame, rounds: int, make, written, name: str) -> DataFrame:
        """``make`` for some calendar months after the others, each written (and its shuffle freed) before the next."""
        if rounds <= 1:
            return written(make(lambda df, prefix="": df), name)
        numbers = sorted(12 * year + month for year, month in months.distinct().collect())

        def only(some):
            return lambda df, prefix="": df.filter((12 * F.col(prefix + "year") + F.col(prefix + "month")).isin(some))

        return reduce(DataFrame.unionByName, [written(make(only(numbers[r::rounds])), name) for r in range(max(1, min(rounds, len(numbers))))])

    # ------------------------------------------------------------ reads
    def monthly(self) -> DataFrame:
        return marts.with_averages(self.marts["monthly"].rows()).select("year", "month", *marts.MEASURES)

    def yearly(self) -> DataFrame:
        """Orders have one date, so the months of a year add up."""
        year = self.marts["monthly"].rows().groupBy("year").agg(
            F.sum("total_revenue").cast(marts.REVENUE_TYPE).alias("total_revenue"), F.sum("total_orders").alias("total_orders"),
            F.sum("total_items").alias("total_items"), F.max("max_order_value").alias("max_order_value"))
        return marts.with_averages(year).select("year", *marts.MEASURES)

    def monthly_by_restaurant(self, supplier: DataFrame) -> DataFrame:
        names = supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("restaurant_name"))
        rows = marts.with_averages(self.marts["monthly_by_restaurant"].rows()).join(names, "l_suppkey", "left")
        return rows.select("year", "month", F.col("l_suppkey").alias("restaurant_id"), "restaurant_name", *marts.MEASURES)
