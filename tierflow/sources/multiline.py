"""CSV files with line breaks inside quotes, read by many tasks.

Spark's ``multiLine`` reads a file in one task, since a line break may lie inside
quotes. Whether it does follows from the number of quotes before it: an even
number means that a record ends there (a doubled quote counts twice and changes
nothing). So files are scanned as lines, in byte ranges; quotes are summed per
range, the sums are added up over the ranges of each file (a table of one row
per range), and with the parity at its start each range knows its own record
borders. Lines of a record that crosses ranges are put together by the record's
first line. Records are then parsed by Spark's CSV parser, with the file format's
options.

A line is one row; the lines of a record and no more come together in a task.
Quotes have to be doubled inside quotes and may not occur in unquoted fields
(as in files that quote what needs it); a file that ends inside quotes is an
error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.session import unique_scratch

BLOCK = ["__file", "__block"]


def lines(spark: SparkSession, paths, recursive: bool = True) -> DataFrame:
    """Lines with file, byte range, place in the range, quotes, and ``_metadata`` of the file."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower()).text(paths)
    meta = F.col("_metadata")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return text.select("value", meta.file_path.alias("__file"), meta.file_block_start.alias("__block"), F.monotonically_increasing_id().alias("__id"),
                       quotes.alias("__quotes"), F.struct(meta.file_path.alias("file_path"), meta.file_size.alias("file_size"),
                                                          meta.file_modification_time.alias("file_modification_time")).alias("__meta"))


def ranges(rows: DataFrame) -> DataFrame:
    """Per byte range: quotes before it in the file, and in the whole file."""
    sums = rows.groupBy(*BLOCK).agg(F.sum("__quotes").alias("n"))
    path = unique_scratch(rows.sparkSession, "multiline-ranges")
    sums.write.parquet(path)
    sums = rows.sparkSession.read.schema(sums.schema).parquet(path)
    of_file = Window.partitionBy("__file")
    before = of_file.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*BLOCK, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"), F.sum("n").over(of_file).alias("__all"))


def records(spark: SparkSession, paths, recursive: bool = True) -> DataFrame:
    """(record, header, __meta): one row per record of each file, its line breaks inside."""
    rows = lines(spark, paths, recursive)
    start = ranges(rows)
    here = Window.partitionBy(*BLOCK).orderBy("__id")
    before = F.col("__before") + F.coalesce(F.sum("__quotes").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = rows.join(start, BLOCK).select(
        "value", *BLOCK, "__id", "__meta", "__quotes",
        F.when(F.col("__all") % 2 == 0, before).otherwise(F.raise_error(F.concat(F.lit("file ends inside quotes: "), "__file"))).alias("__open"))
    begins = F.col("__open") % 2 == 0
    # The line at which the record of each line begins, if that lies in the same range.
    first = F.last(F.when(begins, F.col("__id")), ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, 0))
    marked = marked.withColumn("__first", first).withColumn("__begins", begins).withColumn("__more", (F.col("__open") + F.col("__quotes")) % 2 == 1)
    path = unique_scratch(spark, "multiline-lines")
    marked.write.parquet(path)
    marked = spark.read.schema(marked.schema).parquet(path)
    alone = marked.filter("__begins and not __more")
    # Other lines go to the last record that began before their range.
    parts = marked.filter("not __begins or __more")
    open_at = parts.groupBy(*BLOCK).agg(F.max(F.struct("__id", "__first"))["__first"].alias("last"))
    earlier = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = open_at.select(*BLOCK, F.last(F.when(F.col("last").isNotNull(), F.struct(F.col("__block").alias("b"), F.col("last").alias("i"))), ignorenulls=True)
                             .over(earlier).alias("__from"))
    named = parts.join(carried, BLOCK).select(
        "value", *BLOCK, "__id", "__meta", F.coalesce(F.when(F.col("__first").isNotNull(), F.struct(F.col("__block").alias("b"), F.col("__first").alias("i"))), F.col("__from")).alias("__r"))
    whole = named.groupBy("__file", "__r").agg(
        F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct(F.col("__block").alias("b"), F.col("__id").alias("i"), "value"))), lambda x: x["value"])).alias("record"),
        F.first("__meta").alias("__meta"))
    out = [alone.select(F.col("value").alias("record"), "__file", F.struct(F.col("__block").alias("b"), F.col("__id").alias("i")).alias("__r"), "__meta"),
           whole.select("record", "__file", "__r", "__meta")]
    joined = reduce(DataFrame.unionByName, out)
    # The header is the first record of a file, which begins at its first byte; the end of its
    # first line says what ends a line in this file (and CR LF is read as LF, inside quotes too).
    top = marked.filter("__block = 0").groupBy("__file").agg(
        F.min("__id").alias("__top"), F.min_by(F.col("value").endswith("\r"), "__id").alias("__crlf"))
    joined = joined.join(top, "__file", "left")
    header = (F.col("__r.b") == 0) & (F.col("__r.i") == F.col("__top"))
    plain = F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), "\r$", "")
    return (joined.select(F.when(F.col("__crlf"), plain).otherwise(F.col("record")).alias("record"), header.alias("header"), "__meta")
            .filter(F.length("record") > 0))


def read_records(spark: SparkSession, paths, schema, options: dict, recursive: bool = True) -> DataFrame:
    """Parsed records of all files (headers left out), with ``_metadata`` of their file."""
    parse = {k: v for k, v in options.items() if k not in ("header", "recursiveFileLookup", "encoding")} | {"multiLine": "true"}
    rows = records(spark, paths, recursive).filter("not header")
    parsed = rows.select(F.from_csv("record", F.lit(schema.simpleString()[7:-1].replace(":", " ")), parse).alias("r"), F.col("__meta").alias("_metadata"))
    return parsed.select("r.*", "_metadata")
