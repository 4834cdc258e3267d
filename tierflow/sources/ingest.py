"""CSV ingest into all-text stage tables with file audit columns.

File format of the source (comma, one header line, optional double
quotes, ``\\N`` as NULL); columns are bound by position by default, like
``t.$1 ... t.$n`` in the source: the header text is skipped, not matched.

Audit columns:
  _stg_file_name     the file's path (``_metadata.file_path``)
  _stg_file_load_ts  the file's modification time
  _stg_file_md5      a key of the file version
  _copy_data_ts      the load time (``as_of``, or the current time)

The key of a file version is an MD5 over (path, length, modification time) taken
from the file listing. Whether a file that looks new has new bytes is told by its
content key (``content_keys``): files are scanned as lines in byte ranges, each
range is digested in parallel, and the digests of the ranges are folded, so that
no task reads a whole file and no file's bytes are gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources import multiline

# The source's CSV file format.
CSV_OPTIONS = {
    "sep": ",",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "encoding": "UTF-8",
}

CORRUPT = "_corrupt_record"
AUDIT = ["_stg_file_name", "_stg_file_load_ts", "_stg_file_md5", "_copy_data_ts"]


def text_schema(cols) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def csv_format(cols, on_error: str = "abort", ragged: str = "reject") -> tuple[T.StructType, dict]:
    """Schema and parser options of a load (see ``csv_reader``)."""
    schema = text_schema(cols)
    opts = dict(CSV_OPTIONS)
    if on_error == "continue" or ragged == "pad":
        opts["mode"] = "PERMISSIVE"
        if on_error == "continue":
            schema = schema.add(CORRUPT, T.StringType(), True)
            opts["columnNameOfCorruptRecord"] = CORRUPT
    else:
        opts["mode"] = "FAILFAST"
    return schema, opts


def csv_reader(spark: SparkSession, cols, *, on_error: str = "abort", ragged: str = "reject",
               multi_line: bool = False, recursive: bool = True, streaming: bool = False):
    """A configured CSV reader over an all-text schema in file order.

    on_error  'abort'     : any malformed row fails the load (FAILFAST)
              'continue'  : malformed rows are kept with a ``_corrupt_record``
    ragged    'reject'    : rows with too few/many fields are malformed
              'pad'       : such rows are padded with NULL / truncated
    multi_line            : quoted fields may span lines (here a file is then read
                            by one task; ``read_staged`` reads it in byte ranges)
    """
    schema, opts = csv_format(cols, on_error, ragged)
    if multi_line:
        opts["multiLine"] = "true"
    if recursive and not streaming:
        opts["recursiveFileLookup"] = "true"
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).options(**opts).format("csv")


def _key(path, size, mtime) -> F.Column:
    return F.md5(F.concat_ws("|", path, size.cast("string"), F.unix_micros(mtime).cast("string")))


def scanned_path() -> F.Column:
    """The scanned file's path, decoded like a listing's path.

    ``_metadata.file_path`` is URI-encoded; '+' is protected before
    decoding so that it is not read as a space.
    """
    return F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))


def file_key() -> F.Column:
    """Content key of the scanned file's version (path, size, modification time)."""
    return _key(scanned_path(), F.col("_metadata.file_size"), F.col("_metadata.file_modification_time"))


def with_audit(df: DataFrame, as_of=None) -> DataFrame:
    """Append the four audit columns (needs ``_metadata`` of a file scan)."""
    copy_ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.select(
        *[F.col(c) for c in df.columns],
        scanned_path().alias("_stg_file_name"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_stg_file_load_ts"),
        file_key().alias("_stg_file_md5"),
        copy_ts.cast("timestamp_ntz").alias("_copy_data_ts"),
    )


def bind(df: DataFrame, target_cols, how: str = "position") -> DataFrame:
    """Bind file columns to the stage table's columns.

    position: the i-th file column lands in the i-th target column (the
              source's ``copy into T (cols) from (select $1, $2 ...)``)
    name:     columns are matched by header name
    """
    data = [c for c in df.columns if c not in AUDIT and c != CORRUPT]
    rest = [c for c in df.columns if c not in data]
    if how == "position":
        if len(data) != len(target_cols):
            raise ValueError(f"{len(data)} file columns for {len(target_cols)} target columns")
        return df.select(*[F.col(a).alias(b) for a, b in zip(data, target_cols)], *rest)
    if how == "name":
        return df.select(*target_cols, *rest)
    raise ValueError(f"unknown binding {how!r}")


def read_staged(spark: SparkSession, path, file_cols, *, target_cols=None, bind_by: str = "position",
                as_of=None, **reader_opts) -> DataFrame:
    """Scan staged CSV file(s) or a prefix into text columns plus audit columns.

    ``file_cols`` names the columns in file order; ``target_cols`` (default:
    the same) is the stage table's column list they are bound to.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if reader_opts.get("multi_line") and bind_by == "position":
        schema, opts = csv_format(file_cols, **{k: v for k, v in reader_opts.items() if k in ("on_error", "ragged")})
        raw = multiline.read_records(spark, paths, schema, opts, reader_opts.get("recursive", True))
        return bind(with_audit(raw, as_of).drop("_metadata"), list(target_cols or file_cols), bind_by)
    raw = csv_reader(spark, file_cols, **reader_opts).load(paths)
    if bind_by == "name":
        # Header names decide, and they must be the same in all files of one load:
        # a file with another header fails the job instead of filling wrong columns.
        hdr = spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(paths).columns
        raw = csv_reader(spark, hdr, **reader_opts).option("enforceSchema", "false").load(paths)
    audited = with_audit(raw, as_of)
    return bind(audited, list(target_cols or file_cols), bind_by)


def list_files(spark: SparkSession, path: str | list[str], content_key: str = "metadata") -> DataFrame:
    """Staged files under ``path``: (path, length, modification_time, file_key).

    Only file metadata is read unless ``content_key='md5'``.
    """
    lst = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    key = (F.md5("content") if content_key == "md5"
           else _key(F.col("path"), F.col("length"), F.col("modificationTime")))
    return lst.select(
        "path", "length",
        F.col("modificationTime").cast("timestamp_ntz").alias("modification_time"),
        key.alias("file_key"),
    )


def content_keys(spark: SparkSession, paths) -> DataFrame:
    """(path, content_key) of files: equal for equal bytes, however files are cut into ranges.

    Every line is hashed (twice, with different seeds) with its number in the
    file. Line numbers come from the counts of the ranges before; a range's digest
    is the exclusive or of its lines, a file's that of its ranges, with its length.
    """
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    at = [scanned_path().alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("start")]
    lines = text.select("value", *at, F.monotonically_increasing_id().alias("id"))
    counts = lines.groupBy("path", "size", "start").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("path", "size", "start", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("offset"))
    placed = lines.join(counts, ["path", "size", "start"]).withColumn("line", F.col("id") + F.col("offset"))
    # Tasks fold the lines of their ranges before anything is exchanged.
    folded = placed.groupBy("path", "size").agg(
        *[F.bit_xor(F.xxhash64(F.lit(seed), "line", F.col("value").cast("binary"))).alias(f"d{seed}") for seed in (1, 2)])
    return folded.select("path", F.concat_ws("-", F.lower(F.hex("d1")), F.lower(F.hex("d2")), F.col("size").cast("string")).alias("content_key"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a frame as staged CSV in the source file format (one header per file)."""
    df.write.mode(mode).options(**CSV_OPTIONS).option("quoteAll", "false").csv(path)
