"""Seekable Zstandard bundles of WARC records (operator 6).

Pages are written as WARC records into bundles (``*.warc.zst``). A bundle holds
independent Zstandard frames of a bounded number of payload bytes each, and ends
with a skippable frame that is the seek table (sizes of all frames, in the
public seekable format). The index maps each record to bundle, frame and the
offset inside the decompressed frame, so one record is read by fetching one
frame: ``read_back`` does that for all of them, ``read_record`` for one.

Of pages with equal payload digests the one with the smallest id is written as
a response and the others as revisit records that refer to it, if the payload
has at least ``LEAST_BYTES`` bytes. Digests are grouped in Spark without the
payloads; a payload that fills a third of the table is one group of small rows,
pre-aggregated and joined with skew handling.

Bundles go to the shared folder, under names no other attempt uses, through the
file system that the folder's address names. Only bundles of tasks that ended
well are in the index, which Spark commits as Parquet, so a lost executor or a
second attempt leaves at most a file that nobody reads.

Null html is an empty payload; null url an empty target. Rows with a null id
take no part. Rows that repeat an id are separate records; rows that repeat id
and payload are all responses if the id is the smallest. An empty table
gives no bundle and an empty result. Columns other than id, url and html are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import arrow_map, ship, staged, table
from tierflow.session import unique_scratch

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
READ_BYTES = 16 << 20
LEAST_BYTES = 0
LEVEL = 3
# Fixed values of the seekable format: frame magic, footer magic.
SKIPPABLE, FOOTER = 0x184D2A5E, 0x8F92EAB1
INDEX = ("page_id long, n long, bundle string, frame int, frame_at long, frame_bytes long, record_at long, record_bytes long")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; the payload of a revisit is left out."""
    body = b"" if refers_to is not None else payload
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Target-URI: {re.sub(r'[\r\n]+', ' ', url)}",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; ``payload`` is None for a revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    number = re.compile(r"<urn:page:(-?\d+)>")
    out = {"page_id": int(number.match(fields["WARC-Record-ID"])[1]), "type": fields["WARC-Type"], "url": fields["WARC-Target-URI"],
           "digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "bytes": size, "refers_to": None, "payload": payload}
    if out["type"] == "revisit":
        out |= {"refers_to": int(number.match(fields["WARC-Refers-To"])[1]), "payload": None}
    elif len(payload) != size or digest_of(payload) != out["digest"]:
        raise ValueError("payload does not match its record")
    return out


class BundleWriter:
    """Collects records into frames and writes the seek table at the end."""

    def __init__(self, sink):
        import zstandard

        self.sink, self.pack = sink, zstandard.ZstdCompressor(level=LEVEL)
        self.open, self.sizes, self.at, self.waiting = io.BytesIO(), [], 0, []

    def add(self, key, data: bytes) -> list:
        """Index rows that became final: those of a frame that this record fills."""
        self.waiting.append((key, self.open.tell(), len(data)))
        self.open.write(data)
        return self.flush() if self.open.tell() >= FRAME_BYTES else []

    def flush(self) -> list:
        plain = self.open.getvalue()
        if not plain:
            return []
        packed = self.pack.compress(plain)
        self.sink.write(packed)
        rows = [(*key, len(self.sizes), self.at, len(packed), at, size) for key, at, size in self.waiting]
        self.sizes.append((len(packed), len(plain)))
        self.at += len(packed)
        self.open, self.waiting = io.BytesIO(), []
        return rows

    def close(self) -> list:
        rows = self.flush()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, FOOTER)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.sink.close()
        return rows


def seek_table(source, size: int) -> list[tuple[int, int, int]]:
    """(offset, packed size, plain size) of each frame, from the footer."""
    source.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != FOOTER:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    source.seek(size - 9 - n * width)
    raw, at, out = source.read(n * width), 0, []
    for i in range(n):
        packed, plain = struct.unpack_from("<II", raw, i * width)
        out.append((at, packed, plain))
        at += packed
    return out


def file_system(folder: str):
    """The file system of an address and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def digests(pages: DataFrame) -> DataFrame:
    """(page_id, digest, size): one small row per page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.filter("page_id is not null").select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("digest"),
                                                      F.length(payload).alias("size"))


def roles(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(digest, first): the page that the others of a repeated payload refer to."""
    return (digests(pages).filter(F.col("size") >= least_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"))


def write(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write the bundles; the index of all records, committed in ``folder``/index."""
    spark = pages.sparkSession
    ship(spark)
    files, _ = file_system(folder)
    first = staged(roles(pages, least_bytes), "warc-first")
    light = digests(pages).join(first, "digest").select("page_id", "digest", "first")
    light = staged(light.distinct(), "warc-roles")
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = (pages.filter("page_id is not null")
            .select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("html"),
                    F.sha1(payload.cast("binary")).alias("digest"))
            .join(light, ["page_id", "digest"], "left").select("page_id", "url", "html", "first"))

    def run(batches):
        from pyspark import TaskContext

        files, path = file_system(folder)
        writer, name, done = None, None, 0
        ready = []

        def index():
            columns = list(zip(*ready))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in INDEX.split(", ")])

        def finish():
            nonlocal writer
            ready.extend(writer.close())
            writer = None

        n = 0
        for batch in batches:
            for page_id, url, html, first in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    name = f"{path}/bundle-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(files.open_output_stream(name, compression=None))
                    done = 0
                data = html.encode("utf-8", "surrogatepass")
                refers = first if first != page_id else None
                ready.extend(writer.add((page_id, n, name), record(page_id, url, data, digest_of(data), refers)))
                n += 1
                done += len(data)
                if done >= BUNDLE_BYTES:
                    finish()
                if len(ready) >= 5000:
                    yield index()
                    ready.clear()
        if writer is not None:
            finish()
        if ready:
            yield index()

    files.create_dir(file_system(folder)[1], recursive=True)
    arrow_map(rows, run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_frame(files, path: str, at: int, size: int) -> bytes:
    import zstandard

    with files.open_input_file(path) as source:
        source.seek(at)
        return zstandard.ZstdDecompressor().decompressobj().decompress(source.read(size))


def read_record(folder: str, entry) -> dict:
    """One record by its index row."""
    files, _ = file_system(folder)
    plain = read_frame(files, entry["bundle"], entry["frame_at"], entry["frame_bytes"])
    return parse(plain[entry["record_at"]:entry["record_at"] + entry["record_bytes"]])


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records.

    Index rows are dealt out by frame, so each frame is fetched and unpacked
    once, and checked against the seek table of its bundle.
    """

    def run(batches):
        files, _ = file_system(folder)
        table_of, held, plain = (None, None), None, b""
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if table_of[0] != row["bundle"]:
                    size = files.get_file_info(row["bundle"]).size
                    with files.open_input_file(row["bundle"]) as source:
                        table_of = (row["bundle"], seek_table(source, size))
                if held != (row["bundle"], row["frame"]):
                    at, packed, size = table_of[1][row["frame"]]
                    if (at, packed) != (row["frame_at"], row["frame_bytes"]):
                        raise ValueError("index and seek table differ")
                    held, plain = (row["bundle"], row["frame"]), read_frame(files, row["bundle"], at, packed)
                    if len(plain) != size:
                        raise ValueError("frame has another size than its entry")
                x = parse(plain[row["record_at"]:row["record_at"] + row["record_bytes"]])
                out.append((x["page_id"], x["bytes"], x["digest"], x["type"], x["refers_to"]))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    # A small index stands for large frames: the records' bytes say how many tasks read them, which AQE leaves as it is.
    size = index.agg(F.sum("record_bytes").alias("size")).first()["size"] or 0
    by_frame = index.repartition(max(1, -(-size // READ_BYTES)), "bundle", "frame").sortWithinPartitions("bundle", "frame", "record_at")
    return arrow_map(by_frame, run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = unique_scratch(spark, "warc")
    return read_back(write(table(spark, sf_dir, "pages"), folder), folder)


# Five hex digits of a SHA-1 are four digits in base 32.
ORACLE = """
with p as (select page_id, coalesce(html, '') as h from pages where page_id is not null),
d as (select page_id, strlen(h) as n, sha1(h) as x, min(page_id) over (partition by h) as first from p)
select page_id, cast(n as bigint) as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((cast('0x' || substr(x, cast(i // 4 * 5 + 1 as int), 5) as int) >> cast(15 - 5 * (i % 4) as int)) & 31), 1)), '') as payload_digest,
       case when first = page_id then 'response' else 'revisit' end as record_type,
       case when first <> page_id then first end as refers_to
from d
"""
