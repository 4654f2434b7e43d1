"""WARC archives: writing pages as request, response or revisit, and metadata records, and assembling them again.

The archives are gzip files of WARC/1.1 records written by Spark's text writer: the blank line that ends a record is
its line separator.  Reading takes each file's bytes, walks its records by Content-Length, and joins requests and
metadata to the response or revisit record that their WARC-Concurrent-To names: one nested row a capture.
"""
from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import shared_path, written

CRLF = "\r\n"
LEAST_REVISIT = 1000            # bytes from which an equal payload is not stored again
FILE_BYTES = 32 << 20           # payload bytes in a file, about
LARGE_PAGES = (1 << 20, 16 << 20)   # pages above these sizes have files of their own: of two pages, and of one
SMALL_TABLE = 50_000            # duplicate groups up to which their table is broadcast
EPOCH = "1970-01-01T00:00:00Z"  # the pages have no capture time

RECORD = T.StructType([T.StructField(n, T.LongType() if n in ("payload_bytes", "block_bytes") else
                                     T.BinaryType() if n == "payload" else
                                     T.MapType(T.StringType(), T.StringType()) if n == "fields" else T.StringType())
                       for n in ("type", "record_id", "concurrent_to", "refers_to", "target_uri", "date",
                                 "payload_digest", "payload_bytes", "block_bytes", "payload", "fields")])


def record_id(kind: str, *parts: Column) -> Column:
    """A URN from the MD5 of what tells the record from all others."""
    text = F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts])
    h = F.md5(text.cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def header(*fields: tuple[str, Column | str | None]) -> Column:
    """Header lines; a field whose value is null is left out."""
    lines = [F.concat(F.lit(f"{name}: "), v if isinstance(v, Column) else F.lit(v)) for name, v in fields]
    return F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines)


def captures(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """One row a page: page_id, url, payload, digest, bytes, and nth, which numbers pages alike in all of these."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
                        payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn(
        "bytes", F.octet_length("payload").cast("long")).withColumn("nth", F.lit(1).cast("long"))
    again = written(rows.groupBy("page_id", "url", "digest").agg(F.count("*").alias("copies")).where("copies > 1"), "warc")
    if again.isEmpty():
        return rows
    # repeated rows: one of them with their number, told apart by counting
    copies = again.select(F.struct("page_id", "url", "digest").alias("k"), "copies")
    key = F.struct("page_id", "url", "digest")
    rest = rows.join(copies, key.eqNullSafe(F.col("k")), "left_anti")
    first = (rows.join(copies, key.eqNullSafe(F.col("k"))).groupBy("page_id", "url", "digest")
             .agg(F.first("payload").alias("payload"), F.first("bytes").alias("bytes"), F.first("copies").alias("copies")))
    return rest.unionByName(first.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies"))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   least: int = LEAST_REVISIT) -> None:
    """Write three records a page below ``path``: request, response or revisit, metadata.

    Of pages with equal payloads of at least ``least`` bytes, the one with the largest page_id (on a tie: the largest
    url, the first of equal rows) is a response and the others revisit it; smaller payloads are all responses.
    Null html is an empty payload; a null url leaves the target out; a null page_id sorts first.
    """
    rows = captures(pages, page_id, url, html)
    groups = written(rows.where(F.col("bytes") >= least).groupBy("digest").agg(
        F.max(F.struct("page_id", "url")).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "warc")
    few = groups.count() <= SMALL_TABLE
    steps = [0, *LARGE_PAGES, 1 << 62]
    within = [(F.col("bytes") <= hi) & (F.col("bytes") > lo if lo else F.lit(True)) for lo, hi in zip(steps, steps[1:])]
    sizes = rows.agg(*[F.count_if(w).alias(f"n{i}") for i, w in enumerate(within)], F.avg(F.when(within[0], F.col("bytes"))).alias("mean")).first()
    in_file = [int(FILE_BYTES // max(sizes["mean"] or 0, 1)), *[max(1, FILE_BYTES // hi) for hi in steps[2:]]]
    rows = rows.join(F.broadcast(groups) if few else groups, "digest", "left")
    is_first = F.struct("page_id", "url").eqNullSafe(F.col("first")) & (F.col("nth") == 1)
    revisit = F.col("first").isNotNull() & ~is_first
    me = [F.col("page_id"), F.col("url"), F.col("digest"), F.col("nth")]
    capture, digest = record_id("capture", *me), F.concat(F.lit("sha1:"), F.col("digest"))
    target = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    http = F.concat(F.lit(CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])),
                    F.col("bytes").cast("string"), F.lit(CRLF * 2))
    asked = F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(f" HTTP/1.1{CRLF * 2}"))
    told = F.concat_ws(CRLF, F.concat(F.lit("page-id: "), F.col("page_id").cast("string")),
                       F.concat(F.lit("payload-bytes: "), F.col("bytes").cast("string")))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))

    def record(kind, rid, body, *more):
        return F.concat(header(("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", EPOCH), ("WARC-Target-URI", target),
                               *more, ("Content-Length", F.octet_length(body).cast("string"))), F.lit(CRLF * 2), body)
    records = F.array(
        record("request", record_id("request", *me), asked, ("WARC-Concurrent-To", capture),
               ("Content-Type", "application/http; msgtype=request")),
        record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), capture, block,
               ("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Refers-To", F.when(revisit, record_id("capture", F.col("first.page_id"), F.col("first.url"), F.col("digest"),
                                                            F.lit(1)))),
               ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))),
        record("metadata", record_id("metadata", *me), told, ("WARC-Concurrent-To", capture),
               ("Content-Type", "application/warc-fields")))
    for i, pages_a_file in enumerate(in_file):
        if i == 0 or sizes[f"n{i}"]:                     # large pages are a second pass only where there are some
            (rows.where(within[i]).select(F.explode(records).alias("value")).write.mode("append").option("lineSep", CRLF * 2)
             .option("compression", "gzip").option("maxRecordsPerFile", 3 * max(1, pages_a_file)).text(path))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode().split(CRLF)[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        at = end + 4 + int(fields["content-length"])
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record without an end at byte {at}")
        yield fields, data[end + 4:at]
        at += 4


def row_of(fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    kind, size, digest, payload, more = fields.get("warc-type"), None, fields.get("warc-payload-digest"), None, None
    if kind == "response":
        payload = block[block.find(b"\r\n\r\n") + 4:]
        found = "sha1:" + hashlib.sha1(payload).hexdigest()
        if digest not in (None, found):
            raise ValueError(f"digest of {fields.get('warc-record-id')} does not match its payload")
        digest, size = found, len(payload)
    elif kind == "revisit":
        http = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in block.decode().split(CRLF))}
        size = int(http["content-length"]) if "content-length" in http else None
    elif kind == "metadata":
        more = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode().split(CRLF) if x)]
    return {"type": kind, "record_id": fields.get("warc-record-id"), "concurrent_to": fields.get("warc-concurrent-to"),
            "refers_to": fields.get("warc-refers-to"), "target_uri": fields.get("warc-target-uri"),
            "date": fields.get("warc-date"), "payload_digest": digest, "payload_bytes": size, "block_bytes": len(block),
            "payload": payload if payloads else None, "fields": more}


def read_records(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """All records of the archives below ``path`` (gzip or plain); a broken record or digest raises."""
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(RECORD)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows, held = [], 0
                for fields, block in parse_records(data):
                    rows.append(row_of(fields, block, payloads))
                    held += len(block) if payloads else 0
                    if len(rows) >= 5000 or held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each response and revisit record: capture (struct), request (struct), metadata (map), and
    refers_to_metadata, the metadata of the capture that a revisit refers to.

    Requests and metadata are joined by their concurrent-to identifier; of several for one capture, that with the
    smallest record id counts.  A capture without them has nulls; ones without a capture belong to no transaction.
    """
    records = written(records, "warc")
    cols = ["type", "record_id", "target_uri", "date", "payload_digest", "payload_bytes", "refers_to", "payload"]
    found = records.where("type in ('response', 'revisit')").select(F.col("record_id").alias("id"), F.struct(*cols).alias("capture"))
    part = {kind: records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull()).groupBy("concurrent_to")
            .agg(F.min_by(F.struct("record_id", "target_uri", "block_bytes", "fields"), "record_id").alias(kind))
            .withColumnRenamed("concurrent_to", f"{kind}_of") for kind in ("request", "metadata")}
    rows = (found.join(part["request"], F.col("id") == F.col("request_of"), "left")
            .join(part["metadata"], F.col("id") == F.col("metadata_of"), "left")
            .select("id", "capture", "request", F.col("metadata.fields").alias("metadata")))
    rows = written(rows, "warc")
    plain = rows.where("capture.refers_to is null").withColumn("refers_to_metadata", F.lit(None).cast("map<string,string>"))
    revisits = rows.where("capture.refers_to is not null")
    origin = rows.where("capture.type = 'response'").select(F.col("id").alias("origin"), F.col("metadata").alias("refers_to_metadata"))
    again = revisits.join(origin, F.col("capture.refers_to") == F.col("origin"), "left").drop("origin")
    return plain.unionByName(again).drop("id")


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the archives of ``pages`` in the shared folder, read them back and assemble their captures.

    Every row is a capture, repeated rows too; an empty table gives no rows; other columns are ignored.
    """
    path = shared_path(pages.sparkSession, "warc")
    write_archives(pages, path, page_id, url, html)
    return assemble(read_records(pages.sparkSession, path))
