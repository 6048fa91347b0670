"""WARC archives: write captures as request, response and metadata records, read them
back, and join each capture's records into one nested row.

Records of a capture name each other by WARC-Concurrent-To. A payload that several
captures share is stored once, with the capture of the largest id; the others become
revisit records that refer to it. Archives are written by Spark's text writer, whose line
separator is the end of a WARC record, so they need nothing but the cluster's file system.
"""

from __future__ import annotations

import base64
import hashlib
import io
from collections.abc import Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.shared import shared_folder, written

END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string, "
    "fields map<string,string>, http_fields map<string,string>, payload_bytes long, payload_digest string, payload binary"
)


def _urn(kind: str, key: Column) -> Column:
    """A record id that a retried task makes again: a name-based UUID form."""
    h = F.md5(F.concat_ws("|", F.lit(kind), key))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def base32_of_hex(digest: Column) -> Column:
    """Base32 of 40 hex digits: each five of them are four letters."""
    parts = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _lines(*fields: tuple[str, Column | str | None]) -> Column:
    """Header lines; a field whose value is null is left out."""
    return F.concat_ws(
        "\r\n", *(F.concat(F.lit(f"{k}: "), v if isinstance(v, Column) else F.lit(v)) for k, v in fields)
    )


def _size(block: Column) -> Column:
    return F.octet_length(block).cast("string")


def _record(head: Column, block: Column) -> Column:
    size = F.concat(F.lit("Content-Length: "), _size(block))
    return F.concat(F.lit("WARC/1.1\r\n"), head, F.lit("\r\n"), size, F.lit(END), block)


def write_captures(pages: DataFrame, path: str) -> None:
    """Write ``page_id, url, html`` as archives, one for each partition of the join.

    Which record refers to which is worked out on ids and digests alone; the payloads then move once, by page and
    digest, so that a group of copies spreads over all archives. Adaptive execution sizes the partitions. A null html
    is an empty payload; a null url has no target. Rows without id have an empty one. Repeated rows are written each,
    under one set of record ids.
    """
    pages = pages.select(
        F.col("page_id").cast("string").alias("id"),
        F.col("page_id").cast("long").alias("n"),
        # A line break or other control would end a header line.
        F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("sha1", F.sha1("html"))
    known = written(pages.groupBy("n", "sha1").agg(F.count("*").alias("c")), "warc-payloads")
    owners = known.groupBy("sha1").agg(F.max("n").alias("owner"), F.sum("c").alias("c"))
    owners = written(owners.where("c > 1 and owner is not null").select("sha1", "owner"), "warc-owners")
    later = known.join(owners, "sha1").where(~F.col("n").eqNullSafe(F.col("owner")))
    later = later.select(F.col("n").alias("_n"), F.col("sha1").alias("_sha1"), "owner")
    mine = F.col("n").eqNullSafe(F.col("_n")) & (F.col("sha1") == F.col("_sha1"))
    marked = pages.join(later, mine, "left").withColumn("again", F.col("owner").isNotNull())
    key, digest = F.coalesce("id", F.lit("")), F.concat(F.lit("sha1:"), F.col("digest"))
    main = _urn("response", key)
    http = _lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", F.octet_length("html").cast("string")))
    response_block = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), http, F.lit(END), F.when(F.col("again"), F.lit("")).otherwise(F.col("html")))
    response = _lines(
        ("WARC-Type", F.when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", main),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Payload-Digest", digest),
        ("WARC-Refers-To", F.when(F.col("again"), _urn("response", F.col("owner").cast("string")))),
        ("WARC-Profile", F.when(F.col("again"), F.lit(REVISIT))),
        ("X-Page-Id", F.col("id")),
        ("X-Refers-To-Page", F.when(F.col("again"), F.col("owner").cast("string"))),
        ("Content-Type", "application/http; msgtype=response"),
    )
    request_block = F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1" + END))
    request = _lines(
        ("WARC-Type", "request"),
        ("WARC-Record-ID", _urn("request", key)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Concurrent-To", main),
        ("Content-Type", "application/http; msgtype=request"),
    )
    metadata_block = _lines(("page-id", F.col("id")), ("via", F.col("url")))
    metadata = _lines(
        ("WARC-Type", "metadata"),
        ("WARC-Record-ID", _urn("metadata", key)),
        ("WARC-Date", DATE),
        # Names the request: a chain of two identifiers leads to the response.
        ("WARC-Concurrent-To", _urn("request", key)),
        ("Content-Type", "application/warc-fields"),
    )
    records = F.array(_record(request, request_block), _record(response, response_block), _record(metadata, metadata_block))
    (
        marked.withColumn("digest", base32_of_hex(F.col("sha1")))
        .select(F.explode(records).alias("value"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .text(path)
    )


def _fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; folded lines continue the one before."""
    out: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and last:
            out[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = name.strip().lower()
            out[last] = value.strip()
    return out


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an uncompressed archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = []
        while (line := stream.readline()).strip():
            head.append(line)
        fields = _fields(b"".join(head))
        yield fields, stream.read(int(fields.get("content-length", 0)))


class _Pieces(io.RawIOBase):
    """The bytes of an archive from its pieces between separators."""

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.rest = chain.from_iterable((p, END.encode()) for p in pieces), memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self.rest:
            piece = next(self.pieces, None)
            if piece is None:
                return 0
            self.rest = memoryview(piece)
        n = min(len(buffer), len(self.rest))
        buffer[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> list:
    http, body = {}, block
    if fields.get("content-type", "").startswith("application/http"):
        head, _, body = block.partition(b"\r\n\r\n")
        http = _fields(head)
    size, digest = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
    if fields.get("warc-type") == "revisit":
        stated = http.get("content-length", "")
        size = int(stated) if stated.isdigit() else None
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    names = [fields.get(f"warc-{c}") for c in ("record-id", "type", "concurrent-to", "refers-to", "target-uri")]
    return [*names, list(fields.items()), list(http.items()), size, digest, body if payloads else None]


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in a folder, gzip (``*.gz``) or plain (``*.warc``), one task per file at most.

    Spark's text reader unpacks a gzip archive as a stream of pieces between record ends, which a task puts together
    again by the lengths that the records state: it holds a batch of pieces, never a whole archive. It
    would split plain archives between tasks, so these come whole and must be below 2 GB.

    ``payload_bytes`` and ``payload_digest`` (base32 SHA-1) are of the payload as stored; for
    a revisit they are those that its header fields state. Without ``payloads`` the column
    ``payload`` is null.
    """
    kind = pa.schema(
        [(c, pa.string()) for c in ("record_id", "type", "concurrent_to", "refers_to", "target_uri")]
        + [(c, pa.map_(pa.string(), pa.string())) for c in ("fields", "http_fields")]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    )

    def out(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = ((f.as_py(), p.as_py()) for batch in batches for f, p in zip(batch.column("file"), batch.column("piece")))
        rows, held = [], 0
        for _, mine in groupby(pieces, lambda x: x[0]):
            for fields, block in parse_records(io.BufferedReader(_Pieces(p for _, p in mine), 1 << 16)):
                rows.append(_row(fields, block, payloads))
                held += 500 + (len(block) if payloads else 0)
                if held > 4 << 20:
                    yield out(rows)
                    rows, held = [], 0
        if rows:
            yield out(rows)

    lines = spark.read.option("lineSep", END).option("pathGlobFilter", "*.gz").text(path)
    pieces = lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))
    plain = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc").load(path)
    return pieces.union(plain.select(F.xxhash64("path"), "content")).mapInArrow(parse, RECORD)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: ``record_id, target_uri, response, request, metadata``.

    A request or metadata record belongs to the capture that WARC-Concurrent-To leads to,
    directly or over one other record. Several metadata records are an array, in the order
    of their ids; of several requests the one with the smallest id stays. Records whose
    identifiers lead nowhere belong to no capture. ``records`` should be a written table.
    """
    main = records.where(F.col("type").isin("response", "revisit", "resource"))
    sides = records.where(F.col("type").isin("request", "metadata") & F.col("concurrent_to").isNotNull())
    links = records.where(F.col("concurrent_to").isNotNull()).select(
        F.col("record_id").alias("concurrent_to"), F.col("concurrent_to").alias("beyond")
    ).where("concurrent_to is not null").groupBy("concurrent_to").agg(F.min("beyond").alias("beyond"))
    side = F.struct("record_id", "type", "target_uri", "fields", "http_fields", "payload_bytes", "payload_digest", "payload")
    # A main record names nobody here, so the last identifier of the chain is the capture.
    grouped = (
        sides.join(links, "concurrent_to", "left")
        .groupBy(F.coalesce("beyond", "concurrent_to").alias("record_id"))
        .agg(
            F.min_by(F.when(F.col("type") == "request", side), F.when(F.col("type") == "request", F.col("record_id"))).alias("request"),
            F.array_sort(F.collect_list(F.when(F.col("type") == "metadata", _comparable())), _by_id).alias("metadata"),
        )
    )
    whole = F.struct("type", "refers_to", "fields", "http_fields", "payload_bytes", "payload_digest", "payload")
    return main.select("record_id", "target_uri", whole.alias("response")).join(grouped, "record_id", "left")


def _comparable() -> Column:
    return F.struct("record_id", "fields", "payload_bytes", "payload_digest", "payload")


def _by_id(a: Column, b: Column) -> Column:
    return F.when(a["record_id"] < b["record_id"], -1).when(a["record_id"] > b["record_id"], 1).otherwise(0)


def archived(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """Write pages as archives in the shared folder, read them back, one row per capture."""
    spark = pages.sparkSession
    path = shared_folder(spark, "warc")
    write_captures(pages, path)
    return captures(written(read_records(spark, path, payloads), "warc-records"))
