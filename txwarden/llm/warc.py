"""Web archives: write captures as WARC files, read them back, assemble transactions.

A capture is up to three records: the response (or a revisit of an earlier response with the
same payload), the request and a metadata record, tied together by WARC-Concurrent-To.
Writing uses Spark's text writer, whose line separator is the CRLF CRLF that ends a record;
reading walks each archive by Content-Length, so payloads may hold any bytes.

Defined cases: a null payload is an empty one; a null URL becomes ``urn:page:ID`` and white
space in a URL becomes ``%20``; a null id sorts after all ids, and a group of equal payloads
whose ids are all null consists of responses; rows that repeat the smallest id of a group are
all responses and all come back, one row each; an empty table writes an archive without
records. Columns other than the three named ones are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txwarden.functions.shipping import ship_package
from txwarden.functions.staging import quoted

#: Bytes of records, before compression, that one archive file should hold.
ARCHIVE_BYTES = 32 << 20
#: Bytes that the reader decompresses at a time.
READ_BYTES = 1 << 20
RECORD_END = "\r\n\r\n"

# The digits of base 32 as numbers are written and as RFC 4648 writes them.
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RFC_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("concurrent_to", T.ArrayType(T.StringType())),
        T.StructField("refers_to", T.StringType()),
        T.StructField("stated_digest", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1: eight groups of 20 bits, four digits each."""
    digits = [
        F.lpad(F.conv(F.substring(F.sha1(payload), 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*digits), DIGITS, RFC_DIGITS)


def urn(kind: str, *parts: Column) -> Column:
    """Record id derived from what the record holds, so that reruns agree."""
    h = F.md5(F.concat_ws("\x1f", F.lit(kind), *parts))
    at = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(
        F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in at]), F.lit(">")
    )


def record(headers: list[tuple[str, Column | str | None]], block: Column) -> Column:
    """Text of a record; headers whose value is null are left out."""
    lines = [
        F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value))
        for name, value in headers
        if value is not None
    ]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(
        F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines, size), F.lit("\r\n\r\n"), block
    )


def captures(pages: DataFrame, id_col: str, url_col: str, body_col: str) -> DataFrame:
    """Per page: id, url, payload, its digest and the smallest id with the same payload. Groups
    of one are not joined; the join's left side may be split where a payload is frequent."""
    base = pages.select(
        F.col(quoted(id_col)).alias("id"),
        F.col(quoted(url_col)).cast("string").alias("url"),
        F.coalesce(F.col(quoted(body_col)).cast("string"), F.lit("")).alias("payload"),
    )
    base = base.withColumn("digest", base32_sha1(F.col("payload").cast("binary"))).withColumn(
        "size", F.octet_length("payload").cast("long")
    )
    groups = (
        base.groupBy("digest", "size")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("first_id").isNotNull())
        .drop("n")
    )
    return base.join(groups, ["digest", "size"], "left")


def write_warc(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    date: str = "2026-01-01T00:00:00Z",
) -> None:
    """Write every page as three records into gzip-compressed archives under ``path``."""
    sizes = pages.agg(
        F.count(F.lit(1)), F.sum(F.octet_length(F.col(quoted(body_col)).cast("string")))
    ).first()
    mean = (sizes[1] or 0) // max(sizes[0], 1) + 1500
    per_file = 3 * max(1, ARCHIVE_BYTES // mean)

    c = captures(pages, id_col, url_col, body_col)
    key = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    url = F.coalesce(
        F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.concat(F.lit("urn:page:"), key)
    )
    again = F.col("first_id").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first_id")))
    c = c.select("*", key.alias("key"), url.alias("uri"), again.alias("again"))
    own = urn("response", F.col("key"), F.col("digest"))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    status = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"),
        F.lit("\r\n\r\n"),
    )
    first = F.col("first_id").cast("string")
    common = [("WARC-Date", date), ("WARC-Target-URI", F.col("uri"))]
    http = [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest)]
    response = record(
        [("WARC-Type", "response"), ("WARC-Record-ID", own), *common, *http],
        F.concat(status, F.col("payload")),
    )
    revisit = record(
        [
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", own),
            *common,
            *http,
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", urn("response", first, F.col("digest"))),
        ],
        status,
    )
    request = record(
        [
            ("WARC-Type", "request"),
            ("WARC-Record-ID", urn("request", F.col("key"), F.col("digest"))),
            *common,
            ("WARC-Concurrent-To", own),
            ("Content-Type", "application/http; msgtype=request"),
        ],
        F.concat(F.lit("GET "), F.col("uri"), F.lit(" HTTP/1.1\r\n\r\n")),
    )
    metadata = record(
        [
            ("WARC-Type", "metadata"),
            ("WARC-Record-ID", urn("metadata", F.col("key"), F.col("digest"))),
            *common,
            ("WARC-Concurrent-To", own),
            ("Content-Type", "application/warc-fields"),
        ],
        F.coalesce(
            F.concat(F.lit("page-id: "), F.col("id").cast("string"), F.lit("\r\n")), F.lit("")
        ),
    )
    texts = F.array(F.when(F.col("again"), revisit).otherwise(response), request, metadata)
    (
        c.select(F.explode(texts).alias("value"))
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", per_file)
        .text(path)
    )


class Stream:
    """Bytes of an archive, decompressed as they are asked for. ``at`` is the place reached in
    ``held``, the bytes at hand."""

    def __init__(self, data: memoryview):
        self.data, self.read, self.held, self.at = data, 0, b"", 0
        self.zip = zlib.decompressobj(31) if bytes(data[:2]) == b"\x1f\x8b" else None

    def more(self) -> bool:
        """Have more bytes at hand, and drop those passed."""
        while self.read < len(self.data):
            piece = self.data[self.read : self.read + READ_BYTES]
            if self.zip is None:
                self.read += len(piece)
                got = bytes(piece)
            else:
                got = self.zip.decompress(piece)
                self.read += len(piece) - len(self.zip.unused_data)
                if self.zip.eof:  # one member for each record is as good as one for all
                    self.zip = zlib.decompressobj(31)
            if got:
                self.held, self.at = self.held[self.at :] + got, 0
                return True
        return False

    def head(self) -> bytes | None:
        """Header lines up to an empty line; None at the end of the archive."""
        while True:
            while self.held[self.at : self.at + 2] == b"\r\n":
                self.at += 2
            end = self.held.find(b"\r\n\r\n", self.at)
            if end >= 0:
                head, self.at = self.held[self.at : end], end + 4
                return head
            if not self.more():
                if self.held[self.at :].strip():
                    raise ValueError("an archive ends inside a record header")
                return None

    def take(self, n: int) -> bytes:
        parts, have = [], 0
        while have < n:
            part = self.held[self.at : self.at + n - have]
            self.at += len(part)
            have += len(part)
            parts.append(part)
            if have < n and not self.more():
                raise ValueError("an archive ends inside a record")
        return parts[0] if len(parts) == 1 else b"".join(parts)


def lines(block: bytes) -> list[tuple[str, str]]:
    """Name and value of header or field lines; names in lower case."""
    pairs = (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if ":" in x)
    return [(name.strip().lower(), value.strip()) for name, _, value in pairs]


def parse(data: memoryview, with_payload: bool) -> Iterator[dict]:
    """The records of an archive."""
    stream = Stream(data)
    while (head := stream.head()) is not None:
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {head[:40]!r}")
        pairs = lines(head.partition(b"\r\n")[2])
        named = dict(pairs)
        block = stream.take(int(named["content-length"]))
        kind, payload, fields = named.get("warc-type"), None, None
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
        elif kind == "metadata":
            fields = lines(block)
        elif kind not in ("revisit", "request"):
            payload = block
        yield {
            "record_id": named.get("warc-record-id"),
            "type": kind,
            "target_uri": named.get("warc-target-uri"),
            "concurrent_to": [v for k, v in pairs if k == "warc-concurrent-to"],
            "refers_to": named.get("warc-refers-to"),
            "stated_digest": named.get("warc-payload-digest", "").rpartition(":")[2] or None,
            "payload_digest": None
            if payload is None
            else base64.b32encode(hashlib.sha1(payload).digest()).decode(),
            "payload_bytes": None if payload is None else len(payload),
            "fields": fields,
            "payload": payload if with_payload else None,
        }


def read_warc(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """All records of the archives under ``path``. Without ``payload`` its digest and size are
    still those of the bytes read, but the bytes are not passed on."""
    ship_package(spark)
    schema = pa.schema(
        [
            (f.name, pa.string())
            for f in RECORD.fields[:3]
        ]
        + [
            ("concurrent_to", pa.list_(pa.string())),
            ("refers_to", pa.string()),
            ("stated_digest", pa.string()),
            ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()),
            ("fields", pa.map_(pa.string(), pa.string())),
            ("payload", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for row in parse(memoryview(content.as_buffer()), payload):
                    rows.append(row)
                    held += 500 + len(row["payload"] or b"")
                    if held > READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit, and the arrays ``requests`` and
    ``metadata`` of the records concurrent to it, whichever side names the other. Repeated pages
    have equal records with one id; each of their captures has such a record once."""
    inner = F.struct("record_id", "target_uri", "fields", "payload")
    hubs = records.filter(F.col("type").isin("response", "revisit"))
    members = records.filter(F.col("type").isin("request", "metadata"))
    named = members.select(F.explode("concurrent_to").alias("hub"), "type", inner.alias("member"))
    naming = hubs.select(F.col("record_id").alias("hub"), F.explode("concurrent_to").alias("named"))
    back = members.join(naming, F.col("record_id") == F.col("named")).select(
        "hub", "type", inner.alias("member")
    )
    of = lambda kind: F.collect_list(F.when(F.col("type") == kind, F.col("member")))
    # a record that was written several times, for repeated pages, is one
    once = named.union(back).groupBy("hub", "type", F.col("member.record_id").alias("own")).agg(F.first("member").alias("member"))
    around = once.groupBy("hub").agg(of("request").alias("requests"), of("metadata").alias("metadata"))
    out = hubs.join(around, hubs["record_id"] == around["hub"], "left")
    none = F.array().cast(around.schema["requests"].dataType)
    return out.select(
        "record_id",
        "type",
        "target_uri",
        F.struct("refers_to", "stated_digest", "payload_digest", "payload_bytes", "payload").alias("response"),
        F.coalesce("requests", none).alias("requests"),
        F.coalesce("metadata", none).alias("metadata"),
    )


def resolve_revisits(transactions: DataFrame) -> DataFrame:
    """Adds ``page`` (the id in the metadata), and the payload size, digest and page of the
    response that a revisit stands for."""
    t = transactions.withColumn("page", F.col("metadata")[0]["fields"]["page-id"])
    origin = (
        t.filter(F.col("type") == "response")
        .groupBy(F.col("record_id").alias("origin"))
        .agg(
            F.min("page").alias("origin_page"),
            F.max("response.payload_bytes").alias("origin_bytes"),
            F.max("response.payload_digest").alias("origin_digest"),
        )
    )
    # Only rows that refer to something are joined; the others would all meet at a null key.
    refers = F.col("response.refers_to").isNotNull()
    joined = t.filter(refers).join(origin, F.col("response.refers_to") == F.col("origin"), "left")
    return joined.drop("origin").unionByName(t.filter(~refers), allowMissingColumns=True)
