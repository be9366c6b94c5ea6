"""Legacy ARC archives, their conversion to WARC, and WARC archives.

Archives are gzip files written by Spark's text writer, one record a row, and read back as whole
files, a record at a time by its declared length. ARC has two header lines: version 1 has URL, IP,
date, type and length; version 2 has status, checksum, location, offset and file name before the
length. The version block at the head of a file says which one it uses.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FILE_BYTES = 32 << 20
MIN_REVISIT_BYTES = 100
EMPTY = hashlib.sha256(b"").hexdigest()

# Names of the header fields in the version block of each ARC version.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def captures(pages: DataFrame, captured: str = "20240101000000") -> DataFrame:
    """HTTP responses of pages (page_id, url, html): page_id, url, ip, date, mime, block.

    The page's id is a header of the response. A null html is an empty payload; a null url is `-`,
    and white space in a url is written as %20, since it separates the header fields.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    page = F.coalesce(F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), page,
        F.lit("Content-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"),
    )
    url = F.coalesce(F.nullif(F.regexp_replace("url", r"\s", "%20"), F.lit("")), F.lit("-"))
    return pages.select(
        "page_id", url.alias("url"), F.lit("0.0.0.0").alias("ip"), F.lit(captured).alias("date"),
        F.lit("text/html").alias("mime"), F.concat(head, html).alias("block"),
    )


def write_arc(records: DataFrame, path: str, version: int = 1, file_bytes: int = FILE_BYTES) -> None:
    """Write url, ip, date, mime and block (string) as ARC files of about `file_bytes` each."""
    size = records.agg(F.sum(F.octet_length("block"))).first()[0] or 0
    length = F.octet_length("block").cast("string")
    more = [] if version == 1 else [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("-")]
    line = F.concat_ws(" ", "url", "ip", "date", "mime", *more, length)
    rows = records.select(F.concat(line, F.lit("\n"), F.col("block")).alias("value"))
    body = f"{version} 0 fleetwatt\n{ARC_FIELDS[version]}\n"
    extra = "" if version == 1 else " 200 - - 0 -"
    first = f"filedesc://archive.arc 0.0.0.0 20240101000000 text/plain{extra} {len(body)}\n{body}"

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, batch in enumerate(batches):
            if i == 0:
                yield pa.RecordBatch.from_arrays([pa.array([first], batch.schema.field(0).type)], schema=batch.schema)
            yield batch

    files = max(1, -(-size // file_bytes))
    headed_rows = rows.repartition(files, F.xxhash64("value")).mapInArrow(headed, "value string")
    headed_rows.write.option("lineSep", "\n").options(compression="gzip", **{"zlib.compress.level": "BEST_SPEED"}).text(path)


def _arc_records(stream) -> Iterator[tuple[list[str], bytes]]:
    """Header fields (always url, ip, date, mime, length) and content of each record of a file."""
    version = 1
    while line := stream.readline():
        if not line.strip():
            continue
        fields = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        length = int(fields[-1])
        content = stream.read(length)
        if len(content) < length:
            raise ValueError(f"ARC record of {length} bytes ends after {len(content)}")
        if fields[0].startswith("filedesc:"):
            version = int(content.split(b" ", 1)[0])
            continue
        if len(fields) != len(ARC_FIELDS[version].split()):
            raise ValueError(f"{len(fields)} header fields in an ARC file of version {version}")
        yield [*fields[:4], fields[-1]], content


def _http(block: bytes) -> tuple[dict[str, str], int]:
    """Header fields of an HTTP response and where its payload begins; (none, 0) for other content."""
    if not block.startswith(b"HTTP/"):
        return {}, 0
    end = block.find(b"\r\n\r\n")
    head = block if end < 0 else block[:end]
    lines = head.decode("latin-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, len(block) if end < 0 else end + 4


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def read_arc(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """Records of ARC files: url, ip, date, mime, page_id, header_bytes, payload_bytes,
    payload_digest (hex SHA-256), and block (null without `blocks`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                with gzip.open(io.BytesIO(content.as_py())) as stream:
                    rows: list[tuple] = []
                    held = 0
                    for fields, block in _arc_records(stream):
                        header, start = _http(block)
                        page = header.get("x-page-id")
                        digest = hashlib.sha256(memoryview(block)[start:]).hexdigest()
                        rows.append((*fields[:4], int(page) if page else None, start, len(block) - start, digest, block if blocks else None))
                        held += len(block)
                        if held > 4 << 20:
                            yield _batch(rows, ARC_SCHEMA)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, ARC_SCHEMA)

    return _files(spark, path).mapInArrow(
        run, "url string, ip string, date string, mime string, page_id bigint, header_bytes int, payload_bytes bigint, payload_digest string, block binary"
    )


ARC_SCHEMA = pa.schema(
    [("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()), ("page_id", pa.int64()),
     ("header_bytes", pa.int32()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("block", pa.binary())]
)
WARC_SCHEMA = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
     ("refers_to", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("digest_ok", pa.bool_()), ("payload", pa.binary())]
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def record_id(*parts: Column) -> Column:
    """A name-based UUID of what identifies a record: the same after every run."""
    h = F.sha1(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]).cast("binary"))
    cut = F.concat_ws(
        "-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12),
    )
    return F.concat(F.lit("<urn:uuid:"), cut, F.lit(">"))


def arc_to_warc(spark: SparkSession, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """ARC files as WARC records, one string each.

    Identifiers are name-based, dates keep the archive's seconds, HTTP responses become `response`
    and other content `resource`, and both digests are SHA-256. Of payloads of at least
    `min_bytes` that are equal, that of the smallest page_id is the response (all its rows, if it
    repeats) and the others are `revisit` records of it without payload. Records without a page id
    come last; if no record of a payload has one, all are responses. The groups are found on
    digests alone, pre-aggregated, so a payload that most pages share costs no more than others.
    """
    name = lambda: record_id(F.col("url"), F.col("date"), F.col("page_id"), F.col("payload_digest"))
    found = read_arc(spark, path, blocks=False).where(F.col("payload_bytes") >= min_bytes)
    first = (
        found.groupBy("payload_digest")
        .agg(F.min("page_id").alias("_first"), F.min_by(F.struct("url", "date"), F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("_of"), F.count("*").alias("_n"))
        .where((F.col("_n") > 1) & F.col("_first").isNotNull())
        .select("payload_digest", "_first", record_id(F.col("_of.url"), F.col("_of.date"), F.col("_first"), F.col("payload_digest")).alias("_target"))
    )
    joined = read_arc(spark, path).join(first, "payload_digest", "left")
    revisit = F.col("_first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("_first"))) & (F.col("payload_bytes") >= min_bytes)
    http = F.col("header_bytes") > 0
    kept = F.when(revisit, F.substring(F.col("block"), F.lit(1), F.col("header_bytes"))).otherwise(F.col("block"))
    iso = F.regexp_replace("date", r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1-$2-$3T$4:$5:$6Z")
    kind = F.when(revisit, "revisit").when(http, "response").otherwise("resource")
    mime = F.when(http, F.lit("application/http; msgtype=response")).otherwise(F.col("mime"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), kind,
        F.lit("\r\nWARC-Record-ID: "), name(),
        F.lit("\r\nWARC-Date: "), iso,
        F.lit("\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-IP-Address: "), F.col("ip"),
        F.lit("\r\nContent-Type: "), mime,
        F.lit("\r\nWARC-Block-Digest: sha256:"), F.sha2(kept, 256),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), F.col("_target"))).otherwise(""),
        F.lit("\r\nContent-Length: "), F.octet_length(kept).cast("string"), F.lit("\r\n\r\n"),
    )
    return joined.select(F.concat(head, kept.cast("string")).alias("value"))


def write_warc(records: DataFrame, path: str) -> None:
    """Write records as gzip WARC files; two line ends close each of them."""
    records.select("value").write.option("lineSep", "\r\n\r\n").options(compression="gzip", **{"zlib.compress.level": "BEST_SPEED"}).text(path)


def _warc_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        header = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            header[k.strip().lower()] = v.strip()
        length = int(header["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"WARC record of {length} bytes ends after {len(block)}")
        yield header, block


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of WARC files. digest_ok: the block digest holds. A revisit has no payload; its
    payload_bytes come from the stored response header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                with gzip.open(io.BytesIO(content.as_py())) as stream:
                    rows: list[tuple] = []
                    held = 0
                    for header, block in _warc_records(stream):
                        http, start = _http(block)
                        page, revisit = http.get("x-page-id"), header["warc-type"] == "revisit"
                        size = int(http.get("content-length", 0)) if revisit else len(block) - start
                        ok = header.get("warc-block-digest") == f"sha256:{hashlib.sha256(block).hexdigest()}"
                        digest = header.get("warc-payload-digest", "").removeprefix("sha256:")
                        rows.append(
                            (header["warc-record-id"], header["warc-type"], header.get("warc-target-uri"), header.get("warc-date"),
                             header.get("warc-refers-to"), int(page) if page else None, size, digest, ok,
                             block[start:] if payloads and not revisit else None)
                        )
                        held += len(block)
                        if held > 4 << 20:
                            yield _batch(rows, WARC_SCHEMA)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows, WARC_SCHEMA)

    return _files(spark, path).mapInArrow(
        run,
        "record_id string, record_type string, target_uri string, date string, refers_to string, page_id bigint, "
        "payload_bytes bigint, payload_digest string, digest_ok boolean, payload binary",
    )


def refer_pages(records: DataFrame) -> DataFrame:
    """Adds refers_to_page: the page id of the record that a revisit refers to."""
    targets = records.where("record_type <> 'revisit'").groupBy(F.col("record_id").alias("_id")).agg(F.first("page_id").alias("refers_to_page"))
    return records.join(targets, F.col("refers_to") == F.col("_id"), "left").drop("_id")
