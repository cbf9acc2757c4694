"""WARC archives: writing with continuation records, and reassembly of what is read back.

Writing stays in the JVM. A page becomes an HTTP response in chunked transfer
framing inside a WARC record; a block over ``segment`` bytes is cut into
continuation records. Spark's text writer lays records end to end: its line
separator is the blank line that ends every WARC record. Files are committed as
any Spark output is, are compressed, and hold at most ``records`` records.

Reading parses each file by Content-Length, groups continuation records by
origin id, orders them by segment number, checks the total length and the
payload digest, and decodes the chunked framing.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pointloom.llm.shared import shared_path

#: Bytes of payload in a transfer chunk, bytes of block in a record, records of a file (16 MB of typical pages, 140 MB at most).
CHUNK, SEGMENT, RECORDS = 8192, 32_768, 4096
#: Payloads from so many bytes on are stored once.
REVISIT_FROM = 1000
CRLF = "\r\n"


def cut(data: str, size: int, framed: str) -> Column:
    """Array over the pieces of binary expression ``data``; ``framed`` is an expression of piece ``p``."""
    return F.expr(f"transform(sequence(0, greatest(0, cast((octet_length({data}) - 1) div {size} as int))), i -> {framed.replace('{p}', f'substring({data}, cast(i * {size} + 1 as int), {size})')})")


def with_revisits(pages: DataFrame, id_col: str, body_col: str, least: int = REVISIT_FROM) -> DataFrame:
    """Adds body (binary), payload_bytes, payload_digest and refers_to (null for a response).

    The digest's largest id is found by a grouped maximum, combined before its
    shuffle; only digests that more than one id has are joined back.
    """
    body = F.encode(F.coalesce(F.col(body_col), F.lit("")), "UTF-8")
    known = pages.withColumn("body", body).withColumn("payload_bytes", F.octet_length("body").cast("long")).withColumn("payload_digest", F.sha1("body"))
    shared = (
        known.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max(id_col).alias("keeper"), F.min(id_col).alias("other"), F.count("*").alias("n"))
        .where("n > 1")
        .select("payload_digest", "keeper")
    )
    held = known.join(shared, "payload_digest", "left")
    return held.withColumn("refers_to", F.when((F.col("payload_bytes") >= least) & (F.col("keeper") != F.col(id_col)), F.col("keeper"))).drop("keeper")


def record_text(held: DataFrame, id_col: str, uri_col: str | None, segment: int, chunk: int) -> DataFrame:
    """One row per WARC record: ``value`` is its header and block, without the closing blank line."""
    # chunks are cast to text byte by byte, so that one join lays them end to end
    framed = cut("body", chunk, f"concat(hex(octet_length({{p}})), '{CRLF}', cast({{p}} as string), '{CRLF}')")
    head = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Transfer-Encoding: chunked{CRLF}{CRLF}"
    uri = F.regexp_replace(F.coalesce(F.col(uri_col).cast("string"), F.lit("")), r"[\r\n]+", " ") if uri_col else F.lit("")
    block = F.when(F.col("refers_to").isNotNull(), F.encode(F.lit(head), "UTF-8")).otherwise(
        F.concat(
            F.encode(F.lit(head), "UTF-8"),
            F.when(F.col("payload_bytes") > 0, F.array_join("chunks", "").cast("binary")).otherwise(F.encode(F.lit(""), "UTF-8")),
            F.encode(F.lit(f"0{CRLF}{CRLF}"), "UTF-8"),
        )
    )
    page = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = (
        held.withColumn("page", page)
        .withColumn("uri", uri)
        .withColumn("record", F.concat(F.lit("urn:page:"), "page", F.lit(":"), F.monotonically_increasing_id()))
        .withColumn("chunks", framed)
        .withColumn("block", block)
        .select("page", "uri", "record", "refers_to", "payload_bytes", "payload_digest", "block")
        .withColumn("total", F.octet_length("block"))
        .select("*", F.posexplode(cut("block", segment, "{p}")).alias("k", "part"))
    )
    first, many = F.col("k") == 0, F.col("total") > segment
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    nothing = F.lit("")
    last = F.col("total") <= (F.col("k") + 1) * segment
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(~first, "continuation").when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<"), "record", F.when(first, nothing).otherwise(F.concat(F.lit(":"), F.col("k") + 1)), F.lit(">"))),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Page-ID", F.col("page")),
        F.when(first, F.concat(line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")), line("WARC-Payload-Length", F.col("payload_bytes").cast("string")))).otherwise(nothing),
        F.when(first & F.col("refers_to").isNotNull(), line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))).otherwise(nothing),
        F.when(many, line("WARC-Segment-Number", (F.col("k") + 1).cast("string"))).otherwise(nothing),
        F.when(many & ~first, line("WARC-Segment-Origin-ID", F.concat(F.lit("<"), "record", F.lit(">")))).otherwise(nothing),
        F.when(many & ~first & last, line("WARC-Segment-Total-Length", F.col("total").cast("string"))).otherwise(nothing),
        line("Content-Type", F.when(first, "application/http; msgtype=response").otherwise("application/octet-stream")),
        line("Content-Length", F.octet_length("part").cast("string")),
        F.lit(CRLF),
    )
    return rows.select(F.concat(F.encode(header, "UTF-8"), F.col("part")).cast("string").alias("value"))


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", body_col: str = "html", uri_col: str | None = "url", segment: int = SEGMENT, chunk: int = CHUNK, records: int = RECORDS
) -> None:
    held = with_revisits(pages, id_col, body_col)
    value = record_text(held, id_col, uri_col, segment, chunk)
    value.write.option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", records).option("compression", "gzip").text(path)


def records_of(stream: io.BufferedIOBase) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Headers (lower-case names) and block of each record of a WARC stream, one at a time."""
    while line := stream.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record at {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.partition(b":")
            fields[name.lower()] = value.strip()
        block = stream.read(int(fields[b"content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record doesn't end where its length says")
        yield fields, block


def dechunked(block: bytes) -> bytes:
    """The payload of an HTTP message in chunked framing."""
    at = block.index(b"\r\n\r\n") + 4
    if b"transfer-encoding: chunked" not in block[:at].lower():
        return block[at:]
    out = []
    while True:
        stop = block.index(b"\r\n", at)
        size = int(block[at:stop].split(b";")[0], 16)
        at = stop + 2
        if not size:
            return b"".join(out)
        out.append(block[at : at + size])
        if block[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a transfer chunk doesn't end where its size says")
        at += size + 2


def checked(block: bytes, digest: str) -> int:
    """Length of the payload, whose digest must be as the record says."""
    payload = dechunked(block)
    if hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("payload and digest differ")
    return len(payload)


PARSED = "origin string, segment int, total long, page string, kind string, refers_to string, payload_bytes long, payload_digest string, block binary"


def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of whole files; a record in one segment is checked at once and sent without its block."""
    names = [c.split()[0] for c in PARSED.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for content in batch.column(0):
            rows, held = [], 0
            stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())))
            for f, block in records_of(stream):
                text = {k: v.decode() for k, v in f.items()}
                number = int(text.get(b"warc-segment-number", 0))
                digest = text.get(b"warc-payload-digest", "")[5:]
                length = int(text[b"warc-payload-length"]) if b"warc-payload-length" in text else None
                kind = text[b"warc-type"]
                if kind == "response" and not number and checked(block, digest) != length:
                    raise ValueError("payload and length differ")
                total = text.get(b"warc-segment-total-length")
                rows.append((
                    text.get(b"warc-segment-origin-id", text[b"warc-record-id"])[1:-1], number, total and int(total), text[b"warc-page-id"],
                    kind, text.get(b"warc-refers-to", "")[10:-1] or None, length, digest or None, block if number else None,
                ))
                held += len(block) if number else 0
                if len(rows) >= 4096 or held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def joined_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checks each reassembled record: segments 1..n, total length, payload digest and length."""
    for batch in batches:
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for parts, total, digest, length in zip(*(col[n].to_pylist() for n in ("parts", "total", "payload_digest", "payload_bytes"))):
            if not parts:
                continue
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                raise ValueError("a segment is missing or doubled")
            block = b"".join(p["block"] for p in parts)
            if len(block) != total or checked(block, digest) != length:
                raise ValueError("segments and total length differ")
        yield pa.RecordBatch.from_arrays([col[n] for n in ("page", "payload_bytes", "payload_digest", "kind", "refers_to")], names=["page", "payload_bytes", "payload_digest", "kind", "refers_to"])


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each archived record, reassembled and checked."""
    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = files.mapInArrow(parse, PARSED)
    part = F.when(F.col("segment") > 0, F.struct("segment", "block"))
    whole = parsed.groupBy("origin").agg(
        F.max("page").alias("page"), F.max("total").alias("total"), F.max(F.when(F.col("kind") != "continuation", F.col("kind"))).alias("kind"),
        F.max("refers_to").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"),
        F.array_sort(F.collect_list(part)).alias("parts"),
    )
    done = whole.mapInArrow(joined_segments, "page string, payload_bytes long, payload_digest string, kind string, refers_to string")
    return done.select(
        F.expr(f"cast(nullif(page, '') as {id_type})").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"),
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )


def archived(pages: DataFrame, id_col: str = "page_id", body_col: str = "html", uri_col: str | None = "url", segment: int = SEGMENT, chunk: int = CHUNK) -> DataFrame:
    """Writes ``pages`` as WARC files in the shared folder and returns what reading them back gives.

    A null body is an empty payload. A null id stays null. Of payloads from
    1000 bytes on, the largest id's record is the response; a row repeated with
    that id is a response too. An empty table gives no rows; other columns are
    not read.
    """
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    cols = [id_col, body_col] + [uri_col] * bool(uri_col)
    write_archives(pages.select(*cols), path, id_col, body_col, uri_col, segment, chunk)
    return read_archives(spark, path, pages.schema[id_col].dataType.simpleString()).withColumnRenamed("page_id", id_col)
