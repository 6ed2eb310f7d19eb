"""Web archives: writing response and revisit records, cut into segments, and putting them together again.

A payload is the html in UTF-8 (null: empty), sent as an HTTP response in chunks. Of the records with equal payloads the
one with the largest page_id is the response, the others revisit it. Blocks over ``segment_bytes`` are cut into
a first segment and continuation records, each a record of its own with the identifier of its origin; the last one
states the total length. Archives are written by Spark's text writer, one record a line with two line ends as the
separator, which is the form of the format, and compressed; so writing is committed like any other table.

Reading takes each archive apart by content lengths, groups segments by origin identifier, orders them by number, checks
numbers and total length, undoes the chunks and checks the digest. A record that fails a check stays, with
``complete`` false and no payload figures.

Rows without page_id are records without one; they revisit a record of equal payload that has one, or else are
responses. Repeated rows of one page_id are records of equal kind each.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.tables import in_tasks, written
from gridmart.session import new_scratch

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARTS = "page_id long, url string, record_type string, origin string, number long, total long, refers_to long, digest string, block binary"
READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, complete boolean"


def base32_of_hex(digest: Column) -> Column:
    """Bare base32 of a SHA-1 in hexadecimal: every five digits are four letters."""
    letters = []
    for i in range(0, 40, 5):
        number = F.conv(F.substring(digest, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substr(F.lit(BASE32), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def _header(*fields: tuple[str, Column | str]) -> Column:
    """Fields whose value is null are left out."""
    lines = [F.concat(F.lit(f"{k}: "), F.lit(v) if isinstance(v, str) else v, F.lit("\r\n")) for k, v in fields]
    return F.concat(F.lit("WARC/1.1\r\n"), *(F.coalesce(x, F.lit("")) for x in lines), F.lit("\r\n"))


def write_archives(
    pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", segment_bytes: int = 16_384, chunk_bytes: int = 8_192,
    records_per_file: int = 4_000,
) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) to archives in the folder ``path``."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    # Written first, so that the join has a plain exchange on either side and a large digest can be split.
    kept = written(rows.groupBy("sha1").agg(F.max("page_id").alias("kept")), "warc-kept")
    joined = rows.join(kept, "sha1")
    again = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))

    size = F.octet_length("payload")

    def chunk(i: Column) -> Column:
        data = F.substr(F.col("payload"), i * chunk_bytes + 1, F.lit(chunk_bytes))
        framed = F.concat(F.lower(F.hex(F.octet_length(data).cast("long"))), F.lit("\r\n"), data.cast("string"), F.lit("\r\n"))
        return F.when(size == 0, F.lit("")).otherwise(framed)

    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(size / chunk_bytes).cast("int"), F.lit(1)) - 1)
    chunked = F.concat(F.array_join(F.transform(numbers, chunk), ""), F.lit("0\r\n\r\n"))
    full = F.concat(F.lit(HTTP + "Transfer-Encoding: chunked\r\n\r\n"), chunked)
    records = joined.select(
        "page_id",
        F.regexp_replace("url", r"[\r\n]+", "%0D%0A").alias("url"),
        F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1"))).alias("digest"),
        again.alias("again"),
        F.when(again, F.col("kept")).alias("refers_to"),
        F.concat(F.lit("urn:x-page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("/"), F.expr("uuid()")).alias("id"),
        F.when(again, F.lit(HTTP + "\r\n")).otherwise(full).cast("binary").alias("block"),
    )
    records = records.withColumn("pieces", F.ceil(F.octet_length("block") / segment_bytes).cast("int"))
    urn = lambda x: F.concat(F.lit("<"), x, F.lit(">"))

    def record(i: Column) -> Column:
        block = F.substr(F.col("block"), i * segment_bytes + 1, F.lit(segment_bytes))
        several, first = F.col("pieces") > 1, i == 0
        header = _header(
            ("WARC-Type", F.when(~first, F.lit("continuation")).when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", F.when(first, urn(F.col("id"))).otherwise(urn(F.concat("id", F.lit("/"), i.cast("string"))))),
            ("WARC-Date", date),
            ("WARC-Target-URI", F.col("url")),
            ("WARC-Payload-Digest", F.when(first, F.col("digest"))),
            ("WARC-Profile", F.when(first & F.col("again"), F.lit(REVISIT))),
            ("WARC-Refers-To", F.when(first & F.col("again"), urn(F.concat(F.lit("urn:x-page:"), F.col("refers_to").cast("string"))))),
            ("WARC-Segment-Number", F.when(several, (i + 1).cast("string"))),
            ("WARC-Segment-Origin-ID", F.when(~first, urn(F.col("id")))),
            ("WARC-Segment-Total-Length", F.when(several & (i == F.col("pieces") - 1), F.octet_length("block").cast("string"))),
            ("Content-Type", F.when(first, F.lit("application/http;msgtype=response"))),
            ("Content-Length", F.octet_length(block).cast("string")),
        )
        return F.concat(header, block.cast("string"))

    lines = records.select(F.explode(F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), record)).alias("value"))
    lines.write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)


_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of the records of an archive, in order."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or head < 0:
            raise ValueError(f"no record at byte {at}")
        fields = {k.decode().lower(): v.decode() for k, v in _FIELD.findall(data, data.find(b"\r\n", at) + 2, head + 2)}
        begin, length = head + 4, int(fields["content-length"])
        if data[begin + length : begin + length + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is not {length} bytes long")
        yield fields, data[begin : begin + length]
        at = begin + length + 4


def payload_of(block: bytes) -> bytes | None:
    """The body of an HTTP response, chunks undone; None if the framing is broken."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            return None
        if size < 0 or body[end + 2 + size : end + 4 + size] != b"\r\n":
            return None
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def _page(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:x-page:(-?\d+)(?:/.*)?>", urn or "")
    return int(m[1]) if m else None


def _figures(kind: str, digest: str | None, block: bytes) -> tuple[int | None, str | None, bool]:
    if kind == "revisit":
        return None, digest, True
    payload = payload_of(block)
    if payload is None:
        return None, None, False
    own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return (len(payload), own, True) if own == digest else (None, None, False)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, str], bytes]]:
    for batch in batches:
        for content in batch.column(0):
            data = content.as_buffer().to_pybytes()
            yield from parse_archive(gzip.decompress(data) if data.startswith(b"\x1f\x8b") else data)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures of the records that are not cut into segments."""
    rows = []
    for fields, block in _records(batches):
        if "warc-segment-number" in fields:
            continue
        digest = (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None
        kind = fields["warc-type"]
        rows.append((_page(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, _page(fields.get("warc-refers-to")), *_figures(kind, digest, block)))
        if len(rows) >= 5000:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "complete"]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in PARTS.split(", ")]
    rows, held = [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for fields, block in _records(batches):
        if "warc-segment-number" not in fields:
            continue
        total = fields.get("warc-segment-total-length")
        rows.append(
            (_page(fields["warc-record-id"]), fields.get("warc-target-uri"), fields["warc-type"],
             fields.get("warc-segment-origin-id") or fields["warc-record-id"], int(fields["warc-segment-number"]),
             None if total is None else int(total), _page(fields.get("warc-refers-to")),
             (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None, block)
        )
        held += len(block)
        if held >= 8_000_000:
            yield made()
            rows, held = [], 0
    if rows:
        yield made()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures of records whose segments came together; the segments lie in order."""
    for batch in batches:
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            block = b"".join(x["block"] for x in row["segments"])
            numbers = [x["number"] for x in row["segments"]]
            if numbers == list(range(1, len(numbers) + 1)) and row["total"] == len(block):
                figures = _figures(row["record_type"], row["digest"], block)
            else:
                figures = (None, None, False)
            yield _batch([(row["page_id"], row["url"], row["record_type"] or "continuation", row["refers_to"], *figures)])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in ``path``, segments put together: ``READ``.

    A revisit has the payload figures of the response it refers to, if their digests agree.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    whole = in_tasks(files, _whole, READ)
    first = F.col("number") == 1
    parts = in_tasks(files, _segments, PARTS)
    # A group is one record.
    together = parts.groupBy("origin").agg(
        F.max(F.when(first, F.col("page_id"))).alias("page_id"),
        F.max("url").alias("url"),
        F.max(F.when(first, F.col("record_type"))).alias("record_type"),
        F.max("refers_to").alias("refers_to"),
        F.max("digest").alias("digest"),
        F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("segments"),
    )
    found = written(whole.unionByName(in_tasks(together, _joined, READ)), "warc-read")
    responses = found.where("record_type = 'response' and complete").groupBy("page_id")
    responses = written(responses.agg(F.max("payload_bytes").alias("size"), F.max("payload_digest").alias("own")), "warc-responses")
    revisits = found.where("record_type = 'revisit'").join(responses.withColumnRenamed("page_id", "refers_to"), "refers_to", "left")
    same = F.col("own").eqNullSafe(F.col("payload_digest"))
    revisits = revisits.select(
        "page_id", "url", "record_type", "refers_to", F.when(same, F.col("size")).alias("payload_bytes"),
        F.when(same, F.col("payload_digest")).alias("payload_digest"), same.alias("complete"),
    )
    return found.where("record_type <> 'revisit'").unionByName(revisits)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    path = new_scratch(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
