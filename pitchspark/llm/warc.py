"""WARC archives: written as transactions, read back and assembled into one nested row per capture.

Writing: each row becomes a request, a response (or revisit) and a metadata
record; request and metadata name the response in ``WARC-Concurrent-To``. Of
rows with equal payloads of at least ``MIN_REVISIT`` bytes, that with the
smallest id is the response and the others are revisits of it
(``WARC-Refers-To``, identical-payload-digest), written without the payload;
smaller payloads are all responses. The duplicates are found by digest: sums
before the shuffle give each digest's smallest id and count, and only digests
found more than once are looked up.

Files: WARC/1.1, gzip, through Spark's text sink (a record, then CR LF CR LF).

Reading: each file is parsed by ``Content-Length``, so payloads may hold
anything. Assembly: a record belongs to the capture it is concurrent to,
directly, by being named by the capture, or through its request; requests and
metadata are gathered per capture and joined to it, revisits get the payload
facts from the response they refer to. Records that name no capture of the
archive are not part of any row; ``orphans`` returns them.

Null payloads are empty, null addresses leave out ``WARC-Target-URI``; a
repeated id is one capture per row (equal rows with the smallest id are all
responses), and equal records of one id are one entry in each of its captures'
metadata, so repeated rows never multiply; empty tables give empty archives and results.
"""

from __future__ import annotations

import gzip
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small, written
from .rawfiles import read_files, write_records

MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"
FILE_RECORDS = 3_000
_END = "\r\n\r\n"
RECORD = "type string, record_id string, concurrent_to array<string>, refers_to string, uri string, digest string, fields map<string,string>, http string, payload binary"


def _uuid(kind: str, page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(page_id.cast("string"), F.lit("")), digest).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), *(F.concat(F.lit("-"), F.substring(h, a, n)) for a, n in ((9, 4), (13, 4), (17, 4), (21, 12))), F.lit(">"))


def _record(kind: str, head: list[Column], block: Column) -> Column:
    """A record without its final CR LF CR LF, as binary. ``head``: null lines are left out."""
    top = F.concat_ws("\r\n", F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.lit(f"WARC-Date: {DATE}"), *head,
                      F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat(top, F.lit(_END)).cast("binary"), block)


def transactions(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """record: three WARC records per row, as binary."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).cast("string").alias("uri"), body.alias("body")) \
        .withColumn("digest", F.sha2("body", 256)).withColumn("size", F.octet_length("body").cast("long"))
    twins = (rows.where(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("digest").alias("twin"), "first"))
    # Counted first: broadcast while small, so payloads stay where they are; else a join whose hot digests are split.
    rows = rows.join(small(written(twins, "warc-twins")), F.col("digest") == F.col("twin"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    main, of = _uuid("capture", F.col("id"), F.col("digest")), _uuid("capture", F.col("first"), F.col("digest"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    safe = F.regexp_replace("uri", r"[\r\n]", "%0A")
    target = line("WARC-Target-URI", safe)
    digest = line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    http = F.concat_ws("\r\n", F.lit("HTTP/1.1 200 OK"), F.lit("Content-Type: text/html; charset=utf-8"),
                       F.concat(F.lit("Content-Length: "), F.col("size").cast("string")), F.lit("\r\n")).cast("binary")
    http_type = F.lit("Content-Type: application/http;msgtype=response")
    request = _record("request", [line("WARC-Record-ID", _uuid("request", F.col("id"), F.col("digest"))), line("WARC-Concurrent-To", main), target,
                                  F.lit("Content-Type: application/http;msgtype=request")],
                      F.concat(F.lit("GET "), F.coalesce(safe, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")).cast("binary"))
    response = _record("response", [line("WARC-Record-ID", main), target, digest, http_type], F.concat(http, F.col("body")))
    again = _record("revisit", [line("WARC-Record-ID", main), target, digest, line("WARC-Refers-To", of),
                                F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), http_type], http)
    facts = F.concat_ws("\r\n", line("page_id", F.col("id").cast("string")), F.lit("")).cast("binary")
    metadata = _record("metadata", [line("WARC-Record-ID", _uuid("metadata", F.col("id"), F.col("digest"))), line("WARC-Concurrent-To", main), target,
                                    F.lit("Content-Type: application/warc-fields")], facts)
    return rows.select(F.explode(F.array(request, F.when(revisit, again).otherwise(response), metadata)).alias("record"))


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html") -> None:
    write_records(transactions(pages, page_id, url, payload), "record", path, _END, FILE_RECORDS, "gzip")


def _head(block: bytes) -> list[tuple[str, str]]:
    pairs = (x.partition(b":") for x in block.split(b"\r\n") if b":" in x)
    return [(a.strip().decode("utf-8", "replace").lower(), b.strip().decode("utf-8", "replace")) for a, _, b in pairs]


def parse(content: bytes):
    """The records of one file (plain, or gzip of one or many members) as tuples of ``RECORD``, inflated as they are read."""
    raw = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        lines = []
        while (x := stream.readline()) not in (b"\r\n", b""):
            lines.append(x.rstrip(b"\r\n"))
        head = _head(b"\r\n".join(lines))
        fields = dict(head)
        block = stream.read(int(fields["content-length"]))
        stream.read(4)
        http = payload = None
        if fields.get("content-type", "").startswith("application/http"):
            http, _, payload = block.partition(b"\r\n\r\n")
            http = http.decode("utf-8", "replace")
        else:
            payload = block
        extra = dict(_head(payload)) if fields.get("content-type") == "application/warc-fields" else {}
        yield (fields.get("warc-type"), fields.get("warc-record-id"), [v for k, v in head if k == "warc-concurrent-to"], fields.get("warc-refers-to"),
               fields.get("warc-target-uri"), fields.get("warc-payload-digest"), extra, http, payload)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, see ``RECORD``."""

    def run(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.binary()]
        names = ["type", "record_id", "concurrent_to", "refers_to", "uri", "digest", "fields", "http", "payload"]
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows, size = [], 0
                for r in parse(content):
                    rows.append((*r[:6], list(r[6].items()), *r[7:]))
                    size += len(r[8] or b"")
                    if len(rows) >= 1000 or size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return read_files(spark, path).select("content").mapInArrow(run, RECORD)


_CAPTURES = ("response", "revisit", "resource")


def capture_of(records: DataFrame) -> DataFrame:
    """record_id, capture: the capture that each request, metadata or other record belongs to.

    ``records`` needs type, record_id and concurrent_to. A direct link to or
    from a capture wins over one through a request; of several captures the
    smallest record id.
    """
    links = records.select("record_id", F.explode("concurrent_to").alias("other"))
    both = links.union(links.select("other", "record_id"))
    captures = records.where(F.col("type").isin(*_CAPTURES)).select(F.col("record_id").alias("capture")).distinct()
    direct = both.join(captures, both["other"] == captures["capture"]).groupBy("record_id").agg(F.min("capture").alias("capture"))
    direct = direct.join(captures.select(F.col("capture").alias("record_id")), "record_id", "left_anti")
    through = (links.join(direct.withColumnRenamed("record_id", "other"), "other").groupBy("record_id").agg(F.min("capture").alias("far")))
    return direct.join(through, "record_id", "full").select("record_id", F.coalesce("capture", "far").alias("capture"))


def with_facts(records: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Add payload_bytes and payload_sha256; without the payload itself the rows are narrow."""
    out = records.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_sha256", F.sha2("payload", 256))
    return out if keep_payload else out.drop("payload")


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per response, revisit or resource record of ``records`` (with facts; read several times).

    record_id, type, uri, refers_to, payload_bytes, payload_sha256 (of a revisit:
    those of the response it refers to), http, payload (if ``records`` has it),
    request (record_id, http; the smallest id's) and metadata (array of
    record_id and fields).
    """
    of = capture_of(records.select("type", "record_id", "concurrent_to"))
    joined = records.where(F.col("type").isin("request", "metadata")).select("type", "record_id", "http", "fields").join(of, "record_id")
    is_request, is_metadata = F.col("type") == "request", F.col("type") == "metadata"
    parts = joined.groupBy("capture").agg(
        F.min(F.when(is_request, F.struct("record_id", "http"))).alias("request"),
        F.sort_array(F.collect_set(F.when(is_metadata, F.struct("record_id", F.map_entries("fields").alias("fields"))))).alias("metadata"))
    captures = records.where(F.col("type").isin(*_CAPTURES))
    # The facts of responses that revisits refer to; only ids and numbers travel.
    wanted = captures.where(F.col("refers_to").isNotNull()).select(F.col("refers_to").alias("to_id")).distinct()
    facts = (captures.where("type <> 'revisit'").select(F.col("record_id").alias("to_id"), F.struct("payload_bytes", "payload_sha256").alias("referred"))
             .join(wanted, "to_id").groupBy("to_id").agg(F.min("referred").alias("referred")))
    own = [F.when(F.col("type") == "revisit", F.col(f"referred.{c}")).otherwise(F.col(c)).alias(c) for c in ("payload_bytes", "payload_sha256")]
    return (captures.join(parts, captures["record_id"] == parts["capture"], "left").join(facts, captures["refers_to"] == facts["to_id"], "left")
            .select("record_id", "type", "uri", "refers_to", *own, "http", *(["payload"] if "payload" in records.columns else []), "request",
                    F.coalesce("metadata", F.array().cast(parts.schema["metadata"].dataType)).alias("metadata")))


def orphans(records: DataFrame) -> DataFrame:
    """Requests and metadata that belong to no capture of the archive."""
    of = capture_of(records.select("type", "record_id", "concurrent_to"))
    return records.where(F.col("type").isin("request", "metadata")).join(of, "record_id", "left_anti")
