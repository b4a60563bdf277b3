import gzip

from pyspark.sql import functions as F

from pitchspark.llm import warc
from pitchspark.llm.common import shared_path, written
from pitchspark.llm.queries import op5_warc

RECORDS = "type string, record_id string, concurrent_to array<string>, refers_to string, uri string, digest string, fields map<string,string>, http string, payload binary"


def archive(spark, pages):
    path = shared_path(spark, "t-warc")
    warc.write_archive(pages, path)
    return path


def test_round_trip_of_odd_payloads(spark, tmp_path):
    body = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" + "é日\n" * 50
    rows = [(5, "http://a/", body), (3, "http://b/", body), (9, None, body), (1, "u", "x" * 99), (2, "u", "x" * 99), (4, "u\r\nX: y", None), (6, "u", ""),
            (7, "u", "y" * 300_000), (7, "u", "y" * 300_000), (None, "u", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit(1)).withColumn("digest", F.lit(2))
    records = written(warc.with_facts(warc.read_records(spark, archive(spark, pages))), "t-records")
    assert records.count() == 30 and warc.orphans(records).count() == 0
    got = warc.assemble(records).collect()
    page = lambda r: next((v for m in r.metadata for k, v in m.fields if k == "page_id"), None)
    by = {page(r): r for r in got}
    assert len(got) == 10 and [by[p].type for p in ("3", "5", "9", "1", "2")] == ["response", "revisit", "revisit", "response", "response"]
    assert bytes(by["3"].payload).decode() == body and by["5"].payload_bytes == len(body.encode()) and by["5"].payload_sha256 == by["3"].payload_sha256
    assert by["9"].uri is None and by["4"].payload_bytes == 0 and by["5"].refers_to == by["3"].record_id
    assert sum(r.payload_bytes == 300_000 and r.type == "response" for r in got) == 2 and all(r.request.http.startswith("GET ") for r in got)


def test_files_are_warc(spark):
    path = archive(spark, spark.createDataFrame([(1, "u", "hi")], "page_id long, url string, html string"))
    data = gzip.decompress(bytes(next(bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect() if len(r.content))))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: request\r\n") and data.endswith(b"\r\n\r\n") and b"WARC-Concurrent-To: <urn:uuid:" in data
    assert list(warc.parse(data)) == list(warc.parse(gzip.compress(data[:0]) + gzip.compress(data)))


def test_assembly_follows_links_in_any_direction(spark):
    r = lambda kind, i, to=(), **f: (kind, i, list(to), None, "u", None, f, None, bytearray(b""))
    rows = [r("response", "c1", ["q1"]), r("request", "q1"), r("metadata", "m1", ["q1"], a="1"), r("metadata", "m2", ["c1"], a="2"),
            r("response", "c2"), r("request", "q2", ["c2"]), r("request", "q3", ["c2"]), r("metadata", "lost", ["nowhere"]), r("warcinfo", "w"),
            r("resource", "c3")]
    records = warc.with_facts(spark.createDataFrame(rows, RECORDS))
    got = {x.record_id: x for x in warc.assemble(records).collect()}
    assert set(got) == {"c1", "c2", "c3"} and got["c1"].request.record_id == "q1" and [m.record_id for m in got["c1"].metadata] == ["m1", "m2"]
    assert got["c2"].request.record_id == "q2" and got["c3"].request is None and got["c3"].metadata == []
    assert [x.record_id for x in warc.orphans(records).collect()] == ["lost"]


def test_one_payload_on_many_pages_and_no_pages(spark, tmp_path):
    pages = spark.range(500).select((F.col("id") * 2 + 10).alias("page_id"), F.lit("u").alias("url"), F.repeat(F.lit("ab"), 60).alias("html"))
    pages.write.parquet(str(tmp_path / "many" / "pages.parquet"))
    rows = op5_warc(spark, str(tmp_path / "many")).collect()
    assert len(rows) == 500 and {(r.record_type, r.refers_to) for r in rows} == {("response", None), ("revisit", 10)}
    pages.limit(0).write.parquet(str(tmp_path / "none" / "pages.parquet"))
    assert op5_warc(spark, str(tmp_path / "none")).count() == 0


def test_repeated_rows_do_not_multiply_metadata(spark):
    pages = spark.range(400).select(F.lit(7).cast("long").alias("page_id"), F.lit("u").alias("url"), F.lit("<p>one page</p>").alias("html"))
    records = written(warc.with_facts(warc.read_records(spark, archive(spark, pages))), "t-repeated")
    got = warc.assemble(records).select("type", F.size("metadata").alias("n"), F.col("request.http").alias("http")).collect()
    assert len(got) == 400 and {(r.type, r.n) for r in got} == {("response", 1)} and all(r.http for r in got)
