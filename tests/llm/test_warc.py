from __future__ import annotations

import hashlib
import uuid
import zlib

from pyspark.sql import functions as F

from raceline.llm import warc

PAGES = "page_id long, url string, html string"
LARGE, OTHER = "<p>é</p>" * 200, "<b>other</b>" * 100
ROWS = [
    (1, "http://a/1", LARGE),
    (2, "http://a/2", LARGE),
    (5, "http://a/5", LARGE),
    (None, "http://a/none", LARGE),
    (3, "http://b/ x\r\ny", "small"),
    (4, None, "small"),
    (6, "http://c/é", None),
    (7, "http://c/7", ""),
    (8, "http://c/8", "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "x" * 300_000),
    (9, "http://d/9", OTHER),
    (9, "http://d/9", OTHER),
    (None, "http://e", "<i>alone</i>" * 100),
]


def expected(rows, least=1000):
    data = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for page, payload in data:
        ids = [p for p, x in data if x == payload and p is not None]
        holder = max(ids) if ids and len(payload) >= least else None
        again = holder is not None and holder != page
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", holder if again else None))
    return sorted(out, key=str)


def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def read_back(index, where):
    rows = warc.read_records(index, where).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted(map(tuple, rows), key=str)


def test_round_trip_of_odd_rows(spark, tmp_path):
    where = folder(tmp_path)
    pages = spark.createDataFrame(ROWS, PAGES).withColumns({"size": F.lit(1), "sha1": F.lit("x"), "salt": F.lit(2), "payload": F.lit("y"), "file": F.lit("z")})
    index = warc.write_archives(pages.repartition(3), where, file_bytes=2_000)
    assert read_back(index, where) == expected(ROWS)
    assert index.select("file").distinct().count() > 3  # files are closed at their size
    stored = {r.page_id: r for r in warc.read_records(index.where("page_id in (3, 4, 5, 8)"), where).collect()}
    assert {k: bytes(r.payload).decode() for k, r in stored.items()} == {3: "small", 4: "small", 5: LARGE, 8: ROWS[8][2]}
    assert stored[3].url == "http://b/%20x%0D%0Ay" and stored[4].url is None
    told = {r.page_id: r.url for r in index.where("page_id in (3, 6)").collect()}
    assert told == {3: "http://b/ x\r\ny", 6: "http://c/é"}


def test_offsets_point_at_gzip_members(spark, tmp_path):
    where = folder(tmp_path)
    for r in warc.write_archives(spark.createDataFrame(ROWS, PAGES), where).collect():
        with open(f"{where}/{r.file}", "rb") as f:
            f.seek(r.offset)
            member = zlib.decompressobj(31)
            text = member.decompress(f.read(r.length))
        assert member.eof and not member.unused_data and text.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())


def test_selection_and_empty_table(spark, tmp_path):
    where = folder(tmp_path)
    index = warc.write_archives(spark.createDataFrame(ROWS, PAGES), where)
    assert warc.read_records(index.where("false"), where).count() == 0
    assert [r.page_id for r in warc.read_records(index.where("url = 'http://a/2'"), where).collect()] == [2]
    nothing = folder(tmp_path)
    assert warc.write_archives(spark.createDataFrame([], PAGES), nothing).count() == 0


def test_unlisted_files_are_not_read(spark, tmp_path):
    where = folder(tmp_path)
    index = warc.write_archives(spark.createDataFrame(ROWS, PAGES), where)
    with open(f"{where}/data/lost.warc.gz", "wb") as f:  # left behind by a lost task
        f.write(warc.page_record(99, "http://lost", b"lost", hashlib.sha1(b"lost").hexdigest(), None, "1970-01-01T00:00:00Z"))
    assert read_back(index, where) == expected(ROWS)
