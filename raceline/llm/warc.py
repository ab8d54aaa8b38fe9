"""WARC archives with an index that comes first.

``write_archives`` stores every page as a WARC record, gzipped on its own, and
writes an index row per record: file, offset, length, URL and payload digest.
Records are then read through the index alone: ``read_records`` takes any
selection of index rows, sorts it by file and offset, coalesces ranges that
lie close together into one read each, and parses the records out of what was
read. What is not selected is not read.

Payloads that several pages share are stored once. The page with the largest
id keeps the response; the others are revisit records that name it and carry
size and digest of the payload.

Files are written by the tasks themselves, through the file system that the
folder's URI names. A file gets a name of its own in every attempt, and its
index rows appear only with the committed index table: what a lost task left
behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raceline.llm.common import Scratch, shuffle_partitions

#: Payloads below this many bytes are always stored in full (fixed value of the contract).
MIN_SHARED_BYTES = 1000
#: A file is closed when it has reached this size.
FILE_BYTES = 256 << 20
#: Records whose ranges are at most GAP_BYTES apart are read at once, up to READ_BYTES.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: Bytes of a file whose records one reading task takes together.
SPAN_BYTES = 64 << 20
#: Copies of one payload are spread over so many join keys.
SALTS = 16

_UNSAFE = re.compile(rb"[\x00-\x20\x7F]")
_INDEX = "file string, offset bigint, length bigint, url string, payload_digest string, payload_bytes bigint, record_type string, page_id {0}, refers_to {0}"


def open_fs(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder (URI or absolute path) and the path in it."""
    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return (fs.LocalFileSystem(), folder) if folder.startswith("/") else fs.FileSystem.from_uri(folder)


def _record(headers: list[tuple[str, bytes]], block: bytes, level: int) -> bytes:
    head = b"".join(name.encode() + b": " + value + b"\r\n" for name, value in [*headers, ("Content-Length", b"%d" % len(block))])
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _digest(sha1: str) -> bytes:
    return b"sha1:" + base64.b32encode(bytes.fromhex(sha1))


def _name(page: object, sha1: str) -> bytes:
    return f"<urn:page:{page}:{sha1}>".encode()


def page_record(page: object, url: str | None, payload: bytes, sha1: str, refers_to: object, date: str, level: int = 6) -> bytes:
    """A page as one gzip member: a response, or a revisit of ``refers_to``."""
    revisit = refers_to is not None
    headers = [("WARC-Type", b"revisit" if revisit else b"response"), ("WARC-Record-ID", _name(page, sha1)), ("WARC-Date", date.encode())]
    if url is not None:
        headers.append(("WARC-Target-URI", _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url.encode())))
    headers += [("Content-Type", b"application/http;msgtype=response"), ("WARC-Payload-Digest", _digest(sha1))]
    if page is not None:
        headers.append(("X-Page-ID", str(page).encode()))
    if revisit:
        headers += [
            ("WARC-Profile", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _name(refers_to, sha1)),
        ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    return _record(headers, http if revisit else http + payload, level)


def parse_record(member: bytes) -> dict:
    """A record's type, page, URL, refers_to, payload (None in a revisit),
    payload size and digest. A response's are those of the payload itself."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
    block = rest[: int(headers[b"Content-Length"])]
    out = {
        "record_type": headers[b"WARC-Type"].decode(),
        "url": headers[b"WARC-Target-URI"].decode() if b"WARC-Target-URI" in headers else None,
        "page_id": headers[b"X-Page-ID"].decode() if b"X-Page-ID" in headers else None,
        "refers_to": None,
        "payload": None,
    }
    http, _, payload = block.partition(b"\r\n\r\n")
    sha1 = base64.b32decode(headers[b"WARC-Payload-Digest"][5:]).hex()
    if out["record_type"] == "revisit":
        out["refers_to"] = headers[b"WARC-Refers-To"].decode()[len("<urn:page:") :].rpartition(":")[0]
        size = int(re.search(rb"\r\nContent-Length: ([0-9]+)", http)[1])
    else:
        out["payload"], size = payload, len(payload)
        if hashlib.sha1(payload).hexdigest() != sha1:
            raise ValueError(f"payload of {out['page_id']} does not have its digest")
    return out | {"payload_bytes": size, "payload_digest": sha1}


def with_holder(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of (page, url, payload) with ``sha1``, ``size`` and ``refers_to``:
    the page that holds the payload in full, null where this one does.

    Holders come from ids and digests alone. Only payloads that occur twice
    have a row on the other side of the join, once per salt, so that the
    copies of one payload spread over several tasks."""
    hashed = pages.withColumns({"size": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload")})
    large = hashed.where(F.col("size") >= MIN_SHARED_BYTES)
    groups = large.groupBy("sha1", "size").agg(F.max("page").alias("holder"), F.count(F.lit(1)).alias("n"))
    shared = scratch.write(groups.where("n > 1 AND holder IS NOT NULL").select("sha1", "size", "holder"), "holders")
    salted = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = large.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    found = spread.join(salted, ["sha1", "size", "salt"], "left").withColumn("refers_to", F.when(~F.col("page").eqNullSafe(F.col("holder")), F.col("holder")))
    columns = ["page", "url", "payload", "sha1", "size", "refers_to"]
    small = hashed.where(F.col("size") < MIN_SHARED_BYTES).withColumn("refers_to", F.lit(None).cast(pages.schema["page"].dataType))
    return found.select(*columns).unionByName(small.select(*columns))


def write_archives(
    pages: DataFrame,
    folder: str,
    text: str = "html",
    key: str = "page_id",
    url: str = "url",
    date: str = "1970-01-01T00:00:00Z",
    file_bytes: int = FILE_BYTES,
    level: int = 6,
) -> DataFrame:
    """Write a record per row to WARC files below ``folder`` and return the
    index (also stored there): ``file``, ``offset``, ``length``, ``url``,
    ``payload_digest`` (SHA-1), ``payload_bytes``, ``record_type``,
    ``page_id`` and ``refers_to``.

    A null payload is empty. Of equal payloads of MIN_SHARED_BYTES or more the
    row with the largest key is the response and the others revisit it; rows
    that repeat the largest key are responses alike. A row without a key
    revisits the holder, and is a response where no row of its payload has a
    key. A null URL leaves the header out; blanks and control characters of
    a URL are percent-encoded in the record (the index has it as it was). An
    empty table gives an empty index and no file. The pages carry no time of
    capture: ``date`` stands in every record. Other columns are not read."""
    spark = pages.sparkSession
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("page"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = open_fs(folder)
        out, name, at, index = None, "", 0, []

        def finished() -> pa.RecordBatch:
            out.close()
            columns = list(zip(*index))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), page_kind, page_kind]
            names = ["file", "offset", "length", "url", "payload_digest", "payload_bytes", "record_type", "page_id", "refers_to"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for b in batches:
            page_kind = b.column(0).type
            for page, link, payload, sha1, size, refers_to in zip(*(b.column(i) for i in range(6))):
                if out is None:
                    where.create_dir(f"{path}/data", recursive=True)
                    name, index = f"data/{uuid.uuid4().hex}.warc.gz", []
                    out = where.open_output_stream(f"{path}/{name}", compression=None)
                    info = _record([("WARC-Type", b"warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>".encode()), ("WARC-Date", date.encode()),
                                    ("Content-Type", b"application/warc-fields")], b"format: WARC File Format 1.1\r\n", level)
                    at = out.write(info)
                page, link, sha1, refers_to = page.as_py(), link.as_py(), sha1.as_py(), refers_to.as_py()
                member = page_record(page, link, payload.as_py(), sha1, refers_to, date, level)
                out.write(member)
                index.append((name, at, len(member), link, sha1, size.as_py(), "response" if refers_to is None else "revisit", page, refers_to))
                at += len(member)
                if at >= file_bytes:
                    yield finished()
                    out = None
        if out is not None:
            yield finished()

    index = with_holder(rows, Scratch(spark, "warc")).mapInArrow(run, _INDEX.format(kind))
    index.write.parquet(f"{folder}/index")
    return read_index(spark, folder, kind)


def read_index(spark: SparkSession, folder: str, kind: str = "bigint") -> DataFrame:
    return spark.read.schema(_INDEX.format(kind)).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that rows of the index name: ``page_id``, ``url``,
    ``record_type``, ``refers_to``, ``payload_bytes``, ``payload_digest`` and
    ``payload`` (null in revisits, and everywhere without ``payloads``), all
    parsed out of the archives. Repeated index rows give repeated records; an
    empty selection reads nothing."""
    kind = index.schema["page_id"].dataType.simpleString()
    size = shuffle_partitions(index.sparkSession)
    span = F.floor(F.col("offset") / F.lit(SPAN_BYTES)).alias("span")
    ranges = index.select("file", "offset", "length", span).repartition(size, "file", "span").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = open_fs(folder)
        opened, source = None, None
        for b in batches:
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()))
            at = 0
            while at < len(rows):
                name, start, length = rows[at]
                end, last = start + length, at + 1
                while last < len(rows) and rows[last][0] == name and rows[last][1] <= end + GAP_BYTES and rows[last][1] + rows[last][2] - start <= READ_BYTES:
                    end, last = max(end, rows[last][1] + rows[last][2]), last + 1
                if opened != name:
                    if source is not None:
                        source.close()
                    opened, source = name, where.open_input_file(f"{path}/{name}")
                data = source.read_at(end - start, start)
                parsed = [parse_record(data[o - start : o - start + n]) for _, o, n in rows[at:last]]
                if not payloads:
                    parsed = [p | {"payload": None} for p in parsed]
                yield pa.RecordBatch.from_pylist(parsed, schema=schema)
                at = last

    texts = ["page_id", "url", "record_type", "refers_to", "payload_digest"]
    schema = pa.schema([*((c, pa.string()) for c in texts), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
    found = ranges.mapInArrow(run, ", ".join(f"{c} string" for c in texts) + ", payload_bytes bigint, payload binary")
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


ORACLE_SQL = f"""
WITH hashed AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
held AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS holder FROM hashed),
told AS (SELECT *, payload_bytes >= {MIN_SHARED_BYTES} AND holder IS NOT NULL AND page_id IS DISTINCT FROM holder AS again FROM held)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN again THEN holder END AS refers_to
FROM told
"""
