"""WARC archives: writing captures with revisits, reading archives back, assembling transactions.

A capture is three records: request, response (or revisit) and metadata.  Request and metadata name the response in
WARC-Concurrent-To; a revisit names the response with the same payload in WARC-Refers-To.  Archives are written
by Spark's text sink (committed by task, so a lost executor leaves no half file) and may lie in any store that
Spark reaches.  The reader takes an archive a task, walks it by Content-Length and never looks for separators, so a payload may hold
anything, records included.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidbox.llm.common import arrow_map, materialize

#: Payloads from so many bytes on are stored once.
LEAST_REVISIT = 1000
#: About so many payload bytes an archive.
FILE_BYTES = 32 << 20
#: A payload with a larger share of the rows than one in so many has its flag broadcast: there are at most so many.
HOT = 1000
DATE = "2024-01-01T00:00:00Z"
_EOL = "\r\n"


def _record_id(kind: str, *parts: Column) -> Column:
    """A UUID from a hash of the capture, so reruns and retries give the same identifier."""
    h = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(fields: list[tuple[str, Column]], body: Column) -> Column:
    """One record as text; a header whose value is null is left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(_EOL)) for name, value in fields]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit(_EOL))
    return F.concat(F.lit("WARC/1.1" + _EOL), F.concat_ws("", *lines), size, F.lit(_EOL), body)


def captures(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """Each page with its payload's size and SHA-1, its record type and, for a revisit, the page it refers to.

    Of equal payloads (size and SHA-1) of at least ``least`` bytes the row with the largest id is the response; of rows that
    repeat this id one is.  Null html is an empty payload.  The rows are numbered in a written table, so a retry cannot number them anew.
    The flag of a payload that holds more than 1/1000 of the rows (1,000 such at most) is broadcast; those rows, and those without
    a copy to look for, meet nothing in the join by payload and are spread evenly.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"))
    rows = materialize(rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
                       .withColumn("nr", F.monotonically_increasing_id()), "captures")
    long = rows.where(F.col("bytes") >= least).groupBy("digest", "bytes").agg(F.max(F.struct("page_id", "nr")).alias("whole"), F.count("*").alias("n")).where("n > 1")
    long = materialize(long, "payloads")
    hot = F.col("n") * HOT > F.lit(rows.count())
    few = F.broadcast(long.where(hot).select("digest", "bytes", F.col("whole").alias("hot_whole")))
    met = rows.join(few, ["digest", "bytes"], "left")
    asks = F.col("hot_whole").isNull() & (F.col("bytes") >= least)
    met = met.withColumn("key", F.when(asks, F.col("digest")).otherwise(F.concat(F.lit("row "), F.col("nr").cast("string"))))
    rest = long.where(~hot).select(F.col("digest").alias("key"), "bytes", F.col("whole").alias("rest_whole"))
    rows = met.join(rest, ["key", "bytes"], "left").withColumn("whole", F.coalesce("hot_whole", "rest_whole"))
    first = F.col("whole").isNull() | (F.col("whole") == F.struct("page_id", "nr"))
    return rows.select("page_id", "url", "payload", "bytes", "digest", "nr", F.when(first, "response").otherwise("revisit").alias("type"), F.when(~first, F.col("whole.page_id")).alias("refers_to"), "whole")


def write(pages: DataFrame, path: str, *, file_bytes: int = FILE_BYTES, compression: str = "gzip", **options) -> None:
    """Write the captures of ``pages`` as archives below ``path`` (see :func:`captures` for the options).

    The codec compresses a whole archive as one gzip member; ``compression="none"`` writes plain .warc text.
    """
    c = captures(pages, **options)
    own = _record_id("response", F.col("page_id"), F.col("nr"))
    whole = _record_id("response", F.col("whole.page_id"), F.col("whole.nr"))
    revisit = F.col("type") == "revisit"
    target, date, host = F.col("url"), F.lit(DATE), F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(_EOL + _EOL))
    request = F.concat(F.lit("GET "), F.coalesce(F.nullif(F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^#\s]*)", 1), F.lit("")), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit(_EOL + _EOL))
    about = F.concat_ws("", F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(_EOL)), F.concat(F.lit("payload-bytes: "), F.col("bytes").cast("string"), F.lit(_EOL)),
                        F.concat(F.lit("refers-to-page-id: "), F.col("refers_to").cast("string"), F.lit(_EOL)))
    http_kind = lambda k: F.lit(f"application/http;msgtype={k}")
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    common = lambda kind, record_id: [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Target-URI", F.regexp_replace(target, r"[\r\n]+", " ")), ("WARC-Date", date)]
    records = F.array(
        _record([*common(F.lit("request"), _record_id("request", F.col("page_id"), F.col("nr"))), ("WARC-Concurrent-To", own), ("Content-Type", http_kind("request"))], request),
        _record([*common(F.col("type"), own), ("WARC-Payload-Digest", digest), ("WARC-Refers-To", F.when(revisit, whole)),
                 ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))), ("Content-Type", http_kind("response"))],
                F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))),
        _record([*common(F.lit("metadata"), _record_id("metadata", F.col("page_id"), F.col("nr"))), ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields"))], about))
    lines = c.select(F.explode(records).alias("value"))
    mean = pages.select(F.avg(F.octet_length(F.col(options.get("html", "html")).cast("string")))).first()[0] or 0
    per_file = max(3, 3 * int(file_bytes / max(1.0, mean)))
    lines.write.option("lineSep", _EOL + _EOL).option("compression", compression).option("maxRecordsPerFile", per_file).text(path)


class _Source:
    """A byte stream over an archive, inflated piece by piece (plain, or any number of gzip members)."""

    def __init__(self, data: bytes):
        self.data, self.at, self.gz, self.buffer = memoryview(data), 0, data[:2] == b"\x1f\x8b", bytearray()
        self.inflate = zlib.decompressobj(31) if self.gz else None

    def more(self) -> bool:
        part = self.data[self.at:self.at + (1 << 18)]
        if not len(part):
            return False
        if not self.gz:
            self.buffer += part
            self.at += len(part)
            return True
        self.buffer += self.inflate.decompress(part)
        self.at += len(part) - len(self.inflate.unused_data)
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (i := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self.more():
                return None
        out = bytes(self.buffer[:i])
        del self.buffer[:i + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self.more():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an archive.  Raises if a block is shorter than its Content-Length."""
    source = _Source(data)
    while True:
        head = source.until(b"\r\n\r\n")
        if head is None:
            if source.buffer.strip():
                raise ValueError("an archive ends inside a record's headers")
            return
        lines = head.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields["content-length"])
        block = source.take(size)
        if len(block) != size:
            raise ValueError("an archive ends inside a record")
        source.take(4)
        yield fields, block


_COLUMNS = [("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.string()), ("refers_to_id", pa.string()), ("uri", pa.string()), ("date", pa.string()), ("http", pa.string()),
            ("payload", pa.binary()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("meta", pa.map_(pa.string(), pa.string()))]
RECORD = "record_id string, type string, concurrent_to string, refers_to_id string, uri string, date string, http string, payload binary, digest string, payload_bytes long, meta map<string,string>"


def _row(fields: dict[str, str], block: bytes) -> tuple:
    kind = fields.get("warc-type")
    http, payload, digest, size, meta = None, None, None, None, None
    if kind in ("request", "response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = head.decode("utf-8", "replace")
    if kind == "response":
        digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
        said = fields.get("warc-payload-digest", "")
        if said.startswith("sha1:") and len(said) == 45 and said[5:].lower() != digest:
            raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
    elif kind == "revisit":
        payload, digest = None, fields.get("warc-payload-digest", "").removeprefix("sha1:").lower()
    elif kind == "metadata":
        meta = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if x)]
    return (fields.get("warc-record-id"), kind, fields.get("warc-concurrent-to"), fields.get("warc-refers-to"), fields.get("warc-target-uri"), fields.get("warc-date"), http, payload, digest, size, meta)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _COLUMNS, strict=True)], names=[n for n, _ in _COLUMNS])

    for batch in batches:
        for data in batch.column(0):
            rows, size = [], 0
            for fields, block in parse(data.as_py()):
                rows.append(_row(fields, block))
                size += len(block) + 500
                if size > 4 << 20:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the archives below ``path``; payload digests of responses are computed and checked."""
    return arrow_map(spark.read.format("binaryFile").load(path).select("content"), _read, RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row a capture: the response or revisit with its request and metadata, found by concurrent-to identifiers.

    A capture without request or metadata has nulls there; requests and metadata without a capture are left out.
    """
    main = records.where(F.col("type").isin("response", "revisit")).select(
        "record_id", "uri", "date", F.struct("type", "http", "payload", "digest", "payload_bytes", "refers_to_id").alias("response"))
    request = records.where("type = 'request'").select(F.col("concurrent_to").alias("record_id"), F.struct(F.col("record_id").alias("id"), "http").alias("request"))
    metadata = records.where("type = 'metadata'").select(F.col("concurrent_to").alias("record_id"), F.struct(F.col("record_id").alias("id"), F.col("meta").alias("fields")).alias("metadata"))
    return main.join(request, "record_id", "left").join(metadata, "record_id", "left")
