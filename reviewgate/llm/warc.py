"""WARC archives: written as text files by Spark, read by a Python data source.

A WARC record ends with two line breaks, so Spark's text writer with that line
separator writes archives as they are, to any store, gzipped. The reader plans
one partition for a run of files, skips records by the header predicates that
Spark pushes down, and only then touches a payload: unwanted ones are
stepped over, and with ``payload=digest`` or ``none`` no payload is kept either.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition)

from ..session import scratch_path
from .common import session_setting, stored

_CRLF = "\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: RFC 4648
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_FIELDS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
           "date": "warc-date", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to",
           "full_length": "x-payload-length"}
_SCHEMA = ", ".join(f"{c} string" for c in _FIELDS) + ", payload binary, read_length long, read_digest string"
_ID = "urn:x-page:"


def payload_digest(payload: Column) -> Column:
    """Base32 SHA-1 of a text's UTF-8 bytes: five bytes are eight letters."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing where there is no value; control characters
    would end the line and are percent-encoded."""
    safe = F.regexp_replace(value, "[\\x00-\\x1f\\x7f]", "%20")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(_CRLF)), F.lit(""))


def with_duplicates(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, payload_bytes, digest, refers_to``: of rows with
    equal payloads of at least ``min_bytes`` the largest page_id is the one that
    the others refer to. Digests of single rows never leave their count."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("payload")) \
        .withColumn("payload_bytes", F.octet_length("payload").cast("long")) \
        .withColumn("digest", payload_digest(F.col("payload")))
    first = stored(rows.where(F.col("payload_bytes") >= min_bytes).groupBy("digest")
                   .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").select("digest", "first_id"), "warc-duplicates")
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "digest",
        F.when(F.col("first_id") != F.col("page_id"), F.col("first_id"))
        .when(F.col("page_id").isNull(), F.col("first_id")).alias("refers_to"))


def warc_records(rows: DataFrame, date: str) -> DataFrame:
    """One WARC/1.1 record a row, without its final line breaks."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(_CRLF * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    return rows.withColumn("block", block).select(F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.concat(F.lit(f"<{_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                                           F.lit(">"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("X-Payload-Length", F.col("payload_bytes").cast("string")),
        _header("WARC-Profile", F.when(
            revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        _header("WARC-Refers-To", F.concat(F.lit(f"<{_ID}"), F.col("refers_to").cast("string"), F.lit(">"))),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length("block").cast("string")),
        F.lit(_CRLF), F.col("block")).alias("value"))


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", min_bytes: int = 0,
               records_per_file: int = 200_000) -> None:
    """Writes the pages as gzipped WARC files below ``path``. Null html is an
    empty payload, a null url has no target header; rows that share the largest
    page_id of their payload are all responses."""
    with session_setting(pages.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        warc_records(with_duplicates(pages, min_bytes), date).write \
            .option("lineSep", _CRLF * 2).option("compression", "gzip") \
            .option("maxRecordsPerFile", records_per_file).text(path)


class WarcFiles(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _skip(stream, n: int) -> None:
    while n > 0:
        got = len(stream.read(min(n, 1 << 20)))
        if not got:
            raise ValueError("a WARC record ends early")
        n -= got


def _head(stream) -> dict[str, str]:
    """Header lines up to the empty line, by lower-cased name."""
    out: dict[str, str] = {}
    last = None
    while True:
        line = stream.readline()
        if not line:
            raise ValueError("a WARC header ends early")
        line = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if not line:
            return out
        if line[0] in " \t" and last:
            out[last] += " " + line.strip()
            continue
        name, _, value = line.partition(":")
        last = name.strip().lower()
        out[last] = value.strip()


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "body")
        self.target = int(options.get("partitionbytes", 64 << 20))
        if self.payload not in ("body", "digest", "none"):
            raise ValueError("payload must be body, digest or none")
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in _FIELDS:
                values = f.value if isinstance(f, In) else (f.value,)
                self.wanted.append((column, frozenset(values)))
            else:
                yield f

    def partitions(self) -> list[WarcFiles]:
        fs, root = pyarrow.fs.FileSystem.from_uri(self.path)
        found = fs.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
        files = sorted((i.size, i.path) for i in found
                       if i.is_file and i.size and not i.base_name.startswith(("_", ".")))
        out, held, used = [], [], 0
        for size, path in files:
            if held and used + size > self.target:
                out.append(WarcFiles(held))
                held, used = [], 0
            held.append(path)
            used += size
        return out + [WarcFiles(held)] if held else out

    def read(self, partition: WarcFiles):
        fs, _ = pyarrow.fs.FileSystem.from_uri(self.path)
        names = [*_FIELDS, "payload", "read_length", "read_digest"]
        types = [pa.string()] * len(_FIELDS) + [pa.binary(), pa.int64(), pa.string()]
        rows, held = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as raw:
                stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 20)
                for row in self._records(stream):
                    rows.append(row)
                    held += len(row[len(_FIELDS)] or b"") + 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def _records(self, stream):
        while True:
            line = stream.readline()
            if not line:
                return
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
            head = _head(stream)
            length = int(head["content-length"])
            values = [head.get(h) for h in _FIELDS.values()]
            fields = dict(zip(_FIELDS, values))
            if self.payload == "none" or any(fields[c] not in allowed for c, allowed in self.wanted):
                _skip(stream, length)
                if self.payload == "none" and all(fields[c] in allowed for c, allowed in self.wanted):
                    yield (*values, None, None, None)
                continue
            body = stream.read(length)
            if len(body) < length:
                raise ValueError("a WARC record ends early")
            if head.get("content-type", "").startswith("application/http"):
                body = body.partition(b"\r\n\r\n")[2]
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
            yield (*values, body if self.payload == "body" else None, len(body), digest)


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``; option ``payload``: ``body``
    (default), ``digest`` (length and SHA-1 as read) or ``none``. Equality and IN
    predicates on the header columns are pushed to the reader, which needs
    ``spark.sql.python.filterPushdown.enabled``. Files end in ``.gz`` or are
    plain; a broken record fails the read."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


def read_warc(spark: SparkSession, path: str, payload: str = "body", record_type: str | None = None) -> DataFrame:
    """The records below ``path``, by the data source. Turns the session's filter
    pushdown for Python sources on, and leaves it on: rows are read later."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    rows = spark.read.format("warc").option("payload", payload).load(path)
    return rows.where(F.col("record_type") == record_type) if record_type else rows


def _page(column: str) -> Column:
    return F.regexp_extract(column, f"<{_ID}(-?[0-9]+)>", 1)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the pages as WARC files under the shared folder and reads them back:
    ``page_id, payload_bytes, payload_digest, record_type, refers_to``, a row a page.

    Responses are read with their payload, whose length and SHA-1 are what comes
    back; of revisits only headers are read. A null page_id comes back as null.
    An empty table gives no rows; other columns are ignored."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path, min_bytes=min_bytes)
    rows = read_warc(spark, path, "digest", "response")
    responses = rows.select(
        _page("record_id").try_cast("long").alias("page_id"), F.col("read_length").alias("payload_bytes"),
        F.col("read_digest").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    rows = read_warc(spark, path, "none", "revisit")
    revisits = rows.select(
        _page("record_id").try_cast("long").alias("page_id"), F.col("full_length").cast("long").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type",
        _page("refers_to").try_cast("long").alias("refers_to"))
    return responses.unionByName(revisits)
