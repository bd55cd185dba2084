"""WARC archives without repeated payloads.

Writing resolves revisits first, on headers alone: every page gives a header
(payload digest, size, page_id, url), equal headers are counted before they
are shuffled, and the greatest page of each digest is its response.  Headers
joined with their digest's response become revisit records; a payload is
shuffled once a digest and task, and written once.

An archive is a file of whole WARC/1.1 records, written by Spark's text
writer, whose line separator is the end of a record.  So Spark's committer
keeps files of lost tasks out, and any store that Spark reaches will do.
Reading goes by Content-Length, so payloads may hold anything, record ends and
headers among it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulary.llm.common import staged

_VERSION, _BREAK = "WARC/1.1", "\r\n"
_END = _BREAK * 2
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORDS = ("record_id string, record_type string, page_id long, url string, payload_bytes long, "
           "payload_digest string, refers_to_id string, payload binary")


def base32_sha1(payload: Column) -> Column:
    """The upper-case base32 SHA-1 of a string or binary, without padding (20 bytes need none)."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, k, 10), 16, 32), 8, "0") for k in range(1, 40, 10)]
    return F.translate(F.concat(*parts), _HEX, _BASE32)


def _header(name: str, value: Column) -> Column:
    """A header line; none where the value is null.  Line breaks are percent-encoded."""
    text = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), text, F.lit(_BREAK)), F.lit(""))


def _record_id(page_id: str, url: str, copy: Column) -> Column:
    """An id of a record's digest, page and copy, the same in every attempt of a task."""
    name = F.sha2(F.to_json(F.struct(
        "payload_digest", "payload_bytes", F.col(page_id).alias("page"), F.col(url).alias("url"), copy.alias("copy"))), 256)
    parts = [F.substring(name, k, n) for k, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def resolve(pages: DataFrame, least_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Responses (with ``html``) and revisits of the rows of ``pages``.

    Of rows whose payload, the html in UTF-8, is the same and has
    ``least_bytes`` or more, the one with the greatest page_id is the response
    (of equal ones that of the greatest url; of rows equal in all three any
    one; a null is the least), and the others are revisits.  Smaller payloads
    are all responses.  A null html is an empty one.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html")) \
        .withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": base32_sha1(F.col("html")),
                      "payload_key": F.xxhash64("html")})
    key = ["payload_digest", "payload_bytes", "payload_key"]
    large = F.col("payload_bytes") >= least_bytes
    headers = rows.where(large).groupBy(*key, "page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    first = headers.groupBy(*key).agg(F.max(F.struct("page_id", "url")).alias("first"))
    payloads = rows.where(large).groupBy(*key).agg(F.any_value("html").alias("html"))
    responses = (
        first.join(payloads, key).select(*key[:2], "first.page_id", "first.url", "html")
        .unionAll(rows.where(~large).select(*key[:2], "page_id", "url", "html")))
    same = F.struct("page_id", "url").eqNullSafe(F.col("first"))
    revisits = (
        headers.join(first, key)
        .select(*key[:2], "page_id", "url", F.col("first.page_id").alias("to_page"), F.col("first.url").alias("to_url"),
                F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"), same.alias("same"))
        .where("copy > 1 OR NOT same").drop("same"))
    return responses, revisits


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
                   records_per_file: int = 20_000) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) to the folder ``path``.

    Of equal payloads one is written (see :func:`resolve`); the others are
    revisit records whose fresh headers name it.  A null page_id or url has no
    header.  No rows: no records.  Files are gzip streams.
    """
    responses, revisits = resolve(pages, least_bytes)

    def record(kind: str, id_: Column, block: Column, *headers: Column) -> Column:
        return F.concat(
            F.lit(f"{_VERSION}{_BREAK}WARC-Type: {kind}{_BREAK}WARC-Date: {date}{_BREAK}"), _header("WARC-Record-ID", id_),
            _header("WARC-Target-URI", F.col("url")), _header("WARC-Page-ID", F.col("page_id")),
            _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")), *headers,
            F.lit(f"Content-Type: text/html{_BREAK}"), _header("Content-Length", F.octet_length(block)), F.lit(_BREAK), block)

    first = F.lit(1).cast("long")
    # Small payloads are all responses, so rows that are equal get the same id; nothing refers to them.
    whole = responses.select(record("response", _record_id("page_id", "url", first), F.col("html")).alias("value"))
    again = revisits.select(record(
        "revisit", _record_id("page_id", "url", F.col("copy")), F.lit(""),
        _header("WARC-Refers-To", _record_id("to_page", "to_url", first)),
        _header("WARC-Refers-To-Target-URI", F.col("to_url")), F.lit(f"WARC-Profile: {_PROFILE}{_BREAK}")).alias("value"))
    whole.unionAll(again).write.options(
        lineSep=_END, compression="gzip", maxRecordsPerFile=records_per_file).text(path)


def _records(name: str, file: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    while line := file.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"{name}: no record begins where one must")
        headers = {}
        while (line := file.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode().partition(":")
            headers[key.lower()] = value.strip(" \r\n")
        block = file.read(int(headers["content-length"]))
        if file.read(len(_END)) != _END.encode():
            raise ValueError(f"{name}: {headers.get('warc-record-id')} isn't whole")
        yield headers, block


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives in ``path`` (columns ``RECORDS``).

    Size and digest are a response's own, taken from the bytes that were read;
    a digest that differs from its header is an error.  A revisit has the
    digest of its header, no size and no payload.  Other records are left
    out.  An archive's compressed bytes must fit a task's memory.
    """
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def row(name: str, headers: dict[str, str], block: bytes) -> tuple:
        said = headers["warc-payload-digest"].removeprefix("sha1:")
        response = headers["warc-type"] == "response"
        if response and base64.b32encode(hashlib.sha1(block).digest()).decode() != said:
            raise ValueError(f"{name}: the payload of {headers['warc-record-id']} isn't whole")
        page = headers.get("warc-page-id")
        return (headers["warc-record-id"], headers["warc-type"], None if page is None else int(page),
                headers.get("warc-target-uri"), len(block) if response else None, said,
                headers.get("warc-refers-to"), block if response and payloads else None)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                file: BinaryIO = pa.BufferReader(content.as_buffer())
                if content.as_buffer()[:2].to_pybytes() == b"\x1f\x8b":
                    file = gzip.GzipFile(fileobj=file)
                rows, held = [], 0
                for headers, block in _records(path.as_py(), io.BufferedReader(file)):
                    if headers["warc-type"] in ("response", "revisit"):
                        rows.append(row(path.as_py(), headers, block))
                        held += len(block) + 200
                    if held > 1 << 22:
                        yield table(rows)
                        rows, held = [], 0
                yield table(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(scan, RECORDS)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A row for each page in the archives of ``path``: page_id, payload_bytes,
    payload_digest, record_type and refers_to.

    A revisit has the size and the digest of the response that it refers to,
    and refers_to is that page's id; a response's is null.  A revisit whose
    response isn't there has null sizes.
    """
    records = staged(read_archives(spark, path, payloads=False).drop("payload"), "warc-records")
    response = F.col("record_type") == "response"
    originals = records.where(response).select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
        "payload_bytes", "payload_digest")
    own = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return records.where(response).select(*own, F.lit(None).cast("long").alias("refers_to")).unionByName(
        records.where(~response).select("page_id", "record_type", "refers_to_id")
        .join(originals, "refers_to_id", "left").select(*own, "refers_to"))
