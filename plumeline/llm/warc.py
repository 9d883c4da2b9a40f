"""WARC archives: write pages, index the records, read selected ones back.

Records are written by Spark's text writer, whose line separator is the blank
line pair that ends a WARC record; so each part file is an archive, committed
as any Spark output is.  An index (file, offset, length, URL, digest) is built
first by one walk over the record headers.  Reads take index rows, deal them by
file region, sort them by offset and fetch neighbours in one byte-range read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .text import shared_path, whole, written

_CRLF = "\r\n"
_END = b"\r\n\r\n"
# Names of the archive format.
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = "urn:page:"
# One read fetches at most this much, and reads over gaps of this much.
READ_BYTES = 4 << 20
GAP_BYTES = 64 << 10
INDEX = "path string, offset long, length long, url string, digest string, record_type string, page_id string"
RECORD = ("page_id string, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to string, payload string")


def payload_digest(payload: Column) -> Column:
    """Base32 SHA-1: the forty hex digits in four groups of ten, each as eight base32 digits."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _equal_payloads(rows: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """Payloads that occur more than once: ``_digest, _bytes, _first``, the largest page id of each.

    Written, so that its size is known when the join is planned.
    """
    equal = rows.filter(F.col("_bytes") >= min_revisit_bytes).groupBy("_digest", "_bytes").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_page").alias("_first")).filter("_n > 1").drop("_n")
    return written(equal, "equal-payloads")


def write_archives(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url",
                   html: str = "html", date: str = "2024-01-01T00:00:00Z",
                   min_revisit_bytes: int = 0) -> None:
    """Write one record per row of ``pages`` below ``path``.

    Among equal payloads the row with the largest id is the response and the
    others are revisits of it.  A NULL payload is empty, a NULL id is the
    smallest, rows that repeat an id and a payload are all written alike, and
    line breaks in a URL are percent-encoded.
    """
    rows = pages.select(pages[page_id].cast("bigint").alias("_page"), pages[url].cast("string").alias("_url"),
                        whole(pages[html]).alias("_html"))
    rows = rows.withColumns({"_bytes": F.octet_length("_html").cast("bigint"),
                             "_digest": payload_digest(F.col("_html"))})
    equal = _equal_payloads(rows.drop("_html", "_url"), min_revisit_bytes)
    rows = rows.join(equal, ["_digest", "_bytes"], "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_page").eqNullSafe(F.col("_first"))
    body = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        F.col("_bytes").cast("string"), F.lit(_CRLF * 2),
        F.when(revisit, "").otherwise(F.col("_html")))
    name = lambda c: F.concat(F.lit(f"<{_PAGE}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))

    def field(key: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{key}: "), value, F.lit(_CRLF)), F.lit(""))

    clean = F.replace(F.replace("_url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit(_VERSION + _CRLF),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", name(F.col("_page"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", clean),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "_digest")),
        field("WARC-Profile", F.when(revisit, _PROFILE)),
        field("WARC-Refers-To", F.when(revisit, name(F.col("_first")))),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(F.col("_body")).cast("string")),
        F.lit(_CRLF), F.col("_body"))
    rows.withColumn("_body", body).select(record.alias("value")).write.option(
        "lineSep", _CRLF * 2).text(path)


def _open(path: str):
    """The file of a Hadoop path, by the store that its scheme names."""
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[len("file:"):].lstrip("/"))
    store, inside = fs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split(_CRLF)
    return dict(line.split(": ", 1) for line in lines if ": " in line)


def _walk(path: str) -> Iterator[tuple]:
    """Index rows of one archive; bodies are skipped, at most one chunk is held."""
    with _open(path) as file:
        size, at, held_from, held = file.size(), 0, 0, b""
        while at < size:
            head = held[at - held_from:]
            stop = head.find(_END)
            if stop < 0:
                wanted = max(READ_BYTES // 4, 2 * len(head))
                file.seek(at)
                held_from, held = at, file.read(wanted)
                if held.find(_END) < 0 and at + len(held) >= size:
                    raise ValueError(f"{path}: no record at {at}")
                continue
            fields = _headers(head[:stop])
            length = stop + len(_END) + int(fields["Content-Length"])
            yield (path, at, length, fields.get("WARC-Target-URI"),
                   fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"],
                   fields["WARC-Record-ID"][len(_PAGE) + 1:-1])
            at += length + len(_END)
            if at >= held_from + len(held):
                held_from, held = at, b""


def _batches(rows: Iterator[tuple], schema: pa.Schema, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most ``limit`` bytes of their last column, or 4096 rows."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[-1] or "")
        if len(held) >= 4096 or weight >= limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _schema(text: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in text.split(", "))])


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``: `INDEX`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths = (p.as_py() for batch in batches for p in batch.column(0))
        yield from _batches((row for p in paths for row in _walk(p)), _schema(INDEX), READ_BYTES)

    return files.mapInArrow(run, INDEX)


def _parsed(raw: bytes, payloads: bool) -> tuple:
    stop = raw.index(_END)
    fields = _headers(raw[:stop])
    body = raw[stop + len(_END):]
    cut = body.index(_END)
    payload = body[cut + len(_END):]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind, n = fields["WARC-Type"], int(_headers(body[:cut])["Content-Length"])
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (found, len(payload)) != (digest, n):
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not match its digest")
    refers = fields.get("WARC-Refers-To")
    return (fields["WARC-Record-ID"][len(_PAGE) + 1:-1], fields.get("WARC-Target-URI"), n, digest, kind,
            refers and refers[len(_PAGE) + 1:-1], payload.decode() if payloads and kind == "response" else None)


def _fetched(rows: list[tuple[str, int, int]], payloads: bool) -> Iterator[tuple]:
    """Records of sorted (path, offset, length) rows; near ones share a read."""
    i, file, opened = 0, None, None
    try:
        while i < len(rows):
            path, begin, length = rows[i]
            j, end = i + 1, begin + length
            while (j < len(rows) and rows[j][0] == path and rows[j][1] - end <= GAP_BYTES
                   and rows[j][1] + rows[j][2] - begin <= READ_BYTES):
                end = max(end, rows[j][1] + rows[j][2])
                j += 1
            if opened != path:
                if file:
                    file.close()
                file, opened = _open(path), path
            file.seek(begin)
            block = file.read(end - begin)
            for _, at, size in rows[i:j]:
                yield _parsed(block[at - begin:at - begin + size], payloads)
            i = j
    finally:
        if file:
            file.close()


def read_records(selected: DataFrame, *, payloads: bool = True) -> DataFrame:
    """The records of index rows: `RECORD`; digests of responses are verified.

    Index rows are dealt by file region and sorted, so tasks read forward.
    """
    region = F.floor(F.col("offset") / READ_BYTES)
    dealt = selected.select("path", "offset", "length").repartition("path", region)
    dealt = dealt.sortWithinPartitions("path", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            yield from _batches(_fetched(rows, payloads), _schema(RECORD), READ_BYTES)

    return dealt.mapInArrow(run, RECORD)


def archive_and_read(pages: DataFrame, *, payloads: bool = False) -> DataFrame:
    """Write ``pages`` to archives in the shared folder, index them, read all records back."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write_archives(pages, path)
    index = written(build_index(spark, path), "warc-index")
    return read_records(index, payloads=payloads)
