"""WARC archives with revisit records.

Only headers (id, URL, digest, length) are shuffled by payload digest, to find the first record of each payload that
several records share, and headers are all that a revisit record needs. Responses are written where the pages
are read: pages that turned out to be revisits are left out there by a broadcast of their ids and digests, as long as these are
``SENT`` at most; above that the pages are joined with them, which shuffles the payloads once.
The archives are written by Spark's text sink: a record is a line of text that ends in the
blank lines that close a WARC record, in gzip files that are read whole and in order, as a stream.
Reading takes record lengths from the headers, so a payload may hold anything, and keeps one record in
memory. Revisits are joined to their responses by record id; a payload that a third of all records
share is a skewed join that adaptive execution splits.

Defined results: null payload is empty. Of equal payloads the record with the smallest id is the
response; rows that repeat that id too are all responses, and a null id ranks last. Payloads below
``least`` bytes are always responses. Without a URL a record names ``urn:page:<id>``. An empty table
gives an archive without records. A payload of any length is one record. Columns beyond the three named ones are ignored, whatever
their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.tables import written
from tallyloom.sources.scratch import scratch_path

# Fixed values of the WARC 1.1 and base32 standards.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

SENT = 1 << 18

RECORD = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
    "record_id string, refers_to string"
)


def payload_digest(payload: Column) -> Column:
    """SHA-1 in upper-case base32: 20 bits at a time through a number in base 32."""
    hexed = F.sha1(F.encode(payload, "UTF-8"))
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def resolve(headers: DataFrame, least: int = 0) -> DataFrame:
    """``(payload_digest, first_id)`` for the payloads of several ``headers`` ``(page_id, payload_digest,
    payload_bytes)`` that may be revisited."""
    return (
        headers.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 and first_id is not null")
        .drop("n")
    )


def _record_id(page_id: Column, digest: Column) -> Column:
    """A name-like UUID from id and digest; the same record has the same name in every run."""
    h = F.md5(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("null")), digest))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write_archives(
    pages: DataFrame,
    path: str,
    least: int = 0,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """One record per page, with fresh headers, as gzipped archives under ``path``."""
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(payload_column), F.lit("")).alias("payload"),
    ).withColumns({"payload_digest": payload_digest(F.col("payload")), "payload_bytes": F.octet_length("payload")})
    heads = written(rows.drop("payload"), "headers")
    firsts = written(resolve(heads, least), "firsts")
    revisits = heads.join(firsts, "payload_digest").where(~F.col("page_id").eqNullSafe(F.col("first_id")))
    revisits = written(revisits.where(F.col("payload_bytes") >= least), "revisits")
    gone = revisits.select(F.col("page_id").alias("gone_id"), F.col("payload_digest").alias("gone_digest")).distinct()
    if revisits.count() <= SENT:
        gone = F.broadcast(gone)
    same = (F.col("payload_digest") == F.col("gone_digest")) & F.col("page_id").eqNullSafe(F.col("gone_id"))
    responses = rows.join(gone, same, "left_anti")
    none = F.lit(None).cast("long")
    records = responses.select(_record(F.col("payload"), none, date).alias("value")).unionByName(
        revisits.select(_record(None, F.col("first_id"), date).alias("value"))
    )
    records.write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _record(payload: Column | None, first: Column, date: str) -> Column:
    """A response with its payload, or a revisit of the page ``first``; the last line end is the sink's."""
    page, digest = F.col("page_id"), F.col("payload_digest")
    name = F.coalesce(page.cast("string"), F.lit("null"))
    url = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.concat(F.lit("urn:page:"), name))
    size = F.lit(len(HTTP)) if payload is None else F.col("payload_bytes") + len(HTTP)
    refers = F.lit("")
    if payload is None:
        refers = F.concat(_header("WARC-Refers-To", _record_id(first, digest)), _header("WARC-Profile", F.lit(PROFILE)))
    return F.concat(
        F.lit(f"{VERSION}\r\n"),
        _header("WARC-Type", F.lit("revisit" if payload is None else "response")),
        _header("WARC-Record-ID", _record_id(page, digest)),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", url),
        F.when(page.isNotNull(), _header("X-Page-ID", name)).otherwise(""),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        refers,
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", size.cast("string")),
        F.lit("\r\n"),
        F.lit(HTTP),
        F.lit("") if payload is None else payload,
        F.lit("\r\n\r"),
    )


def _records(stream: Iterator[tuple[str, bytes]]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of lines that come with the name of their file."""
    held, need, head, at = [], 0, None, None
    size = 0
    for name, line in stream:
        if name != at:
            if size:
                raise ValueError(f"{at} ends within a record")
            at = name
        held.append(line)
        size += len(line) + 1
        if head is None and line == b"\r":
            fields = b"\n".join(held).decode("utf-8").split("\r\n")
            if not fields[0].startswith("WARC/"):
                raise ValueError(f"no WARC record in {at}")
            head = dict(f.split(": ", 1) for f in fields[1:] if ": " in f)
            held, size, need = [], 0, int(head["Content-Length"]) + 4
        elif head is not None and size >= need:
            block = b"\n".join(held)[: need - 4]
            yield head, block
            held, size, head = [], 0, None
    if size or head is not None:
        raise ValueError(f"{at} ends within a record")


def _parse(with_payload: bool):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines():
            for batch in batches:
                files = batch.column("file").to_pylist()
                yield from zip(files, (v.as_py() for v in batch.column("value")), strict=True)

        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "record_id", "refers_to"]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
            if with_payload:
                names.append("payload")
                kinds.append(pa.binary())
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for head, block in _records(lines()):
            kind = head["WARC-Type"]
            payload = block.partition(b"\r\n\r\n")[2]
            page = head.get("X-Page-ID")
            digest = size = None
            if kind == "response":
                digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
            row = (
                None if page is None else int(page), head["WARC-Target-URI"], kind, digest, size,
                head["WARC-Record-ID"], head.get("WARC-Refers-To"),
            )
            rows.append((*row, payload) if with_payload else row)
            held += len(payload) if with_payload else 0
            if len(rows) >= 4096 or held > 16 << 20:
                yield flush()
                rows, held = [], 0
        yield flush()

    return parse


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Every record under ``path``; digest and length are those of the block that was read, null for
    revisits until ``resolved``."""
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))
    return lines.mapInArrow(_parse(with_payload), RECORD + (", payload binary" if with_payload else ""))


def resolved(records: DataFrame) -> DataFrame:
    """Records with revisits joined to their responses: digest, length (and payload, if read) are those of
    the full payload, ``refers_to_page`` the response's id."""
    payload = [c for c in ("payload",) if c in records.columns]
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("refers_to_page"),
        *[F.col(c).alias(f"full_{c}") for c in ("payload_digest", "payload_bytes", *payload)],
    ).dropDuplicates(["refers_to"])
    revisits = records.where("record_type = 'revisit'").drop("payload_digest", "payload_bytes", *payload)
    revisits = revisits.join(responses, "refers_to", "left").withColumnsRenamed(
        {f"full_{c}": c for c in ("payload_digest", "payload_bytes", *payload)}
    )
    firsts = records.where("record_type = 'response'").withColumn("refers_to_page", F.lit(None).cast("long"))
    return firsts.unionByName(revisits)


def archive_and_read(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the pages as archives in the shared folder, read them back and resolve the revisits."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, least)
    return resolved(written(read_archives(spark, path), "records"))
