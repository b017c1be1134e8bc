"""WARC archives: write, read, and resolve revisits into deduplicated archives.

An archive is a folder of gzip files, each a run of WARC/1.1 records. Spark's
text writer makes them: a record is one string and the record trailer (two
line ends) is the line separator, so task retries and commits are Spark's
own. Reading takes the same separator apart again and puts records together
by Content-Length, so payloads may hold the separator. gzip files are not
split and a task reads its files in order, so a reader holds one record at a
time, however large the file.

Resolution shuffles headers only: the first response per payload digest is a
pre-aggregated minimum, joined back to the headers (a hot digest is a skewed
join side against one row, which AQE splits). Only then do the bodies meet
their decision, by record id, which no record shares.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslens.llm.common import col, scratch_table
from opslens.session import scratch_path

EOL, SEP = "\r\n", "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32, BASE32_HEX = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RECORD = ("record_id string, record_type string, page_id bigint, uri string, date string, digest string, "
          "refers_to string, payload_bytes bigint, payload binary")
BATCH_BYTES = 8 << 20


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 SHA-1 (bare) of a binary column."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.upper(F.concat(*parts)), BASE32_HEX, BASE32)


def _header(name: str, value: Column) -> Column:
    """One header line; nothing for a null value. Control characters and blanks cannot break the line."""
    safe = F.regexp_replace(value.cast("string"), r"[\x00-\x20\x7F]", "%20")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(EOL)), F.lit(""))


def _bytes(text: Column) -> Column:
    return F.octet_length(text)


def record_text(record_type: Column, record_id: Column, uri: Column, date: Column, digest: Column, page_id: Column,
                payload: Column, refers_to: Column | None = None, refers_uri: Column | None = None,
                refers_date: Column | None = None, payload_bytes: Column | None = None) -> Column:
    """A WARC record (without its trailer) as one string; ``payload`` is left out of revisits."""
    none = F.lit(None).cast("string")
    full = _bytes(payload) if payload_bytes is None else payload_bytes
    revisit = record_type == "revisit"
    block = F.concat(F.lit(HTTP_HEAD), full.cast("string"), F.lit(SEP), F.when(revisit, "").otherwise(payload))
    angled = F.concat(F.lit("<"), record_id, F.lit(">"))
    refers = none if refers_to is None else F.concat(F.lit("<"), refers_to, F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1" + EOL), _header("WARC-Type", record_type), _header("WARC-Record-ID", angled),
        _header("WARC-Date", date), _header("WARC-Target-URI", uri),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        _header("WARC-Profile", F.when(revisit, PROFILE)), _header("WARC-Refers-To", refers),
        _header("WARC-Refers-To-Target-URI", none if refers_uri is None else refers_uri),
        _header("WARC-Refers-To-Date", none if refers_date is None else refers_date),
        _header("X-Page-ID", page_id), F.lit("Content-Type: application/http;msgtype=response" + EOL),
        F.lit("Content-Length: "), _bytes(block).cast("string"), F.lit(SEP), block)


def _write(text: Column, rows: DataFrame, path: str) -> None:
    rows.select(text.alias("value")).write.option("lineSep", SEP).option("compression", "gzip").text(path)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> None:
    """One response record per row, payload the html in UTF-8 (null: empty), under ``path``.

    Record ids are unique per row, also for repeated rows and null page ids:
    they are drawn once, here, and from then on read from the files.
    """
    run = uuid.uuid4().hex
    at = F.lpad(F.lower(F.hex(F.monotonically_increasing_id())), 16, "0")
    record_id = F.concat(F.lit(f"urn:uuid:{run[:8]}-{run[8:12]}-{run[12:16]}-"), F.substring(at, 1, 4), F.lit("-"),
                         F.substring(at, 5, 12))
    rows = pages.select(col(id_col).cast("bigint").alias("page_id"), col(url_col).cast("string").alias("uri"),
                        F.coalesce(col(html_col).cast("string"), F.lit("")).alias("payload"),
                        record_id.alias("record_id"),
                        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"))
    _write(record_text(F.lit("response"), F.col("record_id"), F.col("uri"), F.col("date"),
                       payload_digest(F.col("payload").cast("binary")), F.col("page_id"), F.col("payload")), rows, path)


def _parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split(EOL)
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records(segments: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of a stream cut at the record separator."""
    sep, buf, head, at = SEP.encode(), bytearray(), None, 0
    for seg in segments:
        buf += seg
        buf += sep
        while True:
            if head is None:
                skip = len(buf) - len(buf.lstrip(b"\r\n"))
                if skip:
                    del buf[:skip]
                at = buf.find(sep)
                if at < 0:
                    break
                head, at = _parse_head(bytes(buf[:at])), at + len(sep)
            end = at + int(head["content-length"])
            if len(buf) < end:
                break
            yield head, bytes(buf[at:end])
            del buf[:end]
            head = None
    if head is not None or buf.strip(b"\r\n"):
        raise ValueError("the archive ends inside a record")


def _row(head: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    payload = block.partition(SEP.encode())[2]
    revisit = head.get("warc-type") == "revisit"
    digest = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    size = None
    if not revisit:
        size = len(payload)
        if with_payload:  # what is handed on is what was read, not what the header says
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    page = head.get("x-page-id")
    strip = lambda v: v.strip("<>") if v else None
    return (strip(head.get("warc-record-id")), head.get("warc-type"), int(page) if page else None,
            head.get("warc-target-uri"), head.get("warc-date"), digest, strip(head.get("warc-refers-to")), size,
            payload if with_payload and not revisit else None)


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of an archive folder (schema ``RECORD``); revisits have no payload and no payload_bytes.

    With the payload the digest of responses is computed from the bytes read.
    """
    lines = spark.read.option("lineSep", SEP).text(path).select(F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
                            ("uri", pa.string()), ("date", pa.string()), ("digest", pa.string()),
                            ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        rows, held = [], 0
        for head, block in records(v.as_py() for b in batches for v in b.column(0)):
            rows.append(_row(head, block, with_payload))
            held += len(block) + 500
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return lines.mapInArrow(run, RECORD)


def resolve_revisits(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> None:
    """Write the archive ``source`` deduplicated to ``target`` with fresh headers.

    Of the responses with equal payload digests of at least ``min_bytes``
    bytes, the one with the smallest page id (then record id; null ids last)
    stays a response, the others become revisits of it. Records that already
    are revisits are pointed at that response; without one in the archive
    they keep what they referred to. Every record of the source has one in
    the target.
    """
    heads = scratch_table(read_archive(spark, source, with_payload=False).drop("payload"), "warc-heads")
    responses = heads.where((F.col("record_type") == "response") & (F.col("payload_bytes") >= min_bytes))
    first = (responses.groupBy("digest").agg(F.min(F.struct(
        F.col("page_id").isNull().alias("no_page"), "page_id", "record_id", "uri", "date", "payload_bytes")).alias("first")))
    is_first = F.col("record_id") == F.col("first.record_id")
    applies = (F.col("record_type") == "revisit") | (F.col("payload_bytes") >= min_bytes)
    revisits = scratch_table(
        heads.join(first, "digest").where(applies & ~is_first)
        .select("record_id", F.col("first.record_id").alias("to_id"), F.col("first.uri").alias("to_uri"),
                F.col("first.date").alias("to_date"), F.col("first.payload_bytes").alias("to_bytes")), "warc-revisits")
    bodies = read_archive(spark, source).join(revisits, "record_id", "left")
    revisit = F.col("to_id").isNotNull() | (F.col("record_type") == "revisit")
    text = record_text(
        F.when(revisit, "revisit").otherwise("response"), F.col("record_id"), F.col("uri"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.col("digest"), F.col("page_id"),
        F.coalesce(F.col("payload").cast("string"), F.lit("")), F.coalesce("to_id", "refers_to"), F.col("to_uri"),
        F.col("to_date"), F.coalesce("to_bytes", "payload_bytes", F.lit(0)))
    _write(text, bodies, target)


def revisit_table(records_read: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to (the response's page_id)."""
    heads = scratch_table(records_read.drop("payload"), "warc-resolved")
    originals = heads.where("record_type = 'response'").select(
        F.col("record_id").alias("o_id"), F.col("page_id").alias("o_page"), F.col("payload_bytes").alias("o_bytes"),
        F.col("digest").alias("o_digest"))
    return heads.join(originals, F.col("refers_to") == F.col("o_id"), "left").select(
        "page_id", F.coalesce("payload_bytes", "o_bytes").alias("payload_bytes"),
        F.coalesce("o_digest", "digest").alias("payload_digest"), "record_type", F.col("o_page").alias("refers_to"))


def deduplicated_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                       min_bytes: int = 0) -> DataFrame:
    """Archive the pages, resolve revisits, read the deduplicated archive back: one row per input row.

    Null html is an empty payload (empty payloads are equal too), a null URL
    has no target header, null page ids are never the smallest. Of repeated
    rows one is the response and the others revisit it. An empty table gives
    an empty archive and no rows. Other columns are not read.
    """
    spark = pages.sparkSession
    raw, clean = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc-clean")
    write_archive(pages, raw, id_col, url_col, html_col)
    resolve_revisits(spark, raw, clean, min_bytes)
    return revisit_table(read_archive(spark, clean))
