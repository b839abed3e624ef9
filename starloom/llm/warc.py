"""WARC archives written and read as Spark tables, with segmented records.

Writing: one record per row. Of rows with equal payloads of at least
``min_revisit`` bytes the one with the largest key is a response and the
others are revisits that refer to it. A response's payload is sent in chunked
transfer framing; a block above ``segment_bytes`` becomes a first segment and
continuation records. Records are gzip-compressed text files without a limit
on their bytes (Spark's text writer passes bytes through); each file holds a
bounded number of bounded records.

Reading: records are cut out by Content-Length, segments are grouped by their
origin's id and ordered by number, numbers and total length are verified,
chunked framing is decoded and the payload digest compared. ``status`` says
what was found: ``ok``, ``segments`` (one is missing), ``length``, ``framing``,
``digest`` or, for a revisit without its response, ``reference``.

Defined results: a null payload is written as an empty one; a null url leaves
its header out; rows with a null key are written (their key reads back as
null) and rank below all others; repeated rows (equal key and payload) share a
record id, are copies of each other and are read back as often as they were
written; an empty table writes an empty archive, which reads as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import HEAVY_KEYS, col, materialize, slices
from starloom.session import scratch_path

MIN_REVISIT = 1000
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
RECORDS_PER_FILE = 512  # so a file has about 8 MB at most, before compression

# Fixed values of the formats.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CRLF = b"\r\n"

_RECORD = "record_id string, warc_type string, origin string, number int, total long, key string, url string, " \
          "digest string, refers_to string, block binary"


# ------------------------------------------------------------------- framing
def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at:at + size]
        parts += [b"%x" % len(piece), CRLF, piece, CRLF]
    return b"".join([*parts, b"0", CRLF, CRLF])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body (extensions and trailers are passed
    over). Raises ValueError on broken framing."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            raise ValueError("no chunk size")
        digits = body[at:end].partition(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", digits):
            raise ValueError("bad chunk size")
        n = int(digits, 16)
        at = end + 2
        if n == 0:
            return b"".join(out)
        if body[at + n:at + n + 2] != CRLF:
            raise ValueError("chunk is cut short")
        out.append(body[at:at + n])
        at += n + 2


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record up to its block; the two line ends after it are the file's line separator."""
    head = [VERSION, *(f"{k}: {re.sub(r'[\x00-\x1f]', ' ', str(v))}".encode() for k, v in fields if v is not None),
            b"Content-Length: %d" % len(block), b"", block]
    return CRLF.join(head)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record of a file."""
    at = 0
    while at < len(data):
        if data[at:at + len(VERSION)] != VERSION:
            raise ValueError(f"no record at byte {at}")
        end = data.index(CRLF + CRLF, at)
        lines = data[at:end].decode("utf-8").split("\r\n")[1:]
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        begin, n = end + 4, int(head["content-length"])
        if data[begin + n:begin + n + 4] != CRLF + CRLF:
            raise ValueError(f"record at byte {at} is cut short")
        yield head, data[begin:begin + n]
        at = begin + n + 4


def gunzip(data: bytes) -> bytes:
    """All members of a gzip file."""
    out = []
    while data:
        z = zlib.decompressobj(31)
        out += [z.decompress(data), z.flush()]
        data = z.unused_data
    return b"".join(out)


# ------------------------------------------------------------------- writing
def _records_of(segment: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            out = []
            for key, url, payload, sha, refers, revisit in zip(*(b.column(i).to_pylist() for i in range(6))):
                payload = payload or b""
                digest = "sha1:" + base64.b32encode(bytes.fromhex(sha)).decode()
                own = f"<urn:page:{key}:{sha}>"
                fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own), ("WARC-Date", date),
                          ("WARC-Target-URI", url), ("X-Page-Key", key), ("WARC-Payload-Digest", digest),
                          ("Content-Type", "application/http;msgtype=response")]
                if revisit:
                    out.append(record([*fields, ("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Key", refers),
                                       ("WARC-Refers-To", f"<urn:page:{refers}:{sha}>")], HTTP_HEAD + CRLF))
                    continue
                block = HTTP_HEAD + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
                if len(block) <= segment:
                    out.append(record(fields, block))
                    continue
                out.append(record([*fields, ("WARC-Segment-Number", 1)], block[:segment]))
                for k, at in enumerate(range(segment, len(block), segment), 2):
                    last = at + segment >= len(block)
                    out.append(record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{key}:{sha}:{k}>"),
                                       ("WARC-Date", date), ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k),
                                       ("WARC-Segment-Total-Length", len(block) if last else None)],
                                      block[at:at + segment]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
    return run


def write_warc(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
               min_revisit: int = MIN_REVISIT, segment_bytes: int = SEGMENT_BYTES,
               date: str = "2024-01-01T00:00:00Z") -> None:
    """Write the archive folder ``path`` (``*.txt.gz`` files of records)."""
    raw = F.coalesce(col(pages, payload).cast("binary"), F.lit(b""))
    rows = pages.select(col(pages, key).alias("key"), col(pages, url).cast("string").alias("url"), raw.alias("payload")) \
        .withColumn("sha", F.sha1("payload"))
    large = F.octet_length("payload") >= min_revisit
    # One row per payload that occurs again; counted before the shuffle.
    again = materialize(rows.where(large).groupBy("sha").agg(F.max("key").alias("top"), F.count("*").alias("n")).where("n > 1"), "again")
    # Payloads with a HEAVY_KEYS-th of all repeats (so at most HEAVY_KEYS) meet their rows by
    # broadcast; those rows go on under keys of their own, which match nothing.
    heavy = F.col("n") > max((again.agg(F.sum("n")).first()[0] or 0) / HEAVY_KEYS, 100)
    met = rows.join(F.broadcast(again.where(heavy).select("sha", F.col("top").alias("heavy_top"), F.lit(True).alias("heavy"))), "sha", "left")
    spread = F.concat("sha", F.lit("-"), (F.monotonically_increasing_id() % HEAVY_KEYS).cast("string"))
    met = met.withColumn("place", F.when(F.col("heavy"), spread).otherwise(F.col("sha")))
    rest = again.where(~heavy).select(F.col("sha").alias("place"), F.col("top").alias("rest_top"), F.lit(True).alias("rest"))
    joined = met.join(rest, "place", "left").select(
        *rows.columns, F.coalesce("heavy_top", "rest_top").alias("top"), F.coalesce("heavy", "rest").alias("again"))
    revisit = F.coalesce("again", F.lit(False)) & large & ~F.col("key").eqNullSafe(F.col("top"))
    text = joined.select(F.col("key").cast("string"), "url", "payload", "sha", F.col("top").cast("string"),
                         revisit.alias("revisit"))
    (text.mapInArrow(_records_of(segment_bytes, date), "record binary")
     .select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


# ------------------------------------------------------------------- reading
def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}.get(t, pa.string()))
                        for n, t in (x.split() for x in _RECORD.split(", "))])
    num = lambda v: None if v is None else int(v)
    for b in slices(batches, 1):
        rows = []
        for h, block in records(gunzip(b.column("content")[0].as_py())):
            digest = h.get("warc-payload-digest")
            rows.append({
                "record_id": h["warc-record-id"], "warc_type": h["warc-type"], "origin": h.get("warc-segment-origin-id"),
                "number": num(h.get("warc-segment-number")), "total": num(h.get("warc-segment-total-length")),
                "key": h.get("x-page-key"), "url": h.get("warc-target-uri"), "refers_to": h.get("x-refers-to-key"),
                "digest": digest and base64.b32decode(digest.removeprefix("sha1:")).hex(), "block": block})
        for at in range(0, len(rows), 64):
            yield pa.RecordBatch.from_pylist(rows[at:at + 64], schema)


def reassemble(found: DataFrame) -> DataFrame:
    """Segmented records as whole ones. Segments of one number and origin are
    copies of each other and count as one; ``copies`` says how many there
    were (the least of any number). ``status`` is null for whole records."""
    part = found.withColumn("origin", F.coalesce("origin", "record_id"))
    head = [F.max(c).alias(c) for c in ("warc_type", "key", "url", "digest", "refers_to")]
    once = part.groupBy("origin", "number").agg(
        F.first("block").alias("block"), F.max("total").alias("total"), F.count("*").alias("copies"),
        *[F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("warc_type", "key", "url", "digest", "refers_to")])
    whole = once.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"), F.max("total").alias("total"),
        F.min("copies").alias("copies"), *head)
    block = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    n = F.size("parts")
    gap = (F.get("parts", n - 1)["number"] != n) | (F.get("parts", F.lit(0))["number"] != 1) | F.col("total").isNull()
    return whole.select(
        F.col("origin").alias("record_id"), "warc_type", "key", "url", "digest", "refers_to", block.alias("block"), "copies",
        F.when(gap, "segments").when(F.octet_length(block) != F.col("total"), "length").alias("status"))


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, 64):
        payloads, status = [], []
        for block, kind, digest, wrong in zip(*(b.column(c).to_pylist() for c in ("block", "warc_type", "digest", "status"))):
            payload = None
            if wrong is None and kind == "response":
                head, _, body = block.partition(CRLF + CRLF)
                try:
                    payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                    wrong = None if hashlib.sha1(payload).hexdigest() == digest else "digest"
                except ValueError:
                    wrong = "framing"
            payloads.append(payload)
            status.append(wrong or "ok")
        keep = [b.column(c) for c in ("key", "url", "warc_type", "digest", "refers_to", "copies")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(payloads, pa.binary()), pa.array(status, pa.string())],
                                         ["key", "url", "record_type", "digest", "refers_to", "copies", "payload", "status"])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(key, url, record_type, digest, refers_to, payload, status) of every
    response and revisit below ``path``; keys as text, a revisit's payload
    is null."""
    found = spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parse, _RECORD)
    segment = F.col("number").isNotNull()
    same = ["record_id", "warc_type", "key", "url", "digest", "refers_to", "block"]
    whole = found.where(~segment).select(*same, F.lit(1).cast("long").alias("copies"), F.lit(None).cast("string").alias("status"))
    joined = reassemble(found.where(segment))
    out = whole.unionByName(joined).mapInArrow(
        _decode, "key string, url string, record_type string, digest string, refers_to string, copies long, "
                 "payload binary, status string")
    return out.select(F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy_"), "*").drop("copy_", "copies")


def resolve(narrow: DataFrame) -> DataFrame:
    """(key, record_type, digest, refers_to, payload_bytes, status) rows with a
    revisit's length taken from the response that it refers to. ``narrow``
    must be a written table."""
    is_revisit = F.col("record_type") == "revisit"
    refer = lambda c: F.struct(F.col(c).alias("k"), F.col("digest").alias("d"))
    named = (narrow.where(~is_revisit).groupBy(refer("key").alias("ref"))
             .agg(F.max("payload_bytes").alias("known")))
    revisits = narrow.where(is_revisit).withColumn("ref", refer("refers_to")).join(named, "ref", "left").select(
        "key", "record_type", "digest", "refers_to", F.col("known").alias("payload_bytes"),
        F.when(F.col("known").isNull(), "reference").otherwise(F.col("status")).alias("status"))
    return narrow.where(~is_revisit).select(*revisits.columns).unionByName(revisits)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write ``pages`` below the shared folder, read the archive back and
    resolve its revisits; keys have their own type again."""
    spark = pages.sparkSession
    path = scratch_path(spark, f"llm-{spark.sparkContext.applicationId}/warc")
    write_warc(pages, path, key, url, payload)
    back = read_warc(spark, path)
    narrow = materialize(back.select("key", "record_type", "digest", "refers_to",
                                     F.octet_length("payload").cast("long").alias("payload_bytes"), "status"), "records")
    kind = pages.select(col(pages, key)).schema[0].dataType
    return resolve(narrow).withColumns({c: F.col(c).cast(kind) for c in ("key", "refers_to")})
