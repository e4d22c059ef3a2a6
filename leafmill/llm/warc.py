"""WARC archives: writing with revisits and segments, and reassembly on reading.

Each row is a record. Of rows with equal payloads, that of the smallest id is a
response and the others are revisits that refer to it. A response's block is an
HTTP message in chunked transfer framing; blocks above ``SEGMENT`` bytes are
written as a first record and continuation records, which name the first as
their origin, carry segment numbers, and of which the last states the total
length. Archives are gzip files in the shared folder; plain ones are read too.

Reading splits files into records by their stated lengths, groups segments by
origin identifier, orders them by number, verifies that none is missing and
that the total length holds, joins them, and decodes the chunked framing. The
segments of one record are held at a time. As no record exceeds a segment, a
count of records bounds a file's bytes, whatever the payloads.

Cases: a null payload is empty; an empty payload is a record like any other;
rows that repeat an id and a payload are one response and revisits of it; a
null id is written as ``-`` and sorts last; other ids are percent-encoded in
record ids, so that they may hold any characters; line ends and other control
characters in a url are percent-encoded in its header, and stay so when read; a
payload may hold any bytes, record headers among them; extra columns are not
read, whatever their names; an empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import shared_path, written

SEGMENT = 4 << 10  #: bytes of a block above which a record is segmented
CHUNK = 1 << 10  #: bytes of a chunk of the transfer framing
FILE = 16 << 20  #: bytes aimed at for a file
MOST = 1 << 30  #: bytes of a file at most, before it is compressed
DATE = "2020-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes) -> bytes:
    """``payload`` in chunked transfer framing."""
    out = []
    for i in range(0, len(payload), CHUNK):
        part = payload[i : i + CHUNK]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(data: bytes) -> bytes:
    """The payload of chunked transfer framing; extensions and trailers are passed over, anything else raises ValueError."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk without a size line")
        size = int(data[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if at + size + 2 > len(data) or data[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk shorter than its size line says")
        out.append(data[at : at + size])
        at += size + 2


_CONTROL = re.compile(r"[\x00-\x1f\x7f]")


def header_value(value: str) -> str:
    """``value`` on one line."""
    return _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", value)


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record, without the two line ends that follow its block."""
    head = "".join(f"{k}: {header_value(v)}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode("utf-8") + b"\r\n" + block


def response_records(uri: str, target: str | None, payload: bytes, mark: str, segment: int = SEGMENT) -> Iterator[bytes]:
    """A response and its continuations."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    base = [("WARC-Date", DATE), *([("WARC-Target-URI", target)] if target else [])]
    own = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{uri}>"), *base, ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{mark}")]
    if len(block) <= segment:
        yield record(own, block)
        return
    yield record([*own, ("WARC-Segment-Number", "1")], block[:segment])
    for k, at in enumerate(range(segment, len(block), segment), 2):
        last = at + segment >= len(block)
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{uri}:{k}>"), *base, ("WARC-Segment-Origin-ID", f"<{uri}>"), ("WARC-Segment-Number", str(k)), *([("WARC-Segment-Total-Length", str(len(block)))] if last else [])], block[at : at + segment])


def revisit_record(uri: str, target: str | None, refers: str, mark: str) -> bytes:
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    head = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{uri}>"), ("WARC-Date", DATE), *([("WARC-Target-URI", target)] if target else []), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{refers}>"), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{mark}")]
    return record(head, block)


def plain(data: bytes) -> bytes:
    """An archive's bytes without their compression, of one gzip member or many."""
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record of an archive's bytes."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no record at byte {at}")
        head = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in data[at:end].decode("utf-8").split("\r\n")[1:]))
        size = int(head["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) < size:
            raise ValueError(f"record at byte {at} is cut short")
        yield head, block
        at = end + 4 + size


def joined(first: str, parts: list[tuple[int, bytes, int | None]]) -> bytes:
    """Blocks of segments (number, block, total length or None) in order, verified."""
    parts = sorted(parts, key=lambda p: p[0])
    if [p[0] for p in parts] != list(range(1, len(parts) + 1)):
        raise ValueError(f"segments {[p[0] for p in parts]} of {first}")
    block = b"".join(p[1] for p in parts)
    totals = {p[2] for p in parts if p[2] is not None}
    if len(parts) > 1 and totals != {len(block)}:
        raise ValueError(f"total length {totals} of {first}, found {len(block)}")
    return block


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _name(page_id: str | None, mark: str, copy: int = 0) -> str:
    one = "-" if page_id is None else quote(page_id, safe="").replace("-", "%2D")
    return f"urn:page:{one}:{mark}" + f":copy{copy}" * bool(copy)


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", revisit_from: int = 0, segment: int = SEGMENT) -> None:
    """Writes ``pages`` as archives under ``path``. Of equal payloads of at least ``revisit_from`` bytes one is stored.

    Payloads are moved once, after copies have been dropped on the reading side; which rows are revisits is settled on ids, urls and digests.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("body")).withColumn("sha", F.sha1("body"))
    once = F.length("body") >= revisit_from
    light = written(rows.select("id", "url", "sha", F.length("body").alias("bytes"), once.alias("once")), "warc-light")
    mean = light.agg(F.avg("bytes")).first()[0] or 0
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", F.col("url").isNull().alias("no_url"), "url")).alias("lead")
    responses = rows.where(once).groupBy("sha").agg(first, F.any_value("body").alias("body")).select("lead.id", "lead.url", "body")
    plain = rows.where(~once).select("id", "url", "body")
    leads = light.where("once").groupBy("sha").agg(first, F.count("*").alias("n")).where("n > 1").select("sha", "lead")
    again = light.where("once").groupBy("sha", "id", "url").agg(F.count("*").alias("n")).join(leads, "sha")
    again = again.withColumn("n", F.col("n") - F.when(F.col("id").eqNullSafe(F.col("lead.id")) & F.col("url").eqNullSafe(F.col("lead.url")), 1).otherwise(0))
    revisits = again.where("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select(F.col("id").cast("string"), "url", "sha", F.col("lead.id").cast("string").alias("lead"), F.col("copy").cast("int").alias("copy"))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                one, target, body = (b.column(k)[i].as_py() for k in range(3))
                mark = digest(body)
                yield pa.RecordBatch.from_arrays([pa.array(list(response_records(_name(one, mark), target, body, mark, segment)), pa.binary())], names=["value"])

    def refer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for one, target, sha, lead, copy in zip(*(b.column(k).to_pylist() for k in range(5))):
                mark = base64.b32encode(bytes.fromhex(sha)).decode()
                out.append(revisit_record(_name(one, mark, copy), target, _name(lead, mark), mark))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    kept = responses if not revisit_from else responses.unionByName(plain)
    records = kept.withColumn("id", F.col("id").cast("string")).mapInArrow(store, "value binary").unionByName(revisits.mapInArrow(refer, "value binary"))
    # The text writer puts out a string's bytes as they are, and two line ends follow each record.
    per_file = max(1, min(int(FILE // (min(mean, segment) + 700)), MOST // (segment + 4096)))
    records.select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).option("compression", "gzip").text(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """(record_id, record_type, target, refers_to, payload_bytes, payload_digest, payload): responses whole, and revisits, whose payload and size are null.

    Raises where segments are missing, or lengths or digests do not hold.
    """
    fields = [("record_id", pa.string()), ("record_type", pa.string()), ("target", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), *([("payload", pa.binary())] if payload else [])]
    found = pa.schema(fields)
    kind = ", ".join(f"{n} {'long' if t == pa.int64() else t}" for n, t in fields)
    segments = pa.schema([("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("head", pa.string()), ("block", pa.binary())])
    files = spark.read.format("binaryFile").load(path).select("content")

    def row(head: dict, block: bytes | None) -> dict:
        out = {"record_id": head["warc-record-id"], "record_type": head["warc-type"], "target": head.get("warc-target-uri"), "refers_to": head.get("warc-refers-to"), "payload_bytes": None, "payload_digest": head.get("warc-payload-digest", "sha1:").removeprefix("sha1:")}
        if block is not None:
            body = http_payload(block)
            if digest(body) != out["payload_digest"]:
                raise ValueError(f"digest of {out['record_id']}")
            out |= {"payload_bytes": len(body)} | ({"payload": body} if payload else {})
        return out

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for b in batches:
            for content in b.column(0):
                yield plain(content.as_py())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in archives(batches):
            yield pa.RecordBatch.from_pylist([row(h, b if h["warc-type"] == "response" else None) for h, b in records_of(data) if "warc-segment-number" not in h and h["warc-type"] in ("response", "revisit")], schema=found)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in archives(batches):
            yield pa.RecordBatch.from_pylist([{"origin": h.get("warc-segment-origin-id", h["warc-record-id"]), "number": int(h["warc-segment-number"]), "total": int(h["warc-segment-total-length"]) if "warc-segment-total-length" in h else None, "head": json.dumps(h) if "warc-segment-origin-id" not in h else None, "block": b} for h, b in records_of(data) if "warc-segment-number" in h], schema=segments)

    def reassembled(origin: str, held: list[tuple[int, bytes, int | None]], head: str | None) -> pa.RecordBatch:
        block = joined(origin, held)
        if head is None:
            raise ValueError(f"segments of {origin} without a first record")
        return pa.RecordBatch.from_pylist([row(json.loads(head), block)], schema=found)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        origin, held, first = None, [], None
        for b in batches:
            for one, number, total, head, block in (tuple(c[i].as_py() for c in b.columns) for i in range(b.num_rows)):
                if one != origin and held:
                    yield reassembled(origin, held, first)
                    held, first = [], None
                origin, first = one, first or head
                held.append((number, block, total))
        if held:
            yield reassembled(origin, held, first)

    # Segments of an origin meet in one task and follow one another there, so a task holds one record.
    split = files.mapInArrow(parts, "origin string, number int, total long, head string, block binary").repartition("origin").sortWithinPartitions("origin", "number").mapInArrow(gather, kind)
    return files.mapInArrow(whole, kind).unionByName(split)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with a revisit's payload_bytes, and payload if there is one, from the response it refers to."""
    held = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), *([F.col("payload").alias("_payload")] if "payload" in records.columns else []))
    out = records.join(held, "refers_to", "left").withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes"))
    if "payload" in records.columns:
        out = out.withColumn("payload", F.coalesce("payload", "_payload")).drop("_payload")
    return out.drop("_bytes").select(records.columns)


def page_of(column):
    """The id that a record id of ``write_archives`` holds, as a string; null for none."""
    return F.url_decode(F.nullif(F.split_part(column, F.lit(":"), F.lit(3)), F.lit("-")))


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    path = shared_path(pages.sparkSession, "warc")
    write_archives(pages, path, page_id, url, payload)
    found = resolved(written(read_archives(pages.sparkSession, path, payload=False), "warc-read"))
    to = pages.schema[page_id].dataType
    return found.select(page_of(F.col("record_id")).cast(to).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to")).cast(to).alias("refers_to"))
