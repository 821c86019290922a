"""WARC archives: writing them, and putting segmented records together again.

Spark's text writer makes the files: a row is a record, and the line separator
is the two line ends that close a record. Reading goes by the lengths that the
records state, so payloads may hold anything. A record in segments is grouped
with its continuations by the identifier of its first, ordered by segment number,
held against the total length that the last one states, and its body is taken
out of the chunked transfer coding.

A null text is an empty payload. Of rows with equal payloads all with the least
``page_id`` are responses (so repeated rows of one page are), the others revisit
it; null ids come last, and among null ids alone all are responses. Files hold at
most ``records`` records of at most ``segment`` bytes, so one fits in memory.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.llm.common import kept

VERSION = b"WARC/1.1"
CLOSE = b"\r\n\r\n"
CHUNK = 8192
#: Every record gets this date: archives of equal pages are equal.
DATE = "2000-01-01T00:00:00Z"


class DamagedRecord(ValueError):
    """A record that does not hold what it states."""


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records as bytes -----------------------------------------------------


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """``payload`` in HTTP's chunked transfer coding."""
    out = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        out += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise DamagedRecord("a chunk has no size line")
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            raise DamagedRecord("a chunk's size is no number") from None
        if not size:
            return b"".join(out)
        at = end + 2
        if body[at + size : at + size + 2] != b"\r\n":
            raise DamagedRecord("a chunk is cut short")
        out.append(body[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the two line ends that close it."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers)]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + CLOSE + block


def page_uri(page_id: str | None) -> str:
    return f"page:{'' if page_id is None else page_id}"


def record_urn(uri: str, digest: str, number: int = 1) -> str:
    """The identifier of a page's record: equal for equal rows only."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{uri}#{digest}#{number}')}>"


def page_records(
    uri: str, record_id: str, payload: bytes, digest: str, refers_to: str | None, segment: int
) -> list[bytes]:
    """The records of one page: a revisit, or a response and its continuations."""
    common = [("WARC-Target-URI", uri), ("WARC-Date", DATE)]
    named = [*common, ("WARC-Payload-Digest", f"sha1:{digest}")]
    http = [("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers = [
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", record_id),
            ("WARC-Refers-To", refers_to),
            ("WARC-Profile", profile),
        ]
        return [record([*headers, *named, *http], b"HTTP/1.1 200 OK\r\n\r\n")]
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    )
    pieces = [block[at : at + segment] for at in range(0, len(block), segment)]
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", record_id), *named, *http]
    if len(pieces) == 1:
        return [record(headers, block)]
    out = [record([*headers, ("WARC-Segment-Number", "1")], pieces[0])]
    for n, piece in enumerate(pieces[1:], 2):
        headers = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", record_urn(uri, digest, n)),
            ("WARC-Segment-Origin-ID", record_id),
            ("WARC-Segment-Number", str(n)),
            *common,
        ]
        if n == len(pieces):
            headers.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record(headers, piece))
    return out


def parse_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record in a file."""
    at = 0
    while at < len(raw):
        end = raw.find(CLOSE, at)
        if end < 0:
            raise DamagedRecord("a record's headers do not end")
        lines = raw[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise DamagedRecord("a record begins without its version")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode()] = value.strip().decode()
        start = end + len(CLOSE)
        at = start + int(headers["content-length"])
        if raw[at : at + len(CLOSE)] != CLOSE:
            raise DamagedRecord("a record is not as long as it states")
        yield headers, raw[start:at]
        at += len(CLOSE)


def block_payload(block: bytes) -> bytes:
    """The body of an HTTP message, out of its transfer coding."""
    head, found, body = block.partition(CLOSE)
    if not found:
        raise DamagedRecord("an HTTP message has no end of headers")
    if b"\r\ntransfer-encoding: chunked" in head.lower():
        return unchunked(body)
    return body


def joined_segments(parts: Iterable[tuple[int, int | None, bytes]]) -> bytes:
    """The block of ``(number, total length, piece)`` in order of number."""
    out, total = [], None
    for want, (number, stated, piece) in enumerate(parts, 1):
        if number != want:
            raise DamagedRecord(f"segment {want} is missing")
        out.append(piece)
        total = stated if stated is not None else total
    block = b"".join(out)
    if total != len(block):
        raise DamagedRecord(f"segments have {len(block)} bytes and state {total}")
    return block


# --- tables ---------------------------------------------------------------


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    segment: int = 32_768,
    least_revisit: int = 0,
    records: int = 1_000,
) -> None:
    """Write ``page_id`` and ``html`` of ``pages`` as gzipped WARC files under ``path``.

    Payloads of at least ``least_revisit`` bytes that an earlier page has become
    revisit records. Only digests that occur twice go into the join that finds
    them; Spark broadcasts those if they are few.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        "page_id", payload.alias("payload"), F.sha1(payload).alias("digest")
    ).withColumn("long_enough", F.octet_length("payload") >= least_revisit)
    shared = kept(
        rows.filter("long_enough")
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first_id"),
        "digests",
    )
    joined = rows.join(shared, "digest", "left")
    revisit = F.col("long_enough") & (
        (F.col("page_id") != F.col("first_id"))
        | (F.col("page_id").isNull() & F.col("first_id").isNotNull())
    )
    joined = joined.select(
        F.col("page_id").cast("string").alias("page_id"),
        "payload",
        F.when(revisit, F.col("first_id").cast("string")).alias("refers_to"),
    )

    def written(batches):
        for batch in batches:
            out = []
            columns = (batch[c].to_pylist() for c in ("page_id", "payload", "refers_to"))
            for page_id, payload, refers_to in zip(*columns):
                uri, digest = page_uri(page_id), sha1_base32(payload)
                target = None if refers_to is None else record_urn(page_uri(refers_to), digest)
                out += page_records(
                    uri, record_urn(uri, digest), payload, digest, target, segment
                )
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    (
        joined.mapInArrow(written, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", CLOSE.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records)
        .text(path)
    )


_SEGMENT = (
    "record_id string, uri string, kind string, digest string, refers_to string, "
    "number int, total long, block binary"
)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the archives under ``path``, continuations by origin."""

    def parsed(batches):
        for batch in batches:
            for content in batch["content"]:
                raw = content.as_buffer()
                raw = zlib.decompress(raw, 31) if bytes(raw[:2]) == b"\x1f\x8b" else bytes(raw)
                rows: list[list] = [[] for _ in range(8)]
                size = 0
                for headers, block in parse_records(raw):
                    get = headers.get
                    total = get("warc-segment-total-length")
                    values = (
                        get("warc-segment-origin-id") or get("warc-record-id"),
                        get("warc-target-uri"),
                        get("warc-type"),
                        (get("warc-payload-digest") or "").removeprefix("sha1:") or None,
                        get("warc-refers-to"),
                        int(get("warc-segment-number", 0)),
                        None if total is None else int(total),
                        block,
                    )
                    for c, v in zip(rows, values):
                        c.append(v)
                    size += len(block)
                    if size > 1 << 24:
                        yield _segment_batch(rows)
                        rows, size = [[] for _ in range(8)], 0
                yield _segment_batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parsed, _SEGMENT)


def _segment_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int32(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in _SEGMENT.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(rows, kinds)], names=names
    )


def reassemble(segments: DataFrame) -> DataFrame:
    """Whole records: ``record_id``, ``uri``, ``kind``, ``digest``, ``refers_to``, ``payload``.

    Only records in segments are shuffled, by identifier and sorted by number; a
    task then meets the parts of a record one after the other. A record that
    lacks a part, is not as long as it states or differs from its digest raises.
    """
    schema = (
        "record_id string, uri string, kind string, digest string, refers_to string, "
        "payload binary"
    )
    names = [c.split()[0] for c in schema.split(", ")]

    def emitted(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        kinds = [pa.string()] * 5 + [pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
        )

    def whole(row: dict, block: bytes) -> tuple:
        payload = None
        if row["kind"] != "revisit":
            payload = block_payload(block)
            if row["digest"] != sha1_base32(payload):
                raise DamagedRecord(f"{row['record_id']}: the payload differs from its digest")
        return (*(row[n] for n in names[:5]), payload)

    def single(batches):
        for batch in batches:
            yield emitted([whole(r, r["block"]) for r in batch.to_pylist()])

    def grouped(batches):
        parts: list[dict] = []

        def finished() -> tuple:
            block = joined_segments((r["number"], r["total"], r["block"]) for r in parts)
            return whole(parts[0], block)

        for batch in batches:
            out, size = [], 0
            for r in batch.to_pylist():
                if parts and (parts[0]["record_id"], parts[0]["copy"]) != (
                    r["record_id"],
                    r["copy"],
                ):
                    out.append(finished())
                    size += len(out[-1][-1])
                    parts = []
                parts.append(r)
                if size > 1 << 24:
                    yield emitted(out)
                    out, size = [], 0
            yield emitted(out)
        if parts:
            yield emitted([finished()])

    # Repeated pages have equal records: the n-th of each segment go together.
    same = Window.partitionBy("record_id", "number").orderBy("uri")
    several = (
        segments.filter("number > 0")
        .repartition("record_id")
        .withColumn("copy", F.row_number().over(same))
        .sortWithinPartitions("record_id", "copy", "number")
    )
    return (
        segments.filter("number = 0")
        .mapInArrow(single, schema)
        .unionByName(several.mapInArrow(grouped, schema))
    )
