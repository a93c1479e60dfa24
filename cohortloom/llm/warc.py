"""Web archives: pages written as WARC records in segments, and put together again.

Writing: a payload of at least ``min_revisit`` bytes that several pages share
is stored once, by the page with the smallest id; the others become revisit
records. A response holds an HTTP message in chunked framing. A block longer
than ``segment_bytes`` is cut: the first segment is the response record, the
rest are continuation records, the last of which states the total length.

Reading: records come from the archive files as streams. Segments are grouped by
their origin's identifier, ordered by number, checked (numbers 1..n without a
gap, lengths adding up to the stated total) and only then decoded.

Defined results: a null payload is empty; a null id is kept as null; equal rows
give equal records, and an origin each of whose segments occurs m times is m
records. Pages that repeat the smallest id are all responses. Only the named
columns are read, so others may have any name. An incomplete or broken record
is returned with its ``status`` and without payload, not dropped; so is one whose header holds
no number where it should (``bad header``), and reading goes on at the next line that begins a record.
"""

from __future__ import annotations

import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import open_stream
from cohortloom.operators import sizing
from cohortloom.operators.joins import salted_join
from cohortloom.operators.staging import staged

_END = "\r\n\r\n"
_LINE = 1 << 16  # bytes of a line outside a header that are looked at together
_NUMBERS = ("content-length", "x-page-id", "x-refers-to-page-id", "warc-segment-number", "warc-segment-total-length")
_ROWS = 2048  # rows per batch given back to Spark
_SALTS = 16  # tasks over which the copies of one payload are spread

_RECORD = "record_id string, page_id long, record_type string, refers_to long, status string, payload_bytes long, payload_digest string, payload binary"
_SCANNED = _RECORD + ", segment int, total long, block binary"


def mark_revisits(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """page_id, url, payload, digest and, for a revisit, ``refers_to``."""
    keyed = pages.withColumn("digest", F.sha2("payload", 256))
    shared = (
        keyed.where(F.octet_length("payload") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    shared = staged(shared, "shared-payloads")
    if sizing.broadcastable({"shared": shared}):
        marked = keyed.join(F.broadcast(shared), "digest", "left")
    else:
        copies = keyed.join(shared, "digest", "left_semi")
        marked = keyed.join(shared, "digest", "left_anti").withColumn(
            "refers_to", F.lit(None).cast("long")
        )
        marked = marked.unionByName(
            salted_join(copies, shared, ["digest"], _SALTS, ["page_id", "url"])
        )
    first = F.col("page_id").eqNullSafe(F.col("refers_to"))
    return marked.withColumn("refers_to", F.when(~first, F.col("refers_to")))


def write_archive(
    pages: DataFrame,
    path: str,
    *,
    segment_bytes: int = 16 << 10,
    chunk_bytes: int = 8 << 10,
    min_revisit: int = 100,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """``pages`` (page_id, url, html) as compressed archive files below ``path``."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    marked = mark_revisits(
        pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")), min_revisit
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records: list[bytes] = []
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                records.extend(_records(*row, segment_bytes, chunk_bytes, date))
                if len(records) >= _ROWS:
                    yield pa.record_batch([pa.array(records, pa.binary())], ["record"])
                    records = []
            yield pa.record_batch([pa.array(records, pa.binary())], ["record"])

    names = ["page_id", "url", "payload", "digest", "refers_to"]
    # A record ends with two line ends, which is what the text writer puts after each row.
    marked.select(names).mapInArrow(build, "record binary").select(
        F.col("record").cast("string")
    ).write.option("lineSep", _END).option("compression", "gzip").text(path)


def _record_id(page_id: int | None, digest: str) -> str:
    h = hashlib.blake2b(f"{page_id}|{digest}".encode(), digest_size=16).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def _records(
    page_id, url, payload: bytes, digest: str, refers_to, segment_bytes: int, chunk_bytes: int, date
) -> list[bytes]:
    uri = "".join(c if c.isprintable() and c != " " else "%20" for c in url or "about:blank")
    common = [f"WARC-Date: {date}", f"WARC-Target-URI: {uri}"]
    own = ["" if page_id is None else f"X-Page-ID: {page_id}", f"WARC-Payload-Digest: sha256:{digest}"]
    name = _record_id(page_id, digest)
    if refers_to is not None:
        block = f"HTTP/1.1 200 OK\r\nContent-Length: {len(payload)}{_END}".encode()
        back = [f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
        profile = "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [_record("revisit", name, [*common, *own, *back, profile], block)]

    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked{_END}"
    framed = [head.encode()]
    for i in range(0, len(payload), chunk_bytes):
        chunk = payload[i : i + chunk_bytes]
        framed += [b"%x\r\n" % len(chunk), chunk, b"\r\n"]
    block = b"".join([*framed, b"0\r\n\r\n"])
    if len(block) <= segment_bytes:
        return [_record("response", name, [*common, *own], block)]
    cuts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = [_record("response", name, [*common, *own, "WARC-Segment-Number: 1"], cuts[0])]
    for k, cut in enumerate(cuts[1:], 2):
        fields = [*common, f"WARC-Segment-Origin-ID: {name}", f"WARC-Segment-Number: {k}"]
        if k == len(cuts):
            fields.append(f"WARC-Segment-Total-Length: {len(block)}")
        out.append(_record("continuation", _record_id(page_id, f"{digest}/{k}"), fields, cut))
    return out


def _record(kind: str, name: str, fields: list[str], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", *filter(None, fields)]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]) + _END
    return head.encode() + block


def read_archive(spark: SparkSession, path: str, *, payloads: bool = False) -> DataFrame:
    """One row per record that stands for a page: its id, type, the page it refers
    to, ``status`` (ok, or what is wrong), and length and digest of the full payload.

    ``payloads`` adds the payload of responses; a revisit has none of its own.
    """
    files = spark.read.format("binaryFile").load(path).select("path")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                yield from _packed(_scanned(name, payloads), schema)

    schema = _arrow_schema(segmented=True)
    scanned = staged(files.mapInArrow(scan, _SCANNED), "warc-records")
    record = [c.split()[0] for c in _RECORD.split(", ")]
    whole = scanned.where(F.col("segment").isNull()).select(record)
    return whole.unionByName(_reassembled(scanned.where("segment is not null"), payloads))


def _reassembled(segments: DataFrame, payloads: bool) -> DataFrame:
    """Records from segments that lie anywhere in the archive."""
    numbers = segments.groupBy("record_id", "segment").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max("page_id").alias("page_id"),
        F.max("record_type").alias("record_type"),
        F.max("payload_digest").alias("digest"),
        F.max("total").alias("total"),
        F.max("block").alias("block"),
    )
    origins = numbers.groupBy("record_id").agg(
        F.max("page_id").alias("page_id"),
        F.max("record_type").alias("record_type"),
        F.max("digest").alias("digest"),
        F.max("total").alias("total"),
        F.max("segment").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.min("copies").alias("copies"),
        F.sum(F.octet_length("block")).alias("bytes"),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("blocks"),
    )

    def status() -> Column:
        gap = (F.col("n") != F.col("last")) | F.col("total").isNull()
        return (
            F.when(gap | F.col("record_type").isNull(), "missing segment")
            .when(F.col("bytes") != F.col("total"), "wrong length")
            .otherwise("ok")
        )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _packed(
                (
                    _decoded(r["record_id"], r["page_id"], r["record_type"], None, r["digest"], block, payloads)
                    if r["status"] == "ok"
                    else _broken(r["record_id"], r["page_id"], r["record_type"], r["status"])
                    for r in batch.to_pylist()
                    for block in [b"".join(b["block"] for b in r["blocks"])]
                    for _ in range(r["copies"])
                ),
                schema,
            )

    schema = _arrow_schema(segmented=False)
    return origins.withColumn("status", status()).mapInArrow(decode, _RECORD)


def _scanned(path: str, payloads: bool) -> Iterator[dict]:
    """The records of one file; whole ones decoded, segments as they are."""
    stream = io.BufferedReader(open_stream(path, "gzip" if path.endswith(".gz") else None), 1 << 20)
    while line := stream.readline(_LINE):
        if not line.startswith(b"WARC/"):
            continue  # blank lines, and what is left of a record whose length was wrong
        fields: dict[str, str] = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode("utf-8", "replace").partition(":")
            fields[key.strip().lower()] = value.strip()
        kind, name = fields.get("warc-type"), fields.get("warc-record-id")
        number = {key: _number(fields.get(key)) for key in _NUMBERS if key in fields}
        page = number.get("x-page-id")
        counted = [v for key, v in number.items() if not key.startswith("x-") and v is not None]
        if None in number.values() or "content-length" not in number or min(counted) < 0 or number.get("warc-segment-number", 0) >> 31:
            # The next record is looked for behind this one's block, or from here on if that has no length.
            stream.read(max(0, number.get("content-length") or 0))
            yield _broken(name, page, kind, "bad header")
            continue
        length = number["content-length"]
        block = stream.read(length)
        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
        if "warc-segment-number" in fields:
            yield {
                "record_id": fields.get("warc-segment-origin-id", name), "page_id": page,
                "record_type": kind if kind != "continuation" else None, "payload_digest": digest or None,
                "segment": number["warc-segment-number"], "total": number.get("warc-segment-total-length"), "block": block,
            }
        elif len(block) < length:
            yield _broken(name, page, kind, "wrong length")
        elif kind in ("response", "revisit"):
            yield _decoded(name, page, kind, number.get("x-refers-to-page-id"), digest, block, payloads)


def _number(text: str | None) -> int | None:
    """A header's decimal number; None if it is none, or too large for its column."""
    found = re.fullmatch(r"-?[0-9]{1,19}", text or "")
    value = int(found[0]) if found else None
    return value if value is not None and -(1 << 63) <= value < 1 << 63 else None


def _broken(name, page_id, kind, status: str) -> dict:
    return {"record_id": name, "page_id": page_id, "record_type": kind, "status": status}


def _decoded(name, page_id, kind, refers_to, digest: str, block: bytes, payloads: bool) -> dict:
    """A record's row from its whole block."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = dict(
        (k.strip().lower(), v.strip())
        for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])
    )
    if kind == "revisit":
        if (stated := _number(fields.get("content-length", "0"))) is None:
            return _broken(name, page_id, kind, "bad header")
        return {
            "record_id": name, "page_id": page_id, "record_type": kind, "refers_to": refers_to, "status": "ok",
            "payload_bytes": stated, "payload_digest": digest,
        }
    if fields.get("transfer-encoding", "").lower() == "chunked":
        body = unchunked(body)
        if body is None:
            return _broken(name, page_id, kind, "broken chunk")
    own = hashlib.sha256(body).hexdigest()
    if digest and own != digest:
        return _broken(name, page_id, kind, "wrong digest")
    return {
        "record_id": name, "page_id": page_id, "record_type": kind, "status": "ok",
        "payload_bytes": len(body), "payload_digest": own, "payload": body if payloads else None,
    }


def unchunked(framed: bytes) -> bytes | None:
    """The body in chunked framing; None if a size, a line end or the last chunk is missing."""
    parts, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(framed[at:end].partition(b";")[0], 16)
        except ValueError:
            return None
        if size <= 0:
            return b"".join(parts) if size == 0 else None
        at = end + 2 + size
        if framed[at : at + 2] != b"\r\n":
            return None
        parts.append(framed[end + 2 : at])
        at += 2


def _packed(rows: Iterator[dict], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row.get("block") or b"") + len(row.get("payload") or b"")
        if len(held) >= _ROWS or size >= most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow_schema(segmented: bool) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    columns = (_SCANNED if segmented else _RECORD).split(", ")
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in columns])
