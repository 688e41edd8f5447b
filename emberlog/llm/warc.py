"""WARC archives: one gzip member per record, revisits in place of repeated payloads, and a reader that salvages.

Archives are written by Spark's text writer, a record's member per row: any shared storage will do, and a lost task is done
again as a whole. Rows are separated by an empty gzip member, so a file is a plain sequence of members.

The reader checks each member (its checksum) and each record (version line, header lines, length, block end, payload digest).
After a failed check it looks for the next place where a member or a version line begins that passes all checks, goes
on from there, and reports the bytes in between as a gap. Inside a member it does the same with the bytes that could be inflated:
a record that fails costs the records around it nothing. If the member's own checksum fails, records are taken over only if their
payload digest holds and something else in the member fails, so that the damage has a place; otherwise the member is a gap.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from emberlog.llm.text import table
from emberlog.session import fresh_dir

#: Payload bytes of one archive.
ARCHIVE_BYTES = 16 << 20

#: Equal payloads from this size on become revisits.
LEAST_REVISIT = 100

LEVEL = 4
_STEP = 1 << 14
_EMPTY = gzip.compress(b"", mtime=0)
_BEGIN = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    payload: bytes

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]


@dataclass(frozen=True)
class Lost:
    """Bytes of a member, counted in what it inflates to, that hold no record that passes."""

    first: int
    past: int


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page} {digest}')}>"


def record_bytes(kind: str, page: int | None, url: str | None, payload: bytes, digest: str, length: int, refers: int | None) -> bytes:
    """One record. A response has an HTTP head and the payload; a revisit has the head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page, digest)}",
        "WARC-Date: 2024-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {length}", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if page is not None:
        lines.append(f"Page-ID: {page}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers, digest)}", f"Refers-To-Page-ID: {refers}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[Record, int] | None:
    """The record that begins at ``at`` and where it ends, or None if any check fails."""
    if not re.match(rb"WARC/1\.[01]\r\n", data[at:at + 10]):
        return None
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    headers = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isdecimal() or "warc-type" not in headers:
        return None
    start, past = end + 4, end + 4 + int(length)
    if data[past:past + 4] != b"\r\n\r\n":
        return None
    block = data[start:past]
    if headers.get("content-type", "").startswith("application/http"):
        head = block.find(b"\r\n\r\n")
        if head < 0:
            return None
        block = block[head + 4:]
    digest = headers.get("warc-payload-digest", "")
    if headers["warc-type"] == "response" and digest.startswith("sha256:") and hashlib.sha256(block).hexdigest() != digest[7:]:
        return None
    return Record(headers, block), past + 4


def inflated(data: bytes, at: int) -> tuple[bytes, int, bool]:
    """What the gzip member at ``at`` holds, as far as it can be inflated, where it ends, and whether it is whole and its checksum holds."""
    unzip, parts, end = zlib.decompressobj(31), [], at
    while not unzip.eof and end < len(data):  # in steps, as what follows the member would be copied
        before = unzip.copy()
        try:
            parts.append(unzip.decompress(data[end:end + _STEP]))
        except zlib.error:
            # The step again byte by byte, to have what comes before the bad one.
            for place in range(end, min(end + _STEP, len(data))):
                try:
                    parts.append(before.decompress(data[place:place + 1]))
                except zlib.error:
                    return b"".join(parts), place + 1, False
            return b"".join(parts), end, False
        end = min(end + _STEP, len(data))
    return b"".join(parts), end - len(unzip.unused_data), unzip.eof


def proven(record: Record) -> bool:
    """Whether the record carries a digest of its payload, which :func:`parse` has then checked."""
    return record.kind == "response" and record.headers.get("warc-payload-digest", "").startswith("sha256:")


def members(data: bytes, at: int) -> tuple[list[Record | Lost], int | None] | None:
    """The records of the gzip member or plain record that begins at ``at``, the bytes lost between them, and where it ends.

    The end of a member whose checksum fails is not known: it may have swallowed what follows. None if nothing that begins there passes.
    """
    if data[at:at + 2] != b"\x1f\x8b":
        found = parse(data, at)
        return found and ([found[0]], found[1])
    inner, past, whole = inflated(data, at)
    if not whole and not inner:
        return None
    inside, place, lost = [], 0, None
    while place < len(inner):
        found = parse(inner, place)
        if found is not None and (whole or proven(found[0])):
            if lost is not None:
                inside.append(Lost(lost, place))
                lost = None
            inside.append(found[0])
            place = found[1]
            continue
        lost = place if lost is None else lost
        following = _LINE.search(inner, place + 1)
        place = following.start() if following else len(inner)
    if lost is not None:
        inside.append(Lost(lost, len(inner)))
    damaged = any(isinstance(x, Lost) for x in inside)
    if damaged and all(isinstance(x, Lost) for x in inside) or not whole and not damaged:
        return None
    return inside, past if whole else None


def salvage(data: bytes) -> Iterator[tuple[int, int, list[Record | Lost] | None]]:
    """(first byte, past, records) of everything that passes its checks, and (first byte, past, None) of the gaps between.

    Records of a damaged member come with the bytes lost between them.
    """
    at, gap, hurt = 0, None, None  # ``hurt``: a damaged member that lasts until something passes again
    while at < len(data):
        found = members(data, at)
        if found is not None:
            if gap is not None:
                yield gap, at, hurt
                gap = hurt = None
            if found[1] is not None:
                yield at, found[1], found[0]
                at = found[1]
                continue
            hurt = found[0]
        gap = at if gap is None else gap
        following = _BEGIN.search(data, at + 1)
        at = following.start() if following else len(data)
    if gap is not None:
        yield gap, len(data), hurt


def whole_number(text: str | None) -> int | None:
    """A header's number, or None if it is not one that fits 64 bits: archives from elsewhere may say anything."""
    if text is None or not re.fullmatch(r"-?[0-9]{1,19}", text):
        return None
    value = int(text)
    return value if -(1 << 63) <= value < 1 << 63 else None


def roles(pages: DataFrame) -> DataFrame:
    """(page_id, digest, length, refers) by row: ``refers`` is the smallest page_id with the same payload, if that is another."""
    payload = F.coalesce("html", F.lit(""))
    facts = pages.select("page_id", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("length"))
    first = facts.where(F.col("length") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"))
    other = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return facts.join(first, "digest", "left").select("page_id", "digest", "length", F.when(other, F.col("first")).alias("refers")).distinct()


def write_archives(pages: DataFrame, path: str) -> None:
    """``pages`` (page_id, url, html; other columns are ignored) as archives in the folder ``path``.

    Null html is an empty payload, a null url has no target line. Rows that repeat the smallest page_id of a payload are
    responses each; a null page_id is larger than all others and refers to none if its payload has no other page.
    """
    payload = F.coalesce("html", F.lit(""))
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("key")
    mine = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"), key)
    role = roles(pages).select(key, "digest", "length", "refers")
    size = pages.agg(F.coalesce(F.sum(F.octet_length("html")), F.lit(0))).first()[0]
    archives = max(1, -(-size // ARCHIVE_BYTES))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, url, html, digest, length, refers in zip(*[c.to_pylist() for c in batch.columns]):
                kind = "response" if refers is None else "revisit"
                out.append(gzip.compress(record_bytes(kind, page, url, (html or "").encode(), digest, length, refers), LEVEL, mtime=0))
            yield pa.record_batch([pa.array(out, pa.binary())], ["member"])

    # Payloads move once: the join keeps the partitions, and each becomes an archive.
    met = mine.repartition(archives, "key", "digest").join(role.repartition(archives, "key", "digest"), ["key", "digest"])
    dealt = met.select("page_id", "url", F.when(F.col("refers").isNull(), F.col("html")).alias("html"), "digest", "length", "refers")
    made = dealt.mapInArrow(run, "member binary")
    rows = made.select(F.col("member").cast("string").alias("value"))  # bytes stay as they are
    rows.write.option("lineSep", _EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """What the archives in a folder hold, gaps included: (archive, first, past, kind, page_id, url, payload_bytes,
    payload_digest, refers_to, payload, inner_first, inner_past). ``kind`` is gap for quarantined bytes; those inside a member, counted
    in what it inflates to, are in ``inner_first`` and ``inner_past``. Length and digest of a response are those of the payload
    read; of a revisit, those its header tells. A header that is missing, or no number where one belongs, is null."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows = []
                for first, past, records in salvage(data):
                    if records is None:
                        rows.append((name, first, past, "gap", *[None] * 8))
                    for r in records or ():
                        if isinstance(r, Lost):
                            rows.append((name, first, past, "gap", *[None] * 6, r.first, r.past))
                            continue
                        h, whole = r.headers, r.kind == "response"
                        told = h.get("warc-payload-digest", "")
                        rows.append((name, first, past, r.kind, whole_number(h.get("page-id")), h.get("warc-target-uri"),
                                     len(r.payload) if whole else whole_number(h.get("warc-payload-length")),
                                     hashlib.sha256(r.payload).hexdigest() if whole else told[7:] if told.startswith("sha256:") else None,
                                     whole_number(h.get("refers-to-page-id")), r.payload if whole else None, None, None))
                    if len(rows) >= 512:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    names = ["archive", "first", "past", "kind", "page_id", "url", "payload_bytes", "payload_digest", "refers_to", "payload", "inner_first", "inner_past"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    schema = ("archive string, first bigint, past bigint, kind string, page_id bigint, url string, payload_bytes bigint, "
              "payload_digest string, refers_to bigint, payload binary, inner_first bigint, inner_past bigint")
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    found = read_archives(spark, path).where("kind <> 'gap'")
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.col("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY html)
SELECT page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.html = f.html
"""
