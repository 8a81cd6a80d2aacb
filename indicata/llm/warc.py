"""WARC archives: pages written as segmented records, read back and put together again.

A payload is sent as an HTTP response with chunked transfer framing. Blocks longer than
``segment`` bytes are cut into a first record and continuations; the last one tells the
total length. Equal payloads of some size are stored once and revisited by the others.
Files hold a bounded number of bounded records, so one file always fits a task.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import scratch_path, staged

CRLF = b"\r\n"
#: Ends a record; the text writer puts it behind every row.
RECORD_END = "\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
HTTP_REVISIT = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

FEW_MB = 4 << 20

#: Of a record; its block is deflated, which makes the shuffle of segments a third.
PART = "page_id long, kind string, record_id string, origin string, number int, total long, digest string, block binary"


def chunked(payload: bytes, chunk: int) -> bytes:
    """Chunked transfer framing: each chunk behind its length in hex, a chunk of none at the end."""
    out = []
    for start in range(0, len(payload), chunk):
        piece = payload[start : start + chunk]
        out += [b"%x\r\n" % len(piece), piece, CRLF]
    return b"".join(out) + b"0\r\n\r\n"


def dechunked(framed: bytes) -> bytes:
    """The payload under chunked framing; extensions are skipped, trailers ignored, broken framing is an error."""
    out, at = [], 0
    while True:
        end = framed.find(CRLF, at)
        if end < 0:
            raise ValueError("chunk length missing")
        size = int(framed[at:end].split(b";", 1)[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if framed[at + size : at + size + 2] != CRLF:
            raise ValueError("chunk shorter than its length")
        out.append(framed[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response, its transfer framing decoded."""
    head, found, body = block.partition(CRLF + CRLF)
    if not found:
        raise ValueError("HTTP head without end")
    return dechunked(body) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked\b", head) else body


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {_one_line(v)}" for k, v in fields if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode("utf-8") + CRLF + CRLF + block


def _one_line(value: object) -> str:
    return re.sub(r"[\r\n]+", " ", str(value))


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", smallest: int = 1000, segment: int = 65536, chunk: int = 16384, records: int = 512) -> None:
    """Write a record per page (and its continuations) as gzipped files of at most ``records`` records.

    Of pages with equal payloads of at least ``smallest`` bytes the one with the largest id is the response; pages
    that share that id and payload are responses as well, pages of a group without any id too. A null html is an
    empty payload, a null url is left out, a null id gets no id field.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    slots = 32
    large = rows.where(F.octet_length("payload") >= smallest).groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    spread = large.select(F.col("digest").alias("d"), "first", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("s"))
    slot = F.pmod(F.xxhash64("page_id", "url"), F.lit(slots)).cast("int")
    marked = rows.join(spread, (F.col("digest") == F.col("d")) & (slot == F.col("s")), "left").select("page_id", "url", "payload", "digest", "first")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "first")]
            records = (r for k in range(batch.num_rows) for r in _page_records(*(c[k].as_py() for c in columns), segment, chunk))
            for made in _gathered(records, len):
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])

    written = marked.mapInArrow(batches, "record binary").select(F.col("record").cast("string").alias("value"))
    written.write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", records).text(path)


def _gathered(items: Iterator, size) -> Iterator[list]:
    """Items in lists of a few megabytes, or of one item that is larger."""
    now, held = [], 0
    for item in items:
        now.append(item)
        held += size(item)
        if held >= FEW_MB:
            yield now
            now, held = [], 0
    if now:
        yield now


def _page_records(page_id, url, payload, digest, first, segment: int, chunk: int) -> Iterator[bytes]:
    record_id = f"<urn:uuid:{uuid.uuid4()}>"
    revisit = first is not None and page_id != first
    common = [("WARC-Record-ID", record_id), ("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Target-URI", url), ("Page-ID", page_id), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record([("WARC-Type", "revisit"), *common, ("WARC-Profile", profile), ("Content-Type", "application/http;msgtype=response")], HTTP_REVISIT)
        return
    block = HTTP_HEAD + chunked(payload, chunk)
    pieces = [block[k : k + segment] for k in range(0, len(block), segment)]
    numbered = [("WARC-Segment-Number", 1)] if len(pieces) > 1 else []
    yield _record([("WARC-Type", "response"), *common, *numbered, ("Content-Type", "application/http;msgtype=response")], pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        total = [("WARC-Segment-Total-Length", len(block))] if number == len(pieces) else []
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Target-URI", url), ("WARC-Segment-Origin-ID", record_id), ("WARC-Segment-Number", number), *total], piece)


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record in an uncompressed archive."""
    at = 0
    while True:
        while content[at : at + 2] == CRLF:
            at += 2
        if at >= len(content):
            return
        end = content.find(CRLF + CRLF, at)
        if end < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        lines = content[at:end].decode("utf-8").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = end + 4
        at = start + int(fields["content-length"])
        if at > len(content):
            raise ValueError("record cut short")
        yield fields, content[start:at]


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``: response, continuation and revisit parts."""
    import gzip

    def number(fields: dict[str, str], name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [p.split(" ")[0] for p in PART.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary()]
        for batch in source:
            for k in range(batch.num_rows):
                content = batch.column("content")[k].as_py()
                content = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                made = []
                for f, block in records_of(content):
                    own = f["warc-record-id"]
                    digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    made.append((number(f, "page-id"), f["warc-type"], own, f.get("warc-segment-origin-id", own), number(f, "warc-segment-number") or 1, number(f, "warc-segment-total-length"), digest, zlib.compress(block, 1)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made) if made else [()] * len(kinds), kinds)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(batches, PART)


def read_responses(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """``page_id, payload_bytes, payload_digest`` (and ``payload``) of every response, put together from its segments.

    Continuations are grouped by the record they continue and ordered by number; missing or repeated numbers, a
    wrong total length and a payload that does not match its digest are errors.
    """
    segments = F.sort_array(F.collect_list(F.struct("number", "block")))
    whole = (
        read_parts(spark, path)
        .where("kind != 'revisit'")
        .groupBy("origin")
        .agg(F.max("page_id").alias("page_id"), F.max("digest").alias("digest"), F.max("total").alias("total"), segments.alias("segments"))
    )
    names = ["page_id", "payload_bytes", "payload_digest", "payload"][: 3 + with_payload]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def assembled(batch: pa.RecordBatch) -> Iterator[tuple]:
        for k in range(batch.num_rows):
            row = {n: batch.column(n)[k].as_py() for n in ("page_id", "digest", "total", "segments", "origin")}
            payload = http_payload(_joined(row["segments"], row["total"], row["origin"]))
            digest = hashlib.sha1(payload).hexdigest()
            if row["digest"] not in (None, digest):
                raise ValueError(f"payload of {row['origin']} does not match its digest")
            yield row["page_id"], len(payload), digest, payload if with_payload else None

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for made in _gathered(assembled(batch), lambda r: len(r[3] or b"") + 100):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in list(zip(zip(*made), kinds))[: len(names)]], names)

    return whole.mapInArrow(batches, "page_id long, payload_bytes long, payload_digest string" + ", payload binary" * with_payload)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of every page, from the archives alone.

    A revisit has the length and the id of the response with its digest; one without a response is an error.
    """
    responses = staged(read_responses(spark, path, with_payload=False), "responses")
    kept = responses.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes"))
    revisits = read_parts(spark, path).where("kind = 'revisit'").select("page_id", "digest")
    resolved = revisits.join(kept, F.col("digest") == F.col("payload_digest"), "left")
    found = F.coalesce("payload_bytes", F.raise_error(F.lit("a revisit has no response")).cast("long"))
    return responses.select("*", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).union(resolved.select("page_id", found, "digest", F.lit("revisit"), "refers_to"))


def _joined(segments: list[dict], total: int | None, origin: str) -> bytes:
    if [s["number"] for s in segments] != list(range(1, len(segments) + 1)):
        raise ValueError(f"segments of {origin} are missing or repeated")
    block = b"".join(zlib.decompress(s["block"]) for s in segments)
    if (total is None) != (len(segments) == 1) or total not in (None, len(block)):
        raise ValueError(f"segments of {origin} do not have the total length")
    return block


def archived(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the pages as archives (below the shared folder unless told otherwise) and read their index back.

    One row for each page, repeated ones and those without id included; a null html is an empty payload, a null url is left out
    of the record. No pages, no records. Columns other than the three are not written.
    """
    target = path or scratch_path(pages.sparkSession, "warc")
    write_archive(pages, target, **options)
    return read_index(pages.sparkSession, target)
