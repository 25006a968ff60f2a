"""WARC archives of web pages: written with segments and chunked framing, read back, reassembled.

Writing: a page is an HTTP response whose body is framed in chunks. A block above the segment
size is cut into a first record and continuation records, which carry the origin's id, their
number and, in the last, the whole length. Pages whose payload equals that of a smaller page_id
are revisit records without a payload. Archives are plain text-sink files with CR LF CR LF as
the line separator, which is how a WARC record ends, so they go to any store that Spark writes;
they are gzipped as a whole.

Reading: files are parsed by content length. Continuation records are grouped by origin id,
ordered by segment number, and their numbers and total length verified; the joined block is
decoded from its chunks. Revisits take length and digest from the record that they refer to.
A file holds at most ``FILE_RECORDS`` records of at most one segment each; a group holds the
segments of one page.

Nulls and edge cases: a null page is an empty payload; payloads below ``LEAST_SHARED`` bytes are
never shared; identical rows (same id and payload) are responses each; rows with a null page_id
revisit a page with an id, and are responses where there is none; an empty table gives no rows.
A record with a missing segment, a wrong length or broken framing raises.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import BATCH_ROWS, ship
from tarmac.operators.ranges import stored
from tarmac.session import scratch_path

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
FILE_RECORDS = 1_000
LEAST_SHARED = 100
EPOCH = "2024-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
END = b"\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    out = []
    for at in range(0, len(payload), size):
        part = payload[at : at + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked framing, with extensions and trailers allowed."""
    out, at = [], 0
    while True:
        stop = body.index(b"\r\n", at)
        size = int(body[at:stop].split(b";")[0].strip(), 16)
        at = stop + 2
        if size == 0:
            break
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its length says")
        out.append(body[at : at + size])
        at += size + 2
    if body[at : at + 2] != b"\r\n" and not body.endswith(b"\r\n\r\n"):
        raise ValueError("the last chunk is not closed")
    return b"".join(out)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def records(page_id: int | None, url: str | None, html: bytes, refers_to: int | None, segment: int = SEGMENT_BYTES) -> list[bytes]:
    """The records of one page, without the line ends that close each."""
    digest = hashlib.sha256(html).hexdigest()
    uid = f"<urn:page:{page_id}:{digest[:32]}>"
    target = re.sub(r"\s", "%20", url or "")
    base = [("WARC-Record-ID", uid), ("WARC-Date", EPOCH), ("WARC-Target-URI", target), ("X-Page-ID", str(page_id))]
    base.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    kind = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        other = ("WARC-Refers-To", f"<urn:page:{refers_to}:{digest[:32]}>")
        profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        return [_record([("WARC-Type", "revisit"), *base, other, profile, kind], HTTP_HEAD)]
    block = HTTP_HEAD + chunked(html)
    parts = [block[at : at + segment] for at in range(0, len(block), segment)]
    if len(parts) == 1:
        return [_record([("WARC-Type", "response"), *base, kind], block)]
    out = [_record([("WARC-Type", "response"), *base, kind, ("WARC-Segment-Number", "1")], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{uid[:-1]}:{n}>"), ("WARC-Date", EPOCH)]
        own += [("WARC-Segment-Origin-ID", uid), ("WARC-Segment-Number", str(n))]
        if n == len(parts):
            own.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(_record(own, part))
    return out


def revisits(pages: DataFrame) -> DataFrame:
    """page_id, digest and refers_to of the pages whose payload a smaller page_id has."""
    body = F.coalesce(F.col("html"), F.lit(""))
    narrow = pages.select("page_id", F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("bytes"))
    narrow = stored(narrow.filter(F.col("bytes") >= LEAST_SHARED).select("page_id", "digest"))
    shared = narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    shared = shared.filter("n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to")
    again = narrow.distinct().join(shared, "digest").filter("page_id IS NULL OR page_id <> refers_to")
    return stored(again)


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT_BYTES, file_records: int = FILE_RECORDS) -> None:
    """Write the records of every page (page_id, url, html) to WARC files under ``path``."""
    ship(pages.sparkSession)
    body = F.coalesce(F.col("html"), F.lit(""))
    source = pages.select(F.col("page_id").cast("long"), "url", body.alias("html"))
    again = revisits(source).withColumnRenamed("page_id", "of")
    same = source["page_id"].eqNullSafe(again["of"]) & (F.sha2(source["html"], 256) == again["digest"])
    told = source.join(again, same, "left").select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                rows = batch.slice(at, BATCH_ROWS).to_pylist()
                out = [r for x in rows for r in records(x["page_id"], x["url"], x["html"].encode(), x["refers_to"], segment)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    lines = told.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.option("compression", "gzip").option("lineSep", END.decode()).option("maxRecordsPerFile", file_records).text(path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of every record of a file, gzipped or not."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while at < len(content):
        stop = content.index(END, at)
        lines = content[at:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record does not start where it should")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        at = stop + 4 + int(fields["content-length"])
        if content[at : at + 4] != END:
            raise ValueError("a record does not end where its length says")
        yield fields, content[stop + 4 : at]
        at += 4


def _payload(block: bytes) -> bytes:
    head, _, body = block.partition(END)
    framed = any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.split(b"\r\n"))
    return unchunked(body) if framed else body


PARSED = "kind string, page_id bigint, record_id string, refers string, origin string, segment int, total bigint, payload_bytes bigint, payload_digest string, block binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record. Whole responses are decoded at once and keep no block."""
    ship(spark)
    names = [f.split()[0] for f in PARSED.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def row(fields: dict[str, str], block: bytes) -> tuple:
        number, total, page = fields.get("warc-segment-number"), fields.get("warc-segment-total-length"), fields.get("x-page-id", "None")
        segment, whole = int(number) if number else None, number is None and fields["warc-type"] == "response"
        payload = _payload(block) if whole else None
        digest = hashlib.sha256(payload).hexdigest() if whole else None
        if whole and fields["warc-payload-digest"] != f"sha256:{digest}":
            raise ValueError("a payload differs from its digest")
        origin = fields.get("warc-segment-origin-id", fields["warc-record-id"] if segment else None)
        return (
            fields["warc-type"], None if page == "None" else int(page), fields["warc-record-id"], fields.get("warc-refers-to"), origin, segment,
            int(total) if total else None, len(payload) if whole else None, digest, block if segment else None,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                content = batch.column(0)[at].as_py()
                rows = [row(*r) for r in parse(content)]
                columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, PARSED)


def reassemble(segments: DataFrame) -> DataFrame:
    """record_id, page_id, payload_bytes and payload_digest of every segmented response.

    Repeated rows of a page repeat its segments: equal ones are counted first, so that a
    group holds a page's segments once however often the page occurs.
    """
    once = segments.groupBy("origin", "segment", "total", "page_id", "block").agg(F.count("*").alias("copies"))
    part = F.struct("segment", "copies", "total", "block")
    joined = once.groupBy("origin").agg(F.max("page_id").alias("page_id"), F.max("copies").alias("copies"), F.collect_list(part).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at in range(batch.num_rows):
                origin, page, copies, parts = (batch.column(i)[at].as_py() for i in range(4))
                parts.sort(key=lambda p: p["segment"])
                if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or any(p["copies"] != copies for p in parts):
                    raise ValueError(f"segments of {origin} are missing or differ")
                block = b"".join(p["block"] for p in parts)
                if parts[-1]["total"] != len(block):
                    raise ValueError(f"segments of {origin} do not add up to its total length")
                payload = _payload(block)
                out += [(origin, page, len(payload), hashlib.sha256(payload).hexdigest())] * copies
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["record_id", "page_id", "payload_bytes", "payload_digest"])

    return joined.select("origin", "page_id", "copies", "parts").mapInArrow(run, "record_id string, page_id bigint, payload_bytes bigint, payload_digest string")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every archived page."""
    found = read_records(spark, path)
    columns = ["record_id", "page_id", "payload_bytes", "payload_digest"]
    parsed = stored(found)
    whole = parsed.filter("kind = 'response' AND segment IS NULL").select(*columns)
    responses = stored(whole.union(reassemble(parsed.filter("segment IS NOT NULL"))))
    again = parsed.filter("kind = 'revisit'").select("page_id", "refers")
    named = again.select("refers").distinct()
    origins = responses.join(named, responses["record_id"] == named["refers"], "left_semi").groupBy("record_id").agg(
        F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest")
    )
    told = again.join(origins, again["refers"] == origins["record_id"])
    told = told.select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to")
    own = responses.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return own.unionByName(told)


def archive(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared scratch folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)
