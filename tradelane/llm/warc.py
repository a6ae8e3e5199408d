r"""WARC archives: segmented, chunked, deduplicated writing and exact reassembly.

Writing: pages with equal payloads of at least ``MIN_REVISIT`` bytes share the response of
the smallest page id, the others are revisit records with its record id. A response's block is
an HTTP head and the payload in chunked transfer framing. Blocks longer than ``SEGMENT``
bytes are split into continuation records. Each task writes one gzip archive of the rows it
reads, so archives are as large as input splits; ``\r\n\r\n`` comes between records, as the
format asks, from Spark's text writer (raw bytes). Only pages whose payload may occur again are
shuffled.

Reading: archives are parsed by their length headers. Whole records are decoded in place;
segments are grouped by origin id, put in order of their number, checked against the total
length, and decoded. Revisits get length and digest of the record they refer to, which
page id and digest name together.

Null html is an empty payload. All rows of the smallest page id are responses, also when the
row repeats. Null page ids come after all others.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelane.llm.common import arrow_map, bitmap, in_bitmap, read
from tradelane.session import new_path

MIN_REVISIT = 100
SEGMENT = 4096
CHUNK = 1000
NONE = 2**63 - 1
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(data: bytes, size: int = CHUNK) -> bytes:
    parts = [data[i : i + size] for i in range(0, len(data), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunk(data: bytes) -> bytes:
    """Payload of a chunked body; raises if the framing is broken."""
    out, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        size = int(data[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        if data[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("chunk is not closed")
        out.append(data[end + 2 : end + 2 + size])
        at = end + 4 + size


def record_id(number: int) -> str:
    return f"<{uuid.UUID(int=number % 2**128).urn}>"


def record(kind: str, rid: str, block: bytes, **headers) -> bytes:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", "WARC-Date: 2024-01-01T00:00:00Z"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items() if v is not None]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.1", *lines]).encode() + b"\r\n\r\n" + block


def response_id(page: int, digest: str) -> str:
    """The record id of a page's response: the page's id, then the head of its digest."""
    return record_id((page % 2**64 << 64) + int(digest[:16], 16))


def response(page: int, url: str | None, payload: bytes, copy: int, segment: int = SEGMENT) -> list[bytes]:
    """One record, or the first and its continuations; ``copy`` tells repeated rows apart."""
    block = HTTP + chunked(payload)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    digest = hashlib.sha256(payload).hexdigest()
    rid = response_id(page, digest)
    first = {"WARC_Target_URI": clean_uri(url), "WARC_Payload_Digest": f"sha256:{digest}", "X_Page_ID": page, "X_Copy": copy}
    if len(parts) == 1:
        return [record("response", rid, block, **first)]
    out = [record("response", rid, parts[0], WARC_Segment_Number=1, **first)]
    for i, part in enumerate(parts[1:], start=2):
        own = record_id(uuid.uuid5(uuid.NAMESPACE_OID, f"{rid} {i}").int)
        total = len(block) if i == len(parts) else None
        out.append(
            record("continuation", own, part, WARC_Segment_Origin_ID=rid, WARC_Segment_Number=i,
                   WARC_Segment_Total_Length=total, X_Copy=copy)
        )
    return out


def clean_uri(url: str | None) -> str | None:
    return url.replace("\r", "%0D").replace("\n", "%0A") if url else None


def records(data: bytes):
    """``(headers, block)`` of an archive's records, by their lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n")
        if lines[0] != b"WARC/1.1":
            raise ValueError("not at a record")
        headers = dict(x.decode().split(": ", 1) for x in lines[1:])
        size = int(headers["Content-Length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError("record is cut short")
        yield headers, block
        at = end + 8 + size


def decode(block: bytes) -> bytes:
    head = block.index(b"\r\n\r\n")
    return dechunk(block[head + 4 :])


def write(pages: DataFrame, path: str) -> None:
    """Archives of ``page_id, url, html`` under ``path``."""
    rows = pages.select(
        F.coalesce("page_id", F.lit(NONE)).cast("bigint").alias("page"), "url",
        F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload"))
    firsts = (
        rows.where(F.col("size") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("c"))
        .where("c > 1")
        .select("digest", "first")
    )
    # payloads that occur once are written where they are read; a fixed-size bitmap tells most of them
    plan = rows.select("page", "url", "payload", F.xxhash64("digest").alias("mark"), F.monotonically_increasing_id().alias("row"))
    shared = pages.sparkSession.sparkContext.broadcast(bitmap(firsts.select(F.xxhash64("digest").alias("mark")), "mark"))

    def several(wanted: bool):
        def make():
            def step(batch):
                hit = in_bitmap(shared.value, batch.column(3).to_numpy(zero_copy_only=False))
                return batch.filter(pa.array(hit == wanted))

            return step

        return arrow_map(plan, make, "page bigint, url string, payload binary, mark bigint, row bigint")

    plan = (
        several(True)
        .withColumn("digest", F.sha2("payload", 256))
        .join(firsts, "digest", "left")
        .select("page", "url", "payload", "first", "row")
        .unionByName(several(False).select("page", "url", "payload", F.lit(None).cast("bigint").alias("first"), "row"))
    )

    def make():
        def step(batch):
            out = []
            for page, url, payload, first, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if first is None or first == page:
                    out += response(page, url, payload, row)
                else:
                    digest = hashlib.sha256(payload).hexdigest()
                    own = record_id(uuid.uuid5(uuid.NAMESPACE_OID, f"{page} {row}").int)
                    out.append(
                        record("revisit", own, HTTP, WARC_Target_URI=clean_uri(url), X_Page_ID=page,
                               WARC_Payload_Digest=f"sha256:{digest}", WARC_Refers_To=response_id(first, digest),
                               WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
                    )
            return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

        return step

    made = arrow_map(plan, make, "record binary")
    (
        made.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .text(path)
    )


READ = "kind string, page bigint, digest string, refers bigint, size bigint, origin string, number int, total bigint, block binary"


def load(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of archives."""
    files = spark.read.format("binaryFile").load(path).select("content")
    shape = pa.schema(
        [("kind", pa.string()), ("page", pa.int64()), ("digest", pa.string()), ("refers", pa.int64()), ("size", pa.int64()),
         ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())]
    )

    def parse(batches):
        for batch in batches:
            for packed in batch.column(0):
                out = []
                for h, block in records(gzip.decompress(packed.as_py())):
                    kind, number = h["WARC-Type"], h.get("WARC-Segment-Number")
                    page = int(h["X-Page-ID"]) if "X-Page-ID" in h else None
                    digest = h.get("WARC-Payload-Digest", "").removeprefix("sha256:")
                    refers = h.get("WARC-Refers-To")
                    row = {"kind": kind, "page": page, "digest": digest}
                    if refers:
                        row["refers"] = signed(uuid.UUID(refers[1:-1]).int >> 64)
                    if number:
                        row |= {"origin": h.get("WARC-Segment-Origin-ID", h["WARC-Record-ID"]) + h["X-Copy"], "number": int(number), "block": block}
                        row["total"] = int(h["WARC-Segment-Total-Length"]) if "WARC-Segment-Total-Length" in h else None
                    elif kind == "response":
                        row["size"] = checked(decode(block), digest)
                    out.append(row)
                    if len(out) == 1000:
                        yield pa.RecordBatch.from_pylist(out, shape)
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist(out, shape)

    found = files.mapInArrow(parse, READ)
    whole = found.where("number is null").select("kind", "page", "digest", "refers", "size")
    grouped = (
        found.where("number is not null")
        .groupBy("origin")
        .agg(
            F.max("page").alias("page"), F.max("digest").alias("digest"), F.max("total").alias("total"),
            F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
        )
        .select("page", "digest", "total", "parts")
    )

    def make():
        def step(batch):
            sizes = []
            for digest, total, parts in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if [p["number"] for p in parts] != list(range(1, len(parts) + 1)):
                    raise ValueError("a segment is missing")
                block = b"".join(p["block"] for p in parts)
                if len(block) != total:
                    raise ValueError("segments do not add up to the total length")
                sizes.append(checked(decode(block), digest))
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], ["page", "digest", "size"])

        return step

    rebuilt = arrow_map(grouped, make, "page bigint, digest string, size bigint").select(
        F.lit("response").alias("kind"), "page", "digest", F.lit(None).cast("bigint").alias("refers"), "size"
    )
    both = whole.unionByName(rebuilt)
    # a page may hold several payloads; record ids are of page and payload, and so is this
    sizes = both.where("kind = 'response'").groupBy(F.col("page").alias("refers"), "digest").agg(F.max("size").alias("size"))
    kinds = both.where("kind = 'revisit'").drop("size").join(sizes, ["refers", "digest"], "left")
    out = both.where("kind = 'response'").unionByName(kinds.select("kind", "page", "digest", "refers", "size"))
    return out.select(
        F.nullif("page", F.lit(NONE)).alias("page_id"), F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), F.nullif("refers", F.lit(NONE)).alias("refers_to"),
    )


def signed(n: int) -> int:
    return n - 2**64 if n >= 2**63 else n


def checked(payload: bytes, digest: str) -> int:
    if hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("payload does not match its digest")
    return len(payload)


def op8_warc_segments(spark, sf_dir) -> DataFrame:
    path = new_path(spark, "warc")
    write(read(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return load(spark, path)


SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> first THEN first END AS refers_to
FROM f
"""
