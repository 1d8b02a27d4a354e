"""WARC archives: segmented records written and read with Spark's text source.

A page is an HTTP response in chunked transfer framing. A response longer than a segment is
cut: the first record has WARC-Segment-Number 1, continuation records name it as their
WARC-Segment-Origin-ID and the last one states WARC-Segment-Total-Length. Pages whose
payload equals that of an earlier page are revisit records.

The text source writes one file per task with its own commit, so a lost executor leaves
no half archive behind, on any store that Spark can write. A record ends with CR LF CR LF, and
the reader cuts files at "CR LF CR LF WARC/1.", which is followed by 0 or 1 and CR LF. Where a block holds
that very sequence, Content-Length tells that the record goes on and the pieces are put together.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, hot_join, hot_keys, modest_batches

VERSION = b"WARC/1.1\r\n"
#: Between records of version 1.0 or 1.1, whose last digit stays with the record.
BETWEEN = "\r\n\r\nWARC/1."
STARTS = (b"0\r\n", b"1\r\n")
ID = "urn:page:"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(body: bytes, size: int) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(c := body[i : i + size]), c) for i in range(0, len(body), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(framed: bytes) -> bytes:
    """Body of a chunked message, extensions and trailers skipped; ValueError if it is cut off."""
    out, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        n = int(framed[at:end].split(b";")[0], 16)
        at = end + 2
        if n == 0:
            return b"".join(out)
        if len(framed) < at + n + 2 or framed[at + n : at + n + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        out.append(framed[at : at + n])
        at += n + 2


def _record(headers: dict[str, object], block: bytes) -> bytes:
    """Without the last line feed, which the writer of lines adds."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None)
    return VERSION + lines.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r"


def record_id(page, digest: str) -> str:
    """Names a page and its payload, so a revisit can name the response it refers to."""
    return f"<{ID}{'' if page is None else page}:{digest}>"


def page_records(page, url, payload: bytes, digest: str, refers, segment: int, chunk: int) -> list[bytes]:
    """The records of one page."""
    rid = record_id(page, digest)
    uri = None if url is None else "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in str(url))
    common = {"WARC-Date": "1970-01-01T00:00:00Z", "WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http;msgtype=response"}
    if refers is not None:
        head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        return [_record({"WARC-Type": "revisit", "WARC-Record-ID": rid, "WARC-Refers-To": record_id(refers, digest), "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", **common}, head)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk)
    if len(block) <= segment:
        return [_record({"WARC-Type": "response", "WARC-Record-ID": rid, **common}, block)]
    cuts = range(0, len(block), segment)
    made = []
    for n, at in enumerate(cuts, 1):
        last = {"WARC-Segment-Total-Length": len(block)} if n == len(cuts) else {}
        if n == 1:
            kind = {"WARC-Type": "response", "WARC-Record-ID": rid, **common, "WARC-Segment-Number": 1}
        else:
            kind = {"WARC-Type": "continuation", "WARC-Record-ID": f"{rid[:-1]}:{n}>", "WARC-Segment-Origin-ID": rid, "WARC-Segment-Number": n, **last, "WARC-Date": "1970-01-01T00:00:00Z"}
        made.append(_record(kind, block[at : at + segment]))
    return made


def mark_revisits(pages: DataFrame, *, key: str = "page_id", payload: Column | None = None, min_bytes: int = 0, max_broadcast: int = 100_000, hot: int = 1000) -> DataFrame:
    """``pages`` with ``refers_to``: of the rows with equal payloads of at least ``min_bytes``
    bytes all but that with the smallest key get that key, the others null.

    Null ``html`` is an empty payload. Rows of equal payload and the same smallest key (repeated
    rows) are all first. A row with a null key refers to the smallest key if there is one. A
    column ``refers_to`` is replaced, others pass through; an empty table gives an empty
    result. Payloads of any length are hashed whole; those of over ``hot`` rows are joined in
    parts where there are too many for a broadcast.
    """
    body = F.coalesce(F.col("html"), F.lit("")) if payload is None else payload
    sha = F.sha1(body.cast("binary"))
    long_enough = F.octet_length(body) >= min_bytes
    firsts = pages.where(long_enough).groupBy(sha.alias("_mr_sha")).agg(F.min(key).alias("_mr_first"), F.count("*").alias("_mr_n")).where("_mr_n > 1 and _mr_first is not null")
    firsts = checkpoint(firsts)
    marked = pages.drop("refers_to").withColumn("_mr_sha", F.when(long_enough, sha))
    found = firsts.drop("_mr_n")
    if firsts.count() <= max_broadcast:
        joined = marked.join(F.broadcast(found), "_mr_sha", "left")
    else:
        joined = hot_join(marked, found, ["_mr_sha"], hot_keys(firsts, ["_mr_sha"], "_mr_n", least=hot), "left")
    again = F.when(F.col(key).isNull() | (F.col(key) != F.col("_mr_first")), F.col("_mr_first"))
    return joined.withColumn("refers_to", again).drop("_mr_sha", "_mr_first")


def write_archives(pages: DataFrame, path: str, *, segment: int = 16 << 10, chunk: int = 4 << 10, compression: str = "gzip") -> None:
    """Write ``page_id, url, html, refers_to`` as WARC files under ``path``, one per task.

    A page's record id names the page and its payload digest; rows that repeat both have one
    id. Null ``html`` is an empty payload, a null ``url`` writes no target URI, a null
    ``page_id`` an id without a number. Pages of any length are written whole, in segments.
    Other columns are not written. An empty table gives an empty archive.
    """

    modest_batches(pages.sparkSession)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, size = [], 0
            for page, has_page, url, html, refers, has_refers in batch.itertuples(index=False):
                rows += page_records(page if has_page else None, url, html, payload_digest(html), refers if has_refers else None, segment, chunk)
                size += len(html)
                if size > 8 << 20:
                    yield pd.DataFrame({"value": rows})
                    rows, size = [], 0
            yield pd.DataFrame({"value": rows})

    def number(name: str) -> list[Column]:
        """Never null, so that it stays a whole number on its way through pandas."""
        c = F.col(name).cast("long")
        return [F.coalesce(c, F.lit(0)).alias(name), c.isNotNull().alias(f"has_{name}")]

    narrow = pages.select(*number("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("html"), *number("refers_to"))
    narrow.mapInPandas(build, "value binary").select(F.col("value").cast("string").alias("value")).write.option("compression", compression).option("lineSep", "\n").text(path)


RECORD = "origin string, number int, total long, warc_type string, digest string, refers string, uri string, block binary, problem string"


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split("\r\n") if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _whole_number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() and len(text) < 19 else None


def _records(pieces: Iterator[tuple[str, bytes]]) -> Iterator[tuple[dict[str, str], bytes, str | None]]:
    """Headers, block and what is wrong with each record, from what lies between separators,
    file by file in order."""
    at, held = None, None

    def parse(raw: bytes):
        head, _, rest = (raw[3:] if raw.startswith(STARTS) else raw).partition(b"\r\n\r\n")
        h = _headers(head)
        return h, rest, _whole_number(h.get("content-length"))

    def finish(raw: bytes):
        h, rest, n = parse(raw)
        if n is None:
            return h, rest, "no content length"
        if len(rest) < n:
            return h, rest, "record is cut off"
        beyond = rest[n:]
        return h, rest[:n], f"{len(beyond)} bytes beyond its length" if beyond.strip(b"\r\n") else None

    sep = BETWEEN.encode()
    for file, piece in pieces:
        if file != at:
            if held is not None:
                yield finish(held)
            at, held = file, piece.removeprefix(b"WARC/1.")
        else:
            h, rest, n = parse(held)
            if n is not None and len(rest) < n or not piece.startswith(STARTS):
                held += sep + piece
                continue
            yield finish(held)
            held = piece
    if held is not None:
        yield finish(held)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record. gzip files are not split, so each file is read in order by one task;
    a task holds one record at a time.

    ``problem`` says what is wrong with a record (cut off, without a length, or with bytes beyond its
    length that begin no record of version 1.0 or 1.1), else null: a
    damaged file gives the records that it has. A record whose length is too large takes in
    what follows, to the end of its file.
    """
    modest_batches(spark)
    lines = spark.read.option("lineSep", BETWEEN).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = ((f, bytes(p)) for b in batches for f, p in zip(b["file"], b["piece"], strict=True))
        rows, size = [], 0

        def made():
            columns = ["origin", "number", "total", "warc_type", "digest", "refers", "uri", "block", "problem"]
            return pd.DataFrame(rows, columns=columns).astype({"number": "Int32", "total": "Int64"})

        for h, block, problem in _records(pieces):
            rid = h.get("warc-segment-origin-id") or h.get("warc-record-id")
            number = _whole_number((h.get("warc-segment-number") or "")[:9])
            rows.append((rid, number, _whole_number(h.get("warc-segment-total-length")), h.get("warc-type"), h.get("warc-payload-digest"), h.get("warc-refers-to"), h.get("warc-target-uri"), block, problem))
            size += len(block)
            if size > 8 << 20:
                yield made()
                rows, size = [], 0
        yield made()

    return lines.mapInPandas(run, RECORD)


PAGE = "page_id long, uri string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, problem string"


def _page_number(rid: str | None) -> int | None:
    body = (rid or "").strip("<>").removeprefix(ID).split(":")[0]
    return int(body) if body.lstrip("-").isdigit() else None


def _page(kind, digest, refers, uri, origin, block: bytes, problem: str | None):
    head, _, body = block.partition(b"\r\n\r\n")
    http = _headers(head)
    declared = (digest or "").removeprefix("sha1:")
    if kind == "revisit":
        return _page_number(origin), uri, None, _whole_number(http.get("content-length")), declared, kind, _page_number(refers), problem
    if problem is None:
        try:
            body = dechunked(body) if http.get("transfer-encoding", "").lower() == "chunked" else body
            if payload_digest(body) != declared:
                problem = "digest differs"
        except ValueError as e:
            problem = str(e)
    return _page_number(origin), uri, body, len(body), payload_digest(body), kind, None, problem


def _copies(parts: list) -> list[list]:
    """Parts of one origin in order of their numbers, dealt to as many records as there are
    if rows repeat a page: each number must then be there as often, with equal blocks."""
    by: dict[int, list] = {}
    for r in parts:
        by.setdefault(r.number, []).append(r)
    n = len(next(iter(by.values())))
    if n > 1 and all(len(x) == n and all(r.block == x[0].block for r in x) for x in by.values()):
        return [list(x) for x in zip(*by.values(), strict=True)]
    return [parts]


def reassemble(records: DataFrame) -> DataFrame:
    """One row per page: ``page_id, uri, payload, payload_bytes, payload_digest, record_type,
    refers_to, problem``.

    Continuation records are grouped by origin and put in order by segment number; the
    total length, the order and the digest are verified, and the chunked framing is taken
    off. ``problem`` says what was wrong, else null: damaged pages are returned, not
    dropped. Records are read once and written to the shared folder; of these only segmented
    ones shuffle. Repeated pages come back as often as they were written. Pages of any length
    are held whole, one at a time. An empty table gives an empty result.
    """
    columns = ["page_id", "uri", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"]
    records = checkpoint(records)

    def frame(rows):
        return pd.DataFrame(rows, columns=columns).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield frame([_page(r.warc_type, r.digest, r.refers, r.uri, r.origin, bytes(r.block), r.problem) for r in b.itertuples(index=False)])

    def whole(parts: list) -> tuple:
        first, problem = parts[0], next((r.problem for r in parts if r.problem), None)
        if problem is None and [r.number for r in parts] != list(range(1, len(parts) + 1)):
            problem = "segments missing or repeated"
        block = b"".join(bytes(r.block) for r in parts)
        if problem is None and (pd.isna(parts[-1].total) or parts[-1].total != len(block)):
            problem = "total length differs"
        return _page(first.warc_type, first.digest, first.refers, first.uri, first.origin, block, problem)

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list = []
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                if parts and parts[0].origin != r.origin:
                    rows += map(whole, _copies(parts))
                    parts = []
                parts.append(r)
            yield frame(rows)
        if parts:
            yield frame([whole(x) for x in _copies(parts)])

    alone = records.where("number is null").mapInPandas(single, PAGE)
    cut = records.where("number is not null").repartition("origin").sortWithinPartitions("origin", "number").mapInPandas(joined, PAGE)
    return alone.unionByName(cut)
