import gzip
import hashlib
import random

import pytest

from millrace.llm import warc
from millrace.llm.common import scratch

SCHEMA = "page_id long, url string, html string"


def test_chunks_round_trip_and_cuts_are_seen():
    r = random.Random(1)
    for n in (0, 1, 7, 8, 9, 100):
        body = bytes(r.randrange(256) for _ in range(n))
        framed = warc.chunked(body, 8)
        assert warc.dechunked(framed) == body
        for cut in range(len(framed) - 2):
            with pytest.raises(ValueError):
                warc.dechunked(framed[:cut])
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"


def pages():
    evil = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    return [
        (5, "http://a/ b", "same"), (3, "http://a", "same"), (9, None, "same"), (1, "u", None), (2, "u", ""), (4, "u\r\nX: y", "é" * 9000), (6, "u", evil), (7, "u", evil * 300), (8, "u", "\n\r\n0\r\n\r\n"),
        (11, "u", "twice"), (11, "u", "twice"), (12, "u", "long" * 900), (12, "v", "long" * 900), (None, "u", "nobody"), (-3, "u", "negative"),
    ]


@pytest.mark.parametrize("compression", ["gzip", "none"])
@pytest.mark.parametrize("limit", [100_000, 0])
def test_archives_round_trip(spark, compression, limit):
    path = scratch(spark, "warc")
    marked = warc.mark_revisits(spark.createDataFrame(pages(), SCHEMA), max_broadcast=limit, hot=2)
    warc.write_archives(marked.coalesce(2), path, segment=700, chunk=64, compression=compression)
    records = warc.read_records(spark, path)
    got = {(r.page_id, r.uri): r for r in warc.reassemble(records).collect()}
    assert sum(1 for _ in warc.reassemble(records).collect()) == len(pages())
    for page, url, html in pages():
        body = (html or "").encode()
        r = next(x for (k, _), x in got.items() if k == page)
        assert (r.payload_bytes, r.payload_digest, r.problem) == (len(body), warc.payload_digest(body), None)
        assert r.record_type == ("revisit" if page in (5, 9, 2) else "response")
        assert r.refers_to == {5: 3, 9: 3, 2: 1}.get(page)
        if r.record_type == "response":
            assert bytes(r.payload) == body
    assert records.where("warc_type = 'continuation'").count() > 20


def test_files_are_plain_warc(spark, tmp_path):
    warc.write_archives(warc.mark_revisits(spark.createDataFrame([(1, "u", "hi")], SCHEMA)).coalesce(1), str(tmp_path / "w"))
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("*.gz"))
    head, _, rest = raw.partition(b"\r\n\r\n")
    n = int(head.split(b"Content-Length: ")[1])
    assert raw.startswith(b"WARC/1.1\r\n") and rest[n:] == b"\r\n\r\n"


def test_minimum_size_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], SCHEMA)
    assert {r.page_id: r.refers_to for r in warc.mark_revisits(df, min_bytes=3).collect()} == {1: None, 2: None, 3: None, 4: 3}
    path = scratch(spark, "warc")
    warc.write_archives(warc.mark_revisits(df.limit(0)), path)
    assert warc.reassemble(warc.read_records(spark, path)).collect() == []


def test_damage_is_reported(spark):
    body = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"hello world", 4)
    digest = "sha1:" + warc.payload_digest(b"hello world")
    row = lambda origin, n, total, block: (f"<urn:page:{origin}:x>", n, total, "response" if n in (None, 1) else "continuation", digest, None, "u", block, None)
    rows = [
        row(1, 2, len(body), body[20:]), row(1, 1, None, body[:20]), row(2, 1, None, body[:20]), row(3, 1, None, body[:20]), row(3, 3, len(body), body[20:]),
        row(4, 1, None, body[:20]), row(4, 2, 999, body[20:]), row(5, None, None, body[:-4]), row(6, None, None, body.replace(b"hell", b"hall")),
    ]
    made = {r.page_id: r.problem for r in warc.reassemble(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert made[1] is None and all(made[i] for i in (2, 3, 4, 5, 6)) and made[6] == "digest differs"
    assert hashlib.sha1(b"hello world").digest_size == 20


def test_revisits_name_a_record_and_other_columns_do_no_harm(spark, tmp_path):
    given = spark.createDataFrame([(5, "u", "same", 1, "x"), (3, "u", "same", 2, "y"), (None, "u", "same", 3, "z")], "page_id long, url string, html string, refers_to int, block string")
    warc.write_archives(warc.mark_revisits(given), str(tmp_path / "w"))
    rows = warc.read_records(spark, str(tmp_path / "w")).collect()
    ids = {r.origin for r in rows if r.warc_type == "response"}
    assert len(ids) == 1 and {r.refers for r in rows if r.warc_type == "revisit"} == ids and len(rows) == 3


def test_cut_and_malformed_archives_give_what_they_have(spark, tmp_path):
    given = spark.createDataFrame([(1, "u", "first"), (2, "u", "second " * 300), (3, "u", "third")], SCHEMA)
    warc.write_archives(warc.mark_revisits(given).coalesce(1).sortWithinPartitions("page_id"), str(tmp_path / "w"), segment=500, compression="none")
    raw = next((tmp_path / "w").glob("part*")).read_bytes()
    for n, (damaged, want) in enumerate([(raw[:-40], {1: True, 2: True, 3: False}), (raw[: len(raw) // 2], {1: True, 2: False}), (raw.replace(b"Content-Length: ", b"Content-Length: x", 1), {1: False, 2: True, 3: True}), (b"no archive at all", {None: False})]):
        folder = tmp_path / f"d{n}"
        folder.mkdir()
        (folder / "a.warc").write_bytes(damaged)
        got = {r.page_id: r.problem is None for r in warc.reassemble(warc.read_records(spark, str(folder))).collect()}
        assert got == want


def foreign(version, n, body=b"hello", extra=b""):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + body
    head = f"{version}\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{n}:x>\r\nWARC-Target-URI: u{n}\r\nWARC-Payload-Digest: sha1:{warc.payload_digest(body)}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + extra + b"\r\n\r\n"


@pytest.mark.parametrize("versions", [["WARC/1.0"] * 5, ["WARC/1.1"] * 5, ["WARC/1.0", "WARC/1.1", "WARC/1.0", "WARC/1.0", "WARC/1.1"]])
def test_both_versions_are_read(spark, tmp_path, versions):
    inside = b"x\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.5 y"
    raw = b"".join(foreign(v, i, inside if i == 2 else b"hello %d" % i) for i, v in enumerate(versions))
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(raw))
    got = {r.page_id: r for r in warc.reassemble(warc.read_records(spark, str(tmp_path))).collect()}
    assert sorted(got) == list(range(5)) and all(r.problem is None for r in got.values())
    assert bytes(got[2].payload) == inside and got[4].uri == "u4"


def test_bytes_beyond_a_record_are_reported(spark, tmp_path):
    raw = foreign("WARC/1.0", 0, extra=b"surplus") + foreign("WARC/1.1", 1) + foreign("WARC/0.18", 2) + foreign("WARC/1.7", 3) + foreign("WARC/1.0", 4)
    (tmp_path / "a.warc").write_bytes(raw)
    got = {r.page_id: r.problem for r in warc.reassemble(warc.read_records(spark, str(tmp_path))).collect()}
    assert got.keys() == {0, 1, 4} and got[4] is None
    assert got[0].startswith("7 bytes beyond") and "bytes beyond" in got[1]
