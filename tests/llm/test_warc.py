from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib

import pytest

from pathquality.llm import warc

SCHEMA = "page_id long, url string, html string"


def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def brute(rows, min_bytes=0):
    first, out, seen = {}, [], set()
    for page_id, _, html in rows:
        data = (html or "").encode()
        if page_id is not None:
            first[data] = min(page_id, first.get(data, page_id))
    for page_id, _, html in rows:
        data = (html or "").encode()
        leads = page_id == first.get(data) and data not in seen
        if len(data) < min_bytes or leads:
            seen.add(data)
            out.append((page_id, len(data), b32(data), "response", None))
        else:
            out.append((page_id, len(data), b32(data), "revisit", first.get(data)))
    return sorted(out, key=repr)


PAGES = [
    (5, "http://a/", "<p>one</p>"), (3, "http://b/", "<p>one</p>"), (3, "http://b/", "<p>one</p>"),
    (9, None, None), (7, "", ""), (8, "http://x/ y\r\nEvil: 1", "WARC/1.1\r\n\r\n\x00\x1f\x8b"), (None, "http://n/", "<p>one</p>"),
    (11, "http://c/", "é\U0001f600" * 50_000), (12, "http://c/", "é\U0001f600" * 50_000), (-4, "http://neg/", "minus"),
    (13, "http://d/", "short"), (14, "http://d/", "short")]


@pytest.mark.parametrize(("min_bytes", "archive_bytes"), [(0, 1 << 20), (6, 1)])
def test_round_trip(spark, min_bytes, archive_bytes):
    frame = spark.createDataFrame(PAGES, SCHEMA).selectExpr("*", "'x' as key", "1 as n", "'y' as first").repartition(3)
    got = warc.archived(frame, min_bytes, archive_bytes).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(PAGES, min_bytes)
    assert all(r["verified"] for r in got)
    assert {r["page_id"]: r["url"] for r in got}[8] == "http://x/%20y%0D%0AEvil:%201"
    assert {r["page_id"]: r["url"] for r in got}[9] is None


def test_archives_of_a_bounded_size(spark):
    pages = spark.range(200).selectExpr("id as page_id", "'u' as url", "sha2(string(id), 512) as html").coalesce(2)
    archives = warc.write_pages(pages, archive_bytes=2000).collect()
    assert len(archives) > 10 and sum(r["n_records"] for r in archives) == 200
    found = warc.read_archives(spark, spark.createDataFrame(archives), payloads=True).filter("kind = 'response'")
    assert found.count() == 200 and found.select("payload").distinct().count() == 200
    assert found.filter("problem is not null or http_length <> n_bytes").count() == 0


def test_hot_payload(spark):
    pages = spark.range(5000).selectExpr("id as page_id", "'u' || id as url", "if(id % 3 = 0, 'same', string(id)) as html")
    got = warc.archived(pages)
    assert got.filter("record_type = 'revisit' and refers_to = 0").count() == 1666
    assert got.filter("record_type = 'response'").count() == 3334


def test_of_nothing(spark):
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [tuple(r)[:5] for r in warc.archived(spark.createDataFrame([(None, None, None)], SCHEMA)).collect()] == [
        (None, 0, b32(b""), "response", None)]


def written(*bodies, level=6):
    return [b"".join(warc.member(warc.record("resource", f"urn:x:{i}", [body], WARC_Payload_Digest=f"sha1:{b32(body)}"), level))
            for i, body in enumerate(bodies)]


class Slow(io.BytesIO):
    """Gives a few bytes at a time, whatever is asked for."""

    def read(self, n=-1):
        return super().read(min(n, 7))


def test_members_read_piece_by_piece():
    bodies = [b"", b"a", bytes(range(256)) * 3000, b"\r\n\r\nWARC/1.1\r\n\r\n"]
    data = b"".join(written(*bodies))
    whole = gzip.compress(gzip.decompress(data))      # all records in one member
    for raw in (io.BytesIO(data), Slow(data), io.BytesIO(whole), io.BytesIO(gzip.decompress(data)), io.BytesIO(data + b"\0" * 9)):
        got = list(warc.records(raw, keep=True))
        assert [r.payload for r in got] == bodies and all(r.problem is None for r in got)
        assert [r.named["warc-record-id"] for r in got] == [f"<urn:x:{i}>" for i in range(4)]


def test_memory_is_bounded():
    """A payload of 200 MB of zeros is 200 kB compressed; no more than some pieces are ever held."""
    import tracemalloc

    def zeros():
        yield (b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % (200 << 20))
        for _ in range(200):
            yield b"\0" * (1 << 20)
        yield b"\r\n\r\n"
    data = b"".join(warc.member(zeros()))
    tracemalloc.start()
    (got,) = warc.records(io.BytesIO(data))
    assert got.n_bytes == 200 << 20 and got.problem is None and tracemalloc.get_traced_memory()[1] < 4 << 20
    tracemalloc.stop()


def test_damage_is_said_and_passed_over():
    one, two, three = written(b"first", b"second" * 50_000, b"third")
    plain = gzip.decompress(two)
    changed = gzip.compress(plain.replace(b"second", b"sEcond", 1))
    short = gzip.compress(plain[:-200])
    headless = gzip.compress(b"nothing of the kind")
    endless = gzip.compress(b"WARC/1.1\r\nContent-Length: 5")
    lengthless = gzip.compress(b"WARC/1.1\r\nContent-Length: -5\r\n\r\n")
    for middle, problem in ((changed, "the block does not fit its digest"), (short, "the block ends early"),
                            (headless, "a head does not end"), (endless, "a head does not end"),
                            (lengthless, "a record without length")):
        got = list(warc.records(io.BytesIO(one + middle + three), keep=True))
        assert [r.problem for r in got] == [None, problem, None] and got[2].payload == b"third"
    got = list(warc.records(io.BytesIO(one + two[:len(two) // 2])))
    assert [r.problem for r in got] == [None, "the archive ends within a member"]
    broken = bytearray(two)
    broken[len(two) // 2:] = bytes(len(two) - len(two) // 2)
    got = list(warc.records(io.BytesIO(one + bytes(broken) + three)))
    assert got[0].problem is None and got[1].problem is not None
    broken = bytearray(two)
    broken[10] = 7    # a kind of block that deflate does not have
    got = list(warc.records(io.BytesIO(one + bytes(broken) + three)))
    assert got[0].problem is None and "inflated" in got[1].problem and len(got) == 2
    assert [r.problem for r in warc.records(io.BytesIO(b"no archive"))] == ["a head does not end"]
    assert list(warc.records(io.BytesIO(b""))) == []


def test_digests_of_other_kinds():
    body = b"x" * 1000
    for stated, fits in ((f"sha1:{hashlib.sha1(body).hexdigest()}", True), (f"md5:{hashlib.md5(body).hexdigest()}", True),
                         (f"sha-256:{base64.b32encode(hashlib.sha256(body).digest()).decode()}", True),
                         (f"sha256:{'0' * 64}", False), ("sha1:short", True), ("unknown:abc", True)):
        data = b"".join(warc.record("resource", "urn:x", [body], WARC_Payload_Digest=stated))
        (got,) = warc.records(io.BytesIO(data))
        assert (got.problem is None) == fits, stated


def test_http_heads():
    def of(block, kind="response"):
        return next(warc.records(io.BytesIO(zlib.compress(b"".join(warc.record(
            kind, "urn:x", [block], Content_Type="application/http; msgtype=response")), wbits=31)), keep=True))
    got = of(b"HTTP/1.1 200 OK\r\nX-Long: a\r\n b\r\nContent-Length: 3\r\n\r\nabc")
    assert (got.payload, got.http["x-long"], got.http["content-length"]) == (b"abc", "a b", "3")
    assert of(b"no head at all").payload == b"no head at all"
    assert of(b"").payload == b""
