"""WARC archives: pages are written as records, one gzip member each, and read back in order.

A task of the writer fills archives of its own in the shared folder and returns their names; an
attempt that is lost leaves a file that no one names. The reader takes an archive from front to
back: it inflates a few kilobytes at a time, frames records by Content-Length, and feeds what
it passes to the digests, so neither an archive nor a payload is ever whole in memory unless the
caller asks for payloads.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import suppress
from dataclasses import dataclass, field
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathquality.session import scratch_folder

from .common import ready, stored, temporary

PIECE = 64 << 10            # bytes read or inflated at a time
HEAD = 1 << 20              # a longer head of a record or response is not one
ARCHIVE_BYTES = 256 << 20   # an archive that has reached this size is closed
MOST_READERS = 20_000       # tasks that read archives; beyond that they take several each
DATE = "2026-01-01T00:00:00Z"

# Fixed values of the format
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"


# Writing ----------------------------------------------------------------------------------


def digest_text(digest: bytes) -> str:
    """Bare upper-case base32, as archives state digests."""
    return base64.b32encode(digest).decode()


def record(kind: str, record_id: str, block: list[bytes], **named: str | None) -> Iterator[bytes]:
    """A record in pieces. `named` are further headers, `_` for `-`; None leaves one out."""
    check = hashlib.sha1()
    for piece in block:
        check.update(piece)
    lines = [VERSION.decode(), f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>"]
    lines += [f"{name.replace('_', '-')}: {value}" for name, value in named.items() if value is not None]
    lines += [f"WARC-Block-Digest: sha1:{digest_text(check.digest())}",
              f"Content-Length: {sum(map(len, block))}", "", ""]
    yield "\r\n".join(lines).encode("utf-8", "surrogatepass")
    yield from block
    yield b"\r\n\r\n"


def member(pieces: Iterator[bytes], level: int = 6) -> Iterator[bytes]:
    squeeze = zlib.compressobj(level, wbits=31)
    for piece in pieces:
        yield squeeze.compress(piece)
    yield squeeze.flush()


def _escaped(url: str | None) -> str | None:
    """Blanks and control characters would break a header line."""
    return None if url is None else re.sub(
        r"[\x00-\x20\x7f]", lambda found: f"%{ord(found[0]):02X}", url)


def page_urn(page_id: int | None, url: str | None, key: str, copy: int) -> str:
    tag = hashlib.sha256(f"{'-' if url is None else '+' + url}|{key}".encode("utf-8", "surrogatepass"))
    return f"urn:page:{'-' if page_id is None else page_id}:{tag.hexdigest()[:16]}:{copy}"


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<?urn:page:(-?\d+):[0-9a-f]{16}:\d+>?", urn or "")
    return int(found[1]) if found else None


def _page_record(row: dict, date: str) -> Iterator[bytes]:
    head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['n_bytes']}\r\n\r\n").encode()
    named = {
        "WARC_Date": date, "WARC_Target_URI": _escaped(row["url"]),
        "WARC_Payload_Digest": f"sha1:{digest_text(bytes.fromhex(row['sha1']))}", "Content_Type": HTTP_TYPE}
    own = page_urn(row["page_id"], row["url"], row["key"], row["copy"])
    if row["first"] is None:
        return record("response", own, [head, row["payload"]], **named)
    first = row["first"]
    return record(
        "revisit", own, [head], WARC_Profile=REVISIT_PROFILE,
        WARC_Refers_To=f"<{page_urn(first['page_id'], first['url'], row['key'], 0)}>",
        WARC_Refers_To_Target_URI=_escaped(first["url"]), WARC_Refers_To_Date=date, **named)


def _writer(folder: str, archive_bytes: int, date: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, at = fs.FileSystem.from_uri(folder)
        out, name, n_records, n_bytes = None, "", 0, 0
        closed: list[tuple[str, int, int]] = []
        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    if out is None:
                        name, n_records, n_bytes = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                        place.create_dir(at, recursive=True)
                        out = place.open_output_stream(f"{at}/{name}", compression=None)
                        about = b"software: pathquality\r\nformat: WARC File Format 1.1\r\n"
                        for piece in member(record("warcinfo", f"urn:uuid:{uuid.uuid4()}", [about], WARC_Date=date,
                                                   Content_Type="application/warc-fields")):
                            out.write(piece)
                    row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                    for piece in member(_page_record(row, date)):
                        n_bytes += len(piece)
                        out.write(piece)
                    n_records += 1
                    if n_bytes >= archive_bytes:
                        out.close()
                        out = None
                        closed.append((f"{folder}/{name}", n_records, n_bytes))
        finally:
            if out is not None:
                out.close()
        if out is not None:
            closed.append((f"{folder}/{name}", n_records, n_bytes))
        if closed:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*closed, strict=True)], ["path", "n_records", "n_bytes"])
    return run


def _records(pages: DataFrame, min_bytes: int) -> DataFrame:
    """One row per record. Rows that are the same throughout are counted, not numbered, so a
    task that is run again makes the same records."""
    base = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html")
    ).select("page_id", "url", "html", F.sha2("html", 256).alias("key"), F.sha1("html").alias("sha1"),
             F.octet_length("html").cast("long").alias("n_bytes"))
    order = [F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url"]
    small = F.col("n_bytes") < min_bytes
    alone = F.when(small, F.struct("page_id", "url"))
    held = base.groupBy("key", alone.alias("alone")).agg(
        F.min(F.struct(*order, "n_bytes", "sha1", "html")).alias("w"), F.count(F.lit(1)).alias("n"))
    response = held.withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.when(F.col("alone").isNull(), 0).otherwise(F.col("n") - 1)))
    ).select("w.page_id", "w.url", "key", "w.sha1", "w.n_bytes", "copy", F.encode("w.html", "UTF-8").alias("payload"),
             F.lit(None).cast("struct<page_id:long,url:string>").alias("first"))
    # without texts; written, so that their join can be split where many pages are the same
    rows = stored(base.filter(~small).groupBy("key", "page_id", "url", "sha1", "n_bytes").agg(
        F.count(F.lit(1)).alias("n")), "warc-rows")
    firsts = stored(rows.groupBy("key").agg(
        F.min(F.struct(*order)).alias("f"), F.sum("n").alias("all")).filter("all > 1").select(
        "key", F.struct("f.page_id", "f.url").alias("first")), "warc-firsts")
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    revisit = rows.join(firsts, "key").withColumn("from", F.when(is_first, 1).otherwise(0)).filter(
        F.col("from") < F.col("n")).withColumn("copy", F.explode(F.sequence(F.col("from"), F.col("n") - 1)))
    return response.unionByName(revisit.select(
        "page_id", "url", "key", "sha1", "n_bytes", "copy", F.lit(None).cast("binary").alias("payload"), "first"))


def write_pages(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Writes the pages to archives in the shared folder: `path`, `n_records`, `n_bytes` of each.

    One record per row of `pages` (page_id, url, html), payload the html in UTF-8, null: empty.
    Of records with equal payloads of at least `min_bytes` bytes the one with the smallest page_id
    (null last, then url) is a response and the others revisit it, rows that repeat it too; shorter
    payloads are all responses. Blanks and control characters of a url are percent-encoded, a null
    url has no header. An empty table writes no archive; other columns are not read.
    """
    spark = ready(pages.sparkSession)
    folder = temporary(spark, scratch_folder(spark, "warc"))
    return stored(_records(pages, min_bytes).mapInArrow(
        _writer(folder, archive_bytes, date), "path string, n_records long, n_bytes long"), "warc-archives")


# Reading ----------------------------------------------------------------------------------


class Damaged(Exception):
    """Bytes that are no record."""


class Inflated:
    """The bytes of an archive, inflated piece by piece if it is compressed."""

    def __init__(self, raw: BinaryIO) -> None:
        self.raw, self.have = raw, b""
        self.waiting = raw.read(PIECE)
        self.zipped = self.waiting[:2] == b"\x1f\x8b"
        self.inflate = zlib.decompressobj(31) if self.zipped else None
        self.members = 0    # that ended
        self.over = False   # nothing more can be inflated

    def _more(self) -> bytes:
        """Up to PIECE further bytes, from one member; empty at the end of the archive."""
        while not self.over:
            if not self.waiting:
                self.waiting = self.raw.read(PIECE)
            if not self.zipped:
                out, self.waiting = self.waiting, b""
                return out
            if self.inflate.eof:
                self.members += 1
                if not self.waiting:
                    self.waiting = self.raw.read(PIECE)
                if not self.waiting.strip(b"\0"):
                    break
                self.inflate = zlib.decompressobj(31)
            try:
                out = self.inflate.decompress(self.waiting, PIECE) if self.waiting else None
            except zlib.error as error:
                self.over = True
                raise Damaged("a member cannot be inflated") from error
            if out is None:
                self.over = True
                raise Damaged("the archive ends within a member")
            # at its end a member may name what follows it in both
            self.waiting = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if out:
                return out
        self.over = True
        return b""

    def next_member(self) -> None:
        """Passes over the rest of a member."""
        here = self.members
        while self.members == here and not self.over:
            self.have = self._more()

    def read(self, n: int) -> bytes:
        """From 1 to n bytes; none at the end."""
        if not self.have:
            self.have = self._more()
        out, self.have = self.have[:n], self.have[n:]
        return out

    def until(self, end: bytes) -> bytes:
        """What stands before `end`, which is passed, within a member."""
        found, here = self.have, self.members
        while (at := found.find(end)) < 0:
            self.have = self._more() if len(found) < HEAD else b""
            if not self.have or self.members != here:
                raise Damaged("a head does not end")
            found += self.have
        self.have = found[at + len(end):]
        return found[:at]

    def skip_blank_lines(self) -> bool:
        """Is there anything left?"""
        while True:
            self.have = self.have.lstrip(b"\r\n")
            if self.have:
                return True
            self.have = self._more()
            if not self.have:
                return False


@dataclass
class Record:
    named: dict[str, str]
    n_bytes: int = 0                # of the payload passed
    payload_digest: str | None = None
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes | None = None
    problem: str | None = None

    @property
    def kind(self) -> str:
        return self.named.get("warc-type", "").lower()


def _fields(head: bytes) -> dict[str, str]:
    """Names in lower case; a line that begins with a blank goes on with the one before."""
    lines = re.sub(rb"\r?\n[ \t]+", b" ", head).split(b"\n")
    pairs = (line.partition(b":") for line in lines if b":" in line)
    return {name.strip().lower().decode("utf-8", "replace"): value.strip().decode("utf-8", "replace")
            for name, _, value in pairs}


_LENGTHS = {"sha1": 20, "md5": 16, "sha256": 32, "sha512": 64}


def _stated(text: str | None) -> tuple[str, bytes] | None:
    """Algorithm and digest, in base32 or hexadecimal; None if it is no digest known here."""
    name, _, value = (text or "").partition(":")
    name = name.strip().lower().replace("-", "")
    length, value = _LENGTHS.get(name), value.strip()
    try:
        if length and len(value) == 2 * length:
            return name, bytes.fromhex(value)
        if length:
            digest = base64.b32decode(value.upper() + "=" * (-len(value) % 8))
            return (name, digest) if len(digest) == length else None
    except (ValueError, binascii.Error):
        pass
    return None


class _Check:
    """A digest taken on the way, sha1 where the record states none."""

    def __init__(self, stated: str | None) -> None:
        self.want = _stated(stated)
        self.sha1 = hashlib.sha1()
        other = self.want and self.want[0] != "sha1"
        self.own = hashlib.new(self.want[0]) if other else self.sha1

    def add(self, piece: bytes) -> None:
        self.sha1.update(piece)
        if self.own is not self.sha1:
            self.own.update(piece)

    def fits(self) -> bool:
        return self.want is None or self.own.digest() == self.want[1]


def _one(source: Inflated, keep: bool) -> Record:
    here = source.members
    first, _, rest = source.until(b"\r\n\r\n").partition(b"\n")
    if not re.fullmatch(rb"WARC/\d+\.\d+\r?", first):
        raise Damaged("no record begins here")
    out = Record(_fields(rest))
    try:
        left = int(out.named["content-length"])
    except (KeyError, ValueError) as error:
        raise Damaged("a record without length") from error
    if left < 0:
        raise Damaged("a record without length")
    block = _Check(out.named.get("warc-block-digest"))
    payload = _Check(out.named.get("warc-payload-digest") if out.kind != "revisit" else None)
    kept: list[bytes] = []
    # the head of an HTTP message is not part of the payload
    head = b"" if out.named.get("content-type", "").lower().startswith("application/http") else None
    while left:
        try:
            piece = source.read(min(left, PIECE))
        except Damaged as problem:
            out.problem = str(problem)
            break
        if not piece or source.members != here:
            source.have = piece + source.have  # the next record's
            out.problem = "the block ends early"
            break
        left -= len(piece)
        block.add(piece)
        if head is not None:
            head += piece
            at = head.find(b"\r\n\r\n")
            if at < 0 and len(head) < HEAD and left:
                continue
            out.http = _fields(head[:max(at, 0)])
            piece, head = head[at + 4 if at >= 0 else 0:], None
        payload.add(piece)
        out.n_bytes += len(piece)
        if keep:
            kept.append(piece)
    out.payload_digest = digest_text(payload.sha1.digest())
    out.payload = b"".join(kept) if keep else None
    if out.problem is None and not block.fits():
        out.problem = "the block does not fit its digest"
    if out.problem is None and not payload.fits():
        out.problem = "the payload does not fit its digest"
    return out


def records(raw: BinaryIO, keep: bool = False) -> Iterator[Record]:
    """The records of an archive, compressed or not, in order. What is damaged gives a record
    that says so; reading goes on at the next gzip member where there is one."""
    source = Inflated(raw)
    while True:
        here = source.members
        try:
            if not source.skip_blank_lines():
                return
            here = source.members
            yield _one(source, keep)
        except Damaged as problem:
            yield Record({}, problem=str(problem))
            with suppress(Damaged):  # said once
                if source.members == here:
                    source.next_member()


_READ = ("path string, place long, kind string, record_id string, target_uri string, date string, refers_to string, "
         "http_length long, n_bytes long, payload_digest string, stated_digest string, problem string, payload binary")
_READ_SCHEMA = pa.schema([
    (name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind])
    for name, kind in (x.split() for x in _READ.split(", "))])


def _length(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"[0-9]{1,18}", text) else None


def _reader(keep: bool, n_rows: int = 1000, n_bytes: int = 8 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                place, at = fs.FileSystem.from_uri(path)
                with place.open_input_stream(at, compression=None) as raw:
                    for i, r in enumerate(records(raw, keep)):
                        get = r.named.get
                        rows.append((
                            path, i, r.kind or None, get("warc-record-id"), get("warc-target-uri"), get("warc-date"),
                            get("warc-refers-to"), _length(r.http.get("content-length")), r.n_bytes, r.payload_digest,
                            get("warc-payload-digest"), r.problem, r.payload))
                        held += len(r.payload or b"")
                        if len(rows) >= n_rows or held >= n_bytes:
                            yield pa.RecordBatch.from_pylist(
                                [dict(zip(_READ_SCHEMA.names, x, strict=True)) for x in rows], _READ_SCHEMA)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(_READ_SCHEMA.names, x, strict=True)) for x in rows], _READ_SCHEMA)
    return run


def read_archives(spark: SparkSession, paths: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record of the archives in the column `path`, in any order; `path` and `place` give
    it back. `payload` is null unless asked for; `problem` is null where framing and digests are
    right. Paths are opened by pyarrow where the task runs."""
    names = paths.select("path").filter("path is not null")
    n = max(1, min(names.count(), MOST_READERS))
    return names.repartition(n).mapInArrow(_reader(payloads), _READ)


def archived(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """The pages, written to archives (see `write_pages`) and read back: `page_id`,
    `payload_bytes`, `payload_digest` (bare base32 SHA-1), `record_type`, `refers_to` (page_id of
    the response, for revisits), `url` as archived, `verified`."""
    found = read_archives(pages.sparkSession, write_pages(pages, min_bytes, archive_bytes))
    revisit = F.col("kind") == "revisit"

    def page(urn: str):
        return F.regexp_extract(urn, r"^<urn:page:(-?\d+):", 1)

    return found.filter("kind is null or kind <> 'warcinfo'").select(
        F.when(page("record_id") != "", page("record_id").cast("long")).alias("page_id"),
        F.when(revisit, F.col("http_length")).otherwise(F.col("n_bytes")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("stated_digest", "^sha1:", "")).otherwise(
            F.col("payload_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.when(revisit & (page("refers_to") != ""), page("refers_to").cast("long")).alias("refers_to"),
        F.col("target_uri").alias("url"), F.col("problem").isNull().alias("verified"))


ARCHIVE_SQL = """
with payloads as (
    select page_id, url, coalesce(html, '') as body, sha1(coalesce(html, '')) as hex from pages
), placed as (
    select *, row_number() over (partition by body order by page_id nulls last, url nulls last) as place,
           first_value(page_id) over (partition by body order by page_id nulls last, url nulls last) as first_id
    from payloads
)
select page_id, strlen(body)::bigint as payload_bytes,
       array_to_string([
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::int >> (15 - 5 * (i % 4))) & 31)::int, 1)
           for i in range(32)], '') as payload_digest,
       case place when 1 then 'response' else 'revisit' end as record_type,
       case when place > 1 then first_id end as refers_to,
       url, true as verified
from placed
"""
