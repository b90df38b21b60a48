"""WARC (10): converts legacy ARC archives into equivalent WARC files.

An ARC file starts with a version block whose header line is
``filedesc://name ip date type length``; its body names the version and the
fields of all header lines that follow. Version 1 lines have five fields
(URL, IP address, date, type, length), version 2 lines ten (result code,
checksum, location, offset and file name stand before the length). The declared
length delimits a record's bytes. URLs may hold spaces: fields are counted from the right.

The converter synthesises what WARC wants: WARC-Date from the 14-digit date, a
WARC-Record-ID that depends only on the record (name-based UUID of URL, date,
place and block digest), WARC-Type (``warcinfo`` for the version block, ``response``
for HTTP messages, ``resource`` for others), block and payload digests
(SHA-1, base32). Responses whose payloads are equal and at least ``least_bytes``
long become one ``response`` and ``revisit`` records that hold the HTTP header
alone and refer to it: the record with the largest page_id is kept.

Files are gzip with a member per record, written by Spark tasks under random
attempt names and read only through their committed manifest table.

Defined cases: a null html is an empty payload; a null or blank url is
``http://unknown.invalid/``, white space in urls is percent-encoded; rows that
repeat the largest page_id with the same payload are all responses; a null
page_id is smaller than any other, and where a payload has null ids only, all its records
are responses. Empty tables make no files. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import importable, scratch_dir, table, written
from .records import _open

#: Header fields by ARC version (fixed values of the format).
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
PAGE_HEADER = "X-Page-Id"
SHARD_BYTES = 16 << 20           # of records before compression
CAPTURED = datetime.datetime(2000, 1, 1)
_ROWS = 64


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class Stream:
    """Bytes of a plain or gzip file (any number of members), read by line or by length."""

    def __init__(self, path: str, chunk: int = 1 << 20):
        fs, at = _open(path)
        self.file, self.chunk, self.have, self.at = fs.open_input_stream(at, compression=None), chunk, b"", 0
        self.raw = self.file.read(chunk)
        self.unzip = zlib.decompressobj(31) if self.raw[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.file.read(self.chunk)
                if not self.raw:
                    return False
            if self.unzip is None:
                got, self.raw = self.raw, b""
            else:
                got = self.unzip.decompress(self.raw, self.chunk)
                self.raw = self.unzip.unconsumed_tail
                if self.unzip.eof:
                    self.raw, self.unzip = self.unzip.unused_data, zlib.decompressobj(31)
            if got:
                self.have, self.at = self.have[self.at:] + got, 0
                return True

    def line(self) -> bytes:
        """Up to and with the next line feed; empty at the end."""
        seen = self.at
        while (end := self.have.find(b"\n", seen)) < 0:
            seen = len(self.have) - self.at
            if not self._more():
                end = len(self.have) - 1
                break
        out, self.at = self.have[self.at: end + 1], end + 1
        return out

    def take(self, n: int) -> bytes:
        parts = []
        while n > 0:
            part = self.have[self.at: self.at + n]
            parts.append(part)
            self.at, n = self.at + len(part), n - len(part)
            if n and not self._more():
                raise ValueError("an archive ends within a record")
        return b"".join(parts)

    def close(self) -> None:
        self.file.close()


# ---- ARC -----------------------------------------------------------------------

def arc_version_block(name: str, version: int, when: str) -> bytes:
    body = f"{version} 0 farebox\n{' '.join(FIELDS[version])}\n".encode()
    return f"filedesc://{name} 0.0.0.0 {when} text/plain {len(body)}\n".encode() + body


def arc_record(version: int, url: str, ip: str, when: str, kind: str, block: bytes, name: str = "-", offset: int = 0) -> bytes:
    more = ["200", "-", "-", str(offset), name] if version == 2 else []
    return "\n".encode() + " ".join([url, ip, when, kind, *more, str(len(block))]).encode() + b"\n" + block


def parse_arc(stream: Stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and bytes of every record, the version block first."""
    fields = FIELDS[1]
    while True:
        line = stream.line()
        while line in (b"\n", b"\r\n"):
            line = stream.line()
        if not line:
            return
        text = line.decode("utf-8", "surrogateescape").rstrip("\r\n")
        head = text.startswith("filedesc://")
        names = FIELDS[1] if head and len(text.split(" ")) < len(FIELDS[2]) else FIELDS[2] if head else fields
        values = text.rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].isdigit():
            raise ValueError(f"not an ARC header line: {text[:200]!r}")
        block = stream.take(int(values[-1]))
        if head:
            lines = block.decode("utf-8", "replace").splitlines()
            version = int(lines[0].split()[0])
            fields = lines[1].split() if len(lines) > 1 else FIELDS[version]
        yield dict(zip(names, values, strict=True)), block


def split_http(block: bytes) -> tuple[bytes, bytes] | None:
    """HTTP header (with its blank line) and payload; None if it is no HTTP message."""
    if not block.startswith(b"HTTP/"):
        return None
    for gap in (b"\r\n\r\n", b"\n\n"):
        if (at := block.find(gap)) >= 0:
            return block[: at + len(gap)], block[at + len(gap):]
    return block, b""


def http_field(header: bytes, name: str) -> str | None:
    want = name.lower().encode() + b":"
    for line in header.splitlines()[1:]:
        if line.lower().startswith(want):
            return line[len(want):].strip().decode("utf-8", "replace")
    return None


def warc_date(when: str) -> str:
    """ISO date of a legacy one; digits that are missing count as the earliest moment."""
    digits = (when + "00000101000000"[len(when):])[:14] if when.isdigit() else "19700101000000"
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:14]}Z"


def describe(fields: dict[str, str], block: bytes, place: str) -> dict:
    """What WARC wants to know of an ARC record."""
    url, http = fields["URL"], split_http(block)
    kind = "warcinfo" if url.startswith("filedesc://") else "response" if http else "resource"
    header, payload = http or (b"", block)
    page = http_field(header, PAGE_HEADER) if http else None
    digest, date = sha1(block), warc_date(fields["Archive-date"])
    return {"uri": url, "date": date, "ip": fields["IP-address"], "mime": fields["Content-type"], "type": kind,
            "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {place} {digest}')}",
            "block_digest": digest, "header": header, "payload": payload,
            "payload_digest": sha1(payload), "page_id": int(page) if page else None}


# ---- WARC ----------------------------------------------------------------------

def warc_record(r: dict) -> bytes:
    """A record's bytes; ``refers_to`` (page id, record id, uri, date) makes it a revisit."""
    refers, kind = r.get("refers_to"), r["type"]
    block = r["header"] if refers else r["header"] + r["payload"]
    lines = ["WARC/1.0", f"WARC-Type: {'revisit' if refers else kind}", f"WARC-Record-ID: <{r['record_id']}>", f"WARC-Date: {r['date']}",
             f"Content-Length: {len(block)}"]
    lines += [f"WARC-Filename: {r['uri'].removeprefix('filedesc://')}"] if kind == "warcinfo" else [f"WARC-Target-URI: {r['uri']}", f"WARC-IP-Address: {r['ip']}"]
    lines += [f"WARC-Block-Digest: sha1:{sha1(block) if refers else r['block_digest']}"]
    if kind == "response":
        lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{r['payload_digest']}"]
    else:
        lines += [f"Content-Type: {'application/warc-fields' if kind == 'warcinfo' else r['mime']}"]
    if refers:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{refers['record_id']}>", f"WARC-Refers-To-Target-URI: {refers['uri']}", f"WARC-Refers-To-Date: {refers['date']}",
                  f"X-Refers-To-Page: {refers['page_id']}"]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_warc(stream: Stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record; digests are confirmed."""
    while True:
        line = stream.line()
        while line in (b"\r\n", b"\n"):
            line = stream.line()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        fields = {}
        while (line := stream.line()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.take(int(fields["content-length"]))
        if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{sha1(block)}":
            raise ValueError("a block's digest doesn't hold")
        yield fields, block


# ---- Spark ---------------------------------------------------------------------

_SHARDS = "path string, records long"


def _shards(folder: str, suffix: str, lead: str, records: Iterator[bytes], first) -> Iterator[pa.RecordBatch]:
    """Writes records into shards, a gzip member each; a manifest row per shard."""
    shard, queue, size = 0, [], 0

    def close() -> pa.RecordBatch:
        nonlocal shard, queue, size
        path = f"{folder}/{lead}-{shard:05d}-{uuid.uuid4().hex}.{suffix}.gz"
        fs, at = _open(path)
        fs.create_dir(os.path.dirname(at), recursive=True)
        with fs.open_output_stream(at, compression=None) as f:
            f.write(b"".join([_member(first(os.path.basename(path))), *queue]))
        out = pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(queue)], pa.int64())], names=["path", "records"])
        shard, queue, size = shard + 1, [], 0
        return out

    for r in records:
        queue.append(_member(r))
        size += len(r)
        if size >= SHARD_BYTES:
            yield close()
    if queue:
        yield close()


def _clean_url(url: str | None) -> str:
    url = "".join(f"%{b:02X}" if b <= 32 or b == 127 else chr(b) for b in (url or "").strip().encode()).encode("latin-1").decode("utf-8", "replace")
    return url or "http://unknown.invalid/"


def write_arc(pages: DataFrame, folder: str, version: int = 2) -> DataFrame:
    """A legacy archive of ``pages`` (page_id, url, html) in a version of the format; its manifest."""
    importable(pages.sparkSession)
    when = CAPTURED.strftime("%Y%m%d%H%M%S")

    def write(batches):
        def records():
            for batch in batches:
                for i in range(0, batch.num_rows, _ROWS):
                    for page_id, url, html in zip(*(batch.slice(i, _ROWS).column(c).to_pylist() for c in range(3)), strict=True):
                        payload = (html or "").encode("utf-8", "surrogatepass")
                        mark = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
                        header = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n{mark}\r\n"
                        yield arc_record(version, _clean_url(url), "0.0.0.0", when, "text/html", header.encode() + payload)

        def head(name):
            return arc_version_block(name, version, when)

        yield from _shards(folder, "arc", "part", records(), head)

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return written(rows.mapInArrow(write, _SHARDS), "arc-manifest")


_PARSED = ("uri string, date string, ip string, mime string, type string, record_id string, block_digest string, "
           "header binary, payload binary, payload_digest string, page_id long")
_PARSED_TYPES = [pa.string()] * 7 + [pa.binary(), pa.binary(), pa.string(), pa.int64()]
_PARSED_NAMES = [x.split()[0] for x in _PARSED.split(", ")]


def parse_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the ARC files that ``manifest`` (path) names."""
    importable(manifest.sparkSession)

    def parse(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                stream, rows, size = Stream(path), [], 0
                name = path.rsplit("/", 1)[-1]
                for n, (fields, block) in enumerate(parse_arc(stream)):
                    rows.append(describe(fields, block, f"{name}:{n}"))
                    size += len(block)
                    if size >= 2 << 20:
                        yield _parsed(rows)
                        rows, size = [], 0
                stream.close()
                if rows:
                    yield _parsed(rows)

    spread = 4 * manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.select("path").repartition(spread, F.xxhash64("path")).mapInArrow(parse, _PARSED)


def _parsed(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(_PARSED_NAMES, _PARSED_TYPES, strict=True)], names=_PARSED_NAMES)


def with_references(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds ``refers_to``: the kept response of the same payload, null for records that stay."""
    who = F.struct("page_id", "record_id", "uri", "date")
    usable = (F.col("type") == "response") & (F.length("payload") >= least_bytes)
    kept = (records.where(usable).groupBy("payload_digest").agg(F.max(who).alias("kept"), F.count("*").alias("n"))
            .where("n > 1 AND kept.page_id IS NOT NULL").select("payload_digest", "kept"))
    other = usable & F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept.page_id"))
    return records.join(kept, "payload_digest", "left").withColumn("refers_to", F.when(other, F.col("kept"))).drop("kept")


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Writes described records as WARC files below ``folder``; their manifest."""
    importable(records.sparkSession)

    def write(batches):
        def rows():
            for batch in batches:
                for i in range(0, batch.num_rows, _ROWS):
                    for r in batch.slice(i, _ROWS).to_pylist():
                        if r["type"] != "warcinfo":
                            yield warc_record(r)

        def head(name):
            body = b"software: farebox\r\nformat: WARC File Format 1.0\r\nconformsTo: converted from ARC\r\n"
            return warc_record({"type": "warcinfo", "uri": f"filedesc://{name}", "date": warc_date(CAPTURED.strftime("%Y%m%d%H%M%S")), "header": b"", "payload": body,
                                "block_digest": sha1(body), "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}"})
        yield from _shards(folder, "warc", "part", rows(), head)

    return written(records.mapInArrow(write, _SHARDS), "warc-manifest")


def read_warc(manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, uri, date, record_id) of all page records."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri", "date", "record_id"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                stream, rows = Stream(path), []
                for fields, block in parse_warc(stream):
                    kind = fields["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    header, payload = split_http(block)
                    digest, page = fields["warc-payload-digest"].removeprefix("sha1:"), http_field(header, PAGE_HEADER)
                    n, refers = len(payload), None
                    if kind == "revisit":      # the payload isn't here: its length is the HTTP header's
                        n, refers = int(http_field(header, "Content-Length")), int(fields["x-refers-to-page"])
                    elif sha1(payload) != digest:
                        raise ValueError("a payload's digest doesn't hold")
                    rows.append((int(page) if page else None, n, digest, kind, refers, fields["warc-target-uri"], fields["warc-date"], fields["warc-record-id"].strip("<>")))
                stream.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    spread = 4 * manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.select("path").repartition(spread, F.xxhash64("path")).mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, date string, record_id string")


def convert(arc_manifest: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """ARC files to WARC files; the manifest of these."""
    return write_warc(with_references(parse_archives(arc_manifest), least_bytes), folder)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    legacy = write_arc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), scratch_dir(spark, "arc"))
    warc = convert(legacy, scratch_dir(spark, "warc"))
    return read_warc(warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op10_warc": op10_warc}
ORACLES: dict[str, str] = {}
