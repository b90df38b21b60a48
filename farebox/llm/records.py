"""Token-ID output (2): length-delimited binary records with a separate offset index.

Data file (``.rec``): records one after the other, integers little-endian,
    length    unsigned 64 bits, bytes of the payload
    crc       unsigned 32 bits, masked CRC-32C of those eight bytes
    payload   doc_id (signed 64 bits), then the token ids (16 bits each where the
              vocabulary fits, else 32)
    crc       unsigned 32 bits, masked CRC-32C of the payload
which is the framing of TFRecord files; the mask rotates a checksum right by 15
bits and adds 0xA282EAD8. Index file (``.idx``): for each record its offset and its
length in bytes, 64 bits each, so that a reader may visit records in any order.

Documents are range-partitioned and sorted by doc_id; every task writes its
rows as shards of about ``shard_bytes``. A shard's name holds a random attempt
id: a repeated task writes new files, and only the files that the committed
manifest table names are ever read. Files go through pyarrow's file systems to
the folder given (the query: below ``spark.checkpoint.dir``).

Encoding: byte-level BPE never joins across the place before a lone space that
stands between two non-space characters (nor in two places like it), so texts
are cut there, and the tokenizers library encodes the pieces; a bounded table
keeps the ids of those seen last. A text that holds one of the tokenizer's special strings is encoded
in one piece. The ids equal those of whole texts (tested).

Defined cases: a null or empty text has the end id only; null doc_ids sort last
and are stored as the smallest 64-bit number; repeated rows are repeated
records, in order of their text's hash; no rows, no files. Extra columns are
ignored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import importable, n_groups, scratch_dir, slices, table, written

NULL_ID = -(1 << 63)
END_ID = 0
SHARD_BYTES = 16 << 20
CACHE_PIECES = 200_000            # encoded pieces that a worker's table holds: some 50 MB, twice at most
CACHE_WORDS = 350_000             # words with what sticks to them: some 90 MB, twice at most
_MASK = 0xA282EAD8
_BLOCK = 1024                     # bytes whose checksum is computed in step with all other blocks
_GROUP = 4 << 20                  # bytes of such blocks at a time, one whole record at least


# ---- CRC-32C -------------------------------------------------------------------

def _crc_tables() -> np.ndarray:
    """tables[k][b]: the register after byte b and k zero bytes (reflected polynomial 0x82F63B78)."""
    first = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        first = np.where(first & 1, first >> 1 ^ np.uint32(0x82F63B78), first >> 1).astype(np.uint32)
    out = [first]
    for _ in range(7):
        out.append(out[-1] >> np.uint32(8) ^ first[out[-1] & 255])
    return np.stack(out)


_T = _crc_tables()


def _zeros(reg: np.ndarray, n: int) -> np.ndarray:
    """Registers after n zero bytes."""
    for _ in range(n):
        reg = reg >> np.uint32(8) ^ _T[0][reg & 255]
    return reg


_JUMP = np.stack([_zeros(np.arange(256, dtype=np.uint32) << np.uint32(8 * k), _BLOCK) for k in range(4)])


def crc32c(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC-32C of each byte range data[offsets[i]:offsets[i+1]]; about ``_GROUP`` bytes of blocks at a time."""
    upto = np.concatenate([[0], np.cumsum(np.maximum(1, -(-np.diff(offsets) // _BLOCK)) * _BLOCK)])
    out = np.zeros(len(offsets) - 1, np.uint32)
    for i, j in slices(upto, _GROUP):
        out[i:j] = _crc_group(data, offsets[i: j + 1])
    return out


def _crc_group(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """CRC-32C of at least one byte range.

    Each range is cut into blocks counted from its end, so that only the first
    one is short; it gets leading zero bytes, which leave a zero register alone.
    All blocks advance together eight bytes at a time, then each range's blocks are chained.
    """
    size = np.diff(offsets)
    blocks = np.maximum(1, -(-size // _BLOCK))
    first = np.cumsum(blocks) - blocks
    padded = np.zeros((int(blocks.sum()), _BLOCK), np.uint8)
    shift = first * _BLOCK + blocks * _BLOCK - size
    flat = padded.reshape(-1)
    for to, a, b in zip(shift.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        flat[to: to + b - a] = data[a:b]
    # the register starts as ones: as if the first four bytes were inverted
    for k in range(4):
        has = size > k
        flat[shift[has] + k] ^= 255
    reg = np.zeros(len(padded), np.uint32)
    words = padded.view("<u4")
    for t in range(0, _BLOCK // 4, 2):
        a, b = reg ^ words[:, t], words[:, t + 1]
        reg = _T[7][a & 255] ^ _T[6][a >> 8 & 255] ^ _T[5][a >> 16 & 255] ^ _T[4][a >> 24] ^ _T[3][b & 255] ^ _T[2][b >> 8 & 255] ^ _T[1][b >> 16 & 255] ^ _T[0][b >> 24]
    out = reg[first]
    for j in range(1, int(blocks.max())):
        more = np.flatnonzero(blocks > j)
        r = out[more]
        out[more] = _JUMP[0][r & 255] ^ _JUMP[1][r >> 8 & 255] ^ _JUMP[2][r >> 16 & 255] ^ _JUMP[3][r >> 24] ^ reg[first[more] + j]
    for i in np.flatnonzero(size < 4):              # too short for the inverted start
        r = 0xFFFFFFFF
        for byte in data[offsets[i]: offsets[i + 1]].tolist():
            r = r >> 8 ^ int(_T[0][(r ^ byte) & 255])
        out[i] = r
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    c = crc.astype(np.uint64)
    return ((c >> np.uint64(15) | c << np.uint64(17)) + np.uint64(_MASK) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


# ---- encoding ------------------------------------------------------------------

class _Pieces(dict):
    """Ids of pieces as bytes. A full table becomes the old one, whose entries return on use."""

    def __init__(self, library, code: str, plain: bool):
        super().__init__()
        self.library, self.code, self.old = library, code, {}
        self.model = library.model if plain else None

    def _ids(self, piece: str) -> list[int]:
        if self.model and piece.lstrip(" ").isalpha() and piece[1:2] != " ":
            # one match of the tokenizer's pattern: straight to its merges, in its alphabet for bytes
            return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(_ALPHABET))]
        return self.library.encode(piece, add_special_tokens=False).ids

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = array(self.code, self._ids(piece)).tobytes()
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        self[piece] = found
        return found


class _Words(dict):
    """Ids of words between single spaces, with the space before them if ``lead``; full tables are kept as in ``_Pieces``.

    A word of letters is one match of the tokenizer's pattern, and so is what precedes its last comma or full stop.
    """

    def __init__(self, known: _Pieces, pieces, lead: str):
        super().__init__()
        self.known, self.pieces, self.lead, self.old = known, pieces, lead, {}
        self.mark = lead.translate(_ALPHABET)

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            if word.isalpha():
                spelt = word if word.isascii() else word.encode().decode("latin-1").translate(_ALPHABET)
                found = array(self.known.code, [t.id for t in self.known.model.tokenize(self.mark + spelt)]).tobytes()
            elif word[-1] in ",." and word[:-1].isalpha():
                found = self[word[:-1]] + self.known[word[-1]]
            else:
                found = b"".join(map(self.known.__getitem__, self.pieces(self.lead + word)))
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found


def _byte_alphabet() -> dict[int, str]:
    """Byte-level BPE's characters for bytes: themselves if they are visible, else from U+0100 on in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in visible else next(others)) for b in range(256)}


_ALPHABET = _byte_alphabet()


class Encoder:
    """Token ids as little-endian bytes; pieces of text are encoded once and remembered."""

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers
        self.library = Tokenizer.from_file(path)
        code = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.kind = "<u2" if code == "H" else "<u4"
        self.end = np.array([end_id], self.kind).tobytes()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        split = self.library.pre_tokenizer
        #: other kinds than byte-level BPE get whole texts
        self.cuts = (self.library.normalizer is None and isinstance(self.library.model, models.BPE)
                     and isinstance(split, pre_tokenizers.ByteLevel) and not split.add_prefix_space)
        self.known = _Pieces(self.library, code, self.cuts)
        self.words, self.first = _Words(self.known, self.pieces, " "), _Words(self.known, self.pieces, "")

    @staticmethod
    def pieces(text: str) -> list[str]:
        """Cuts text where the tokenizer's own pattern always cuts.

        Those are the place before a space and both sides of a line feed, if their
        neighbours aren't white space, and the place between a letter and a last comma or full stop.
        """
        out: list[str] = []
        for i, line in enumerate(text.split("\n")):
            parts = line.split(" ")
            run = parts[0]
            if i:
                # the line feed stands alone between two non-spaces, else it stays inside a piece
                if run and out and not run[0].isspace() and not out[-1][-1].isspace():
                    out.append("\n")
                else:
                    run = f"{out.pop() if out else ''}\n{run}"
            for p in parts[1:]:
                if p and run and not p[0].isspace() and not run[-1].isspace():
                    if run[-1] in ",." and run[-2:-1].isalpha():
                        out += (run[:-1], run[-1])
                    else:
                        out.append(run)
                    run = " " + p
                else:
                    run = f"{run} {p}"
            if run[-1:] in (",", ".") and run[-2:-1].isalpha():
                out += (run[:-1], run[-1])
            elif run:
                out.append(run)
        return out

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text and the end id."""
        end, special = self.end, self.special
        return [(self.spaced(t) if self.cuts and not (special and special.search(t)) else self.whole(t)) + end if t else end for t in texts]

    def spaced(self, text: str) -> bytes:
        """Ids of a text without special tokens. Where single spaces and line feeds part its words, every space begins a
        piece and every line feed is one, so that whole words are looked up; other texts go piece by piece."""
        word, first, feed, out = self.words.__getitem__, self.first, self.known["\n"], []
        for line in text.split("\n"):
            words = line.split()
            if not words or " ".join(words) != line:
                return b"".join(map(self.known.__getitem__, self.pieces(text)))
            if out:
                out.append(feed)
            out.append(first[words[0]])
            out += map(word, words[1:])
        return b"".join(out)

    def whole(self, text: str) -> bytes:
        return array(self.known.code, self.library.encode(text, add_special_tokens=False).ids).tobytes()


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, end_id: int = END_ID) -> Encoder:
    """One encoder per Python worker, for all its tasks."""
    key = (path, end_id)
    if key not in _encoders:
        _encoders[key] = Encoder(path, end_id)
    return _encoders[key]


# ---- files ---------------------------------------------------------------------

def _open(path: str):
    fs, at = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))
    return fs, at


def frame(payloads: list[bytes]) -> tuple[bytes, np.ndarray]:
    """Framed records, and the offset and length of each."""
    size = np.array([len(p) for p in payloads], np.int64)
    heads = size.astype("<u8")
    crc_head = masked(crc32c(heads.view(np.uint8), np.arange(len(size) + 1) * 8))
    joined = np.frombuffer(b"".join(payloads), np.uint8)
    crc_body = masked(crc32c(joined, np.concatenate([[0], np.cumsum(size)])))
    out = b"".join([part for h, a, p, b in zip(heads, crc_head, payloads, crc_body, strict=True) for part in (h.tobytes(), a.tobytes(), p, b.tobytes())])
    total = size + 16
    return out, np.stack([np.cumsum(total) - total, total], 1)


def unframe(data: bytes) -> tuple[list[bytes], int]:
    """Whole records' payloads at the front of ``data``, checksums confirmed, and the bytes they take."""
    at, heads, payloads, sums = 0, [], [], []
    while at + 12 <= len(data):
        n, head = struct.unpack_from("<QI", data, at)
        if at + 16 + n > len(data):
            break
        heads.append((n, head))
        payloads.append(data[at + 12: at + 12 + n])
        sums.append(struct.unpack_from("<I", data, at + 12 + n)[0])
        at += 16 + n
    if payloads:
        lengths = np.array([h[0] for h in heads], "<u8")
        good = (masked(crc32c(lengths.view(np.uint8), np.arange(len(heads) + 1) * 8)) == [h[1] for h in heads]).all()
        body = np.frombuffer(b"".join(payloads), np.uint8)
        good &= (masked(crc32c(body, np.concatenate([[0], np.cumsum(lengths.astype(np.int64))]))) == sums).all()
        if not good:
            raise ValueError("a record's checksum doesn't hold")
    return payloads, at


def read_file(path: str, chunk: int = 4 << 20) -> Iterator[list[bytes]]:
    """Payloads of a data file in order, some at a time."""
    fs, at = _open(path)
    rest = b""
    with fs.open_input_stream(at) as f:
        while True:
            got = f.read(chunk)
            payloads, used = unframe(rest + got)
            rest = (rest + got)[used:]
            if payloads:
                yield payloads
            if not got:
                break
    if rest:
        raise ValueError(f"{path} ends within a record")


def read_at(path: str, numbers: list[int]) -> list[bytes]:
    """Payloads of records by their numbers in a file, by its index: for shuffled reads."""
    fs, at = _open(path)
    with fs.open_input_file(at.removesuffix(".rec") + ".idx") as f:
        index = np.frombuffer(f.read(), "<i8").reshape(-1, 2)
    with fs.open_input_file(at) as f:
        return [unframe(f.read_at(int(index[i, 1]), int(index[i, 0])))[0][0] for i in numbers]


def decode(payload: bytes, kind: str) -> tuple[int | None, np.ndarray]:
    doc_id = struct.unpack_from("<q", payload)[0]
    return None if doc_id == NULL_ID else doc_id, np.frombuffer(payload, kind, offset=8)


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes ``docs`` (doc_id, text) below ``folder``; the committed manifest table.

    Manifest: part, shard, path, records, tokens, kind (of an id). Data files in
    the order of (part, shard) hold the records in ascending order of doc_id.
    """
    spark = docs.sparkSession
    importable(spark)
    parts = n_groups(docs.select("text"), 8 << 20)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    rows = (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .withColumn("part", F.spark_partition_id()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, shard, attempt, part = encoder(tokenizer, end_id), 0, uuid.uuid4().hex[:12], 0
        queue, queued = [], 0

        def close() -> pa.RecordBatch:
            nonlocal shard, queue, queued
            data, index = frame(queue)
            path = f"{folder}/part-{part:06d}-{shard:05d}-{attempt}.rec"
            fs, at = _open(path)
            fs.create_dir(os.path.dirname(at), recursive=True)
            for name, content in ((at, data), (at.removesuffix(".rec") + ".idx", index.astype("<i8").tobytes())):
                with fs.open_output_stream(name) as f:
                    f.write(content)
            width = int(codec.kind[-1])
            row = (part, shard, path, len(queue), (queued - 8 * len(queue)) // width, codec.kind)
            shard, queue, queued = shard + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _MANIFEST_TYPES, strict=True)], names=_MANIFEST_NAMES)

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                piece = batch.slice(i, 256)
                part = piece.column(2)[0].as_py()
                for doc_id, ids in zip(piece.column(0).to_pylist(), codec.batch(piece.column(1).to_pylist()), strict=True):
                    queue.append(struct.pack("<q", NULL_ID if doc_id is None else doc_id) + ids)
                    queued += len(queue[-1])
                    if queued >= shard_bytes:
                        yield close()
        if queue:
            yield close()

    return written(rows.mapInArrow(write, _MANIFEST_DDL), "manifest")


_MANIFEST_NAMES = ["part", "shard", "path", "records", "tokens", "kind"]
_MANIFEST_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
_MANIFEST_DDL = "part int, shard int, path string, records long, tokens long, kind string"


def read_records(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record of a manifest's files.

    ``start`` counts the ids of all records before. A window over the totals of
    each part (a row per writing task) places the parts, one within a part its
    shards, and the reader the records within a shard.
    """
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    inside = F.sum("tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.join(parts, "part").select(
        "part", "path", "kind", (F.col("base") + F.coalesce(inside, F.lit(0))).alias("start"))

    def read(batches):
        for batch in batches:
            for path, kind, start in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for payloads in read_file(path):
                    rows = []
                    for p in payloads:
                        doc_id, ids = decode(p, kind)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = max(1, 4 * manifest.sparkSession.sparkContext.defaultParallelism)
    return (files.repartition(spread, F.xxhash64("path")).select("path", "kind", "start")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def production_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encode_to_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Writes ``docs`` below the shared folder and reads the records back."""
    return read_records(write_records(docs, scratch_dir(spark, "records"), production_tokenizer()))


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_to_files(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op2_token_records": op2_token_records}
ORACLES: dict[str, str] = {}
