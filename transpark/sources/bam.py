"""Binary alignments as a Spark data source: split reads, region reads, and a sink.

A file is a row of compressed blocks, each of which tells its size, around a stream of records. A split
is a range of the file's bytes and has the records that start in its blocks. Its first block is found by
its magic and by the block that follows where it says; the first record by records that follow one
another. With an index (.bai) a filter on ``ref`` reads the blocks of that reference only.
"""

from __future__ import annotations

import gzip
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, InputPartition, WriterCommitMessage

from transpark.plans.storage import ship_by_value

SCHEMA = "read string, flag int, ref string, pos int, mapq int, cigar string, seq_len int, sa string"
TYPES = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string()]
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
#: Fixed values of the format: CIGAR operations by code, sizes of tag types, heads of blocks, the last
#: block, the bin that isn't one, bases of a window of the linear index.
OPS, TAG_SIZES = "MIDNSHP=X", {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
MAGIC, HEAD = b"\x1f\x8b\x08\x04", 18
LAST = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
NO_BIN, WINDOW = 37450, 14
BLOCK, SPLIT_BYTES, CHAIN, ROWS = 0xFF00, 32_000_000, 5, 10_000


def opened(path: str) -> tuple[files.FileSystem, str]:
    """The file system of a path, and the path in it."""
    return files.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (files.LocalFileSystem(), path)


def listed(path: str) -> list[tuple[str, int]]:
    """The alignment files at a path, or below it, with their sizes."""
    store, inner = opened(path)
    info = store.get_file_info(inner)
    found = [info] if info.is_file else store.get_file_info(files.FileSelector(inner, recursive=True))
    scheme = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    return sorted((scheme + f.path, f.size) for f in found if f.is_file and (info.is_file or f.base_name.endswith(".bam") and not f.base_name.startswith(("_", "."))))


class Blocks:
    """The blocks of a file, read one after another."""

    def __init__(self, path: str):
        store, inner = opened(path)
        self.file = store.open_input_file(inner)
        self.size = self.file.size()

    def _head(self, at: int) -> int | None:
        """Bytes of the block that starts there; None if there is none."""
        head = self.file.read_at(HEAD, at) if at + HEAD <= self.size else b""
        return int.from_bytes(head[16:18], "little") + 1 if head[:4] == MAGIC and head[12:16] == b"BC\x02\x00" else None

    def blocked(self) -> bool:
        return self._head(0) is not None

    def read(self, at: int) -> tuple[bytes, int] | None:
        """A block's data, and where the next one starts; None at the end of the file."""
        if at >= self.size:
            return None
        size = self._head(at)
        if size is None:
            raise ValueError(f"no block at {at}")
        return zlib.decompress(self.file.read_at(size - HEAD - 8, at + HEAD), -15), at + size

    def first(self, at: int) -> int | None:
        """Where the first block at or after ``at`` starts: magic may stand inside of blocks too, but then
        no block follows it where it should."""
        window = self.file.read_at(min(3 << 16, self.size - at), at)
        found = window.find(MAGIC)
        while found >= 0:
            size = self._head(at + found)
            if size is not None and (at + found + size == self.size or self._head(at + found + size) is not None):
                return at + found
            found = window.find(MAGIC, found + 1)
        return None


class Stream:
    """Decompressed data from a block on, which knows the block that each byte is of."""

    def __init__(self, blocks: Blocks, at: int, limit: int | None = None):
        self.blocks, self.next, self.data, self.starts, self.ended = blocks, at, b"", [], False
        self.limit = limit  # no block from here on is read

    def fill(self, n: int) -> bool:
        """Read on until there are n bytes; whether there are."""
        while len(self.data) < n and not self.ended:
            got = None if self.limit is not None and self.next >= self.limit else self.blocks.read(self.next)
            if got is None:
                self.ended = True
                break
            self.starts.append((len(self.data), self.next))
            self.data, self.next = self.data + got[0], got[1]
        return len(self.data) >= n

    def block_of(self, place: int) -> int:
        return next((b for p, b in reversed(self.starts) if p <= place), self.next) if place < len(self.data) else self.next

    def drop(self, n: int) -> None:
        """Forget the first n bytes."""
        kept = [(p - n, b) for p, b in self.starts]
        self.starts = kept[max([i for i, (p, _) in enumerate(kept) if p <= 0], default=0) :]
        self.data = self.data[n:]


def _references(stream) -> list[tuple[str, int]]:
    """Names and lengths of the references, from a stream's ``read``."""
    number = lambda: int.from_bytes(stream(4), "little", signed=True)
    if stream(4) != b"BAM\1":
        raise ValueError("no binary alignments")
    stream(number())
    return [(stream(number())[:-1].decode(), number()) for _ in range(number())]


def header(path: str) -> tuple[list[tuple[str, int]], Stream | None]:
    """References of a file, and the stream of its records; None if the file has no blocks."""
    blocks = Blocks(path)
    if not blocks.blocked():
        blocks.file.seek(0)
        with gzip.GzipFile(fileobj=blocks.file) as plain:
            return _references(plain.read), None
    stream, at = Stream(blocks, 0), 0

    def read(n: int) -> bytes:
        nonlocal at
        if not stream.fill(at + n):
            raise ValueError("the header ends early")
        at += n
        return stream.data[at - n : at]

    refs = _references(read)
    stream.drop(at)
    return refs, stream


def _tag(data: bytes, at: int, wanted: bytes) -> str:
    """The text of a tag among those from ``at`` on; empty if there is none."""
    while at + 3 <= len(data):
        name, kind = data[at : at + 2], chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            if name == wanted:
                return data[at:end].decode()
            at = end + 1
        elif kind == "B":
            at += 5 + TAG_SIZES[chr(data[at])] * int.from_bytes(data[at + 1 : at + 5], "little")
        else:
            at += TAG_SIZES[kind]
    return ""


def _row(data: bytes, refs: list[tuple[str, int]]) -> tuple:
    ref, pos, name_len, mapq, _, n_ops, flag, n_bases = struct.unpack_from("<iiBBHHHi", data)
    at = 32 + name_len
    ops = struct.unpack_from(f"<{n_ops}I", data, at)
    tags = at + 4 * n_ops + (n_bases + 1) // 2 + n_bases
    return data[32 : at - 1].decode(), flag, refs[ref][0] if ref >= 0 else "*", pos + 1, mapq, "".join(f"{x >> 4}{OPS[x & 15]}" for x in ops) or "*", n_bases, _tag(data, tags, b"SA")


def _follows(stream: Stream, at: int, n_refs: int) -> int | None:
    """Where the record that may start there ends; None if none can."""
    if not stream.fill(at + 36):
        return None
    size, ref, pos, name_len, _, _, n_ops, _, n_bases, mate, mate_pos = struct.unpack_from("<iiiBBHHHiii", stream.data, at)
    body = 32 + name_len + 4 * n_ops + (n_bases + 1) // 2 + n_bases
    if not (body <= size < 1 << 28 and -1 <= ref < n_refs and -1 <= mate < n_refs and pos >= -1 and mate_pos >= -1 and name_len > 0 and n_bases >= 0):
        return None
    if not stream.fill(at + 36 + name_len + 4 * n_ops):
        return None
    name, ops = stream.data[at + 36 : at + 36 + name_len], stream.data[at + 36 + name_len : at + 36 + name_len + 4 * n_ops : 4]
    good = name[-1] == 0 and all(33 <= c <= 126 for c in name[:-1]) and all(c & 15 < len(OPS) for c in ops)
    return at + 4 + size if good else None


def _first_record(stream: Stream, end: int, n_refs: int) -> int | None:
    """Where the first record starts in the stream's blocks before ``end``: CHAIN records follow one
    another from there, or as many as are left."""
    at = 0
    while stream.fill(at + 1) and stream.block_of(at) < end:
        here, seen = _follows(stream, at, n_refs), 1
        while here is not None and seen < CHAIN and stream.fill(here + 36):
            here, seen = _follows(stream, here, n_refs), seen + 1
        if here is not None:
            return at
        at += 1
    return None


@dataclass
class Split(InputPartition):
    path: str
    start: int
    end: int
    at: int | None = None  # a virtual offset that a record starts at
    limit: int | None = None  # where the blocks of a region end


def records(split: Split) -> Iterator[tuple]:
    """The records that start in a split's blocks."""
    refs, stream = header(split.path)
    if stream is None:  # no blocks to tell apart: the file is one split's
        with gzip.GzipFile(fileobj=Blocks(split.path).file) as plain:
            _references(plain.read)
            while size := plain.read(4):
                yield _row(plain.read(int.from_bytes(size, "little")), refs)
        return
    blocks = stream.blocks
    if split.at is not None:
        stream = Stream(blocks, split.at >> 16, split.limit)
        stream.fill((split.at & 0xFFFF) + 1)
        stream.drop(split.at & 0xFFFF)
    elif split.start > 0:
        block = blocks.first(split.start)
        if block is None or block >= split.end:
            return
        stream = Stream(blocks, block, split.limit)
        at = _first_record(stream, split.end, len(refs))
        if at is None:
            return
        stream.drop(at)
    at = 0
    while stream.block_of(at) < split.end and stream.fill(at + 4):
        size = int.from_bytes(stream.data[at : at + 4], "little")
        if not stream.fill(at + 4 + size):
            if split.limit is not None:  # one of the next reference
                return
            raise ValueError("a record ends early")
        yield _row(stream.data[at + 4 : at + 4 + size], refs)
        at += 4 + size
        if at > 1 << 20:
            stream.drop(at)
            at = 0


def index_range(path: str, ref: int) -> tuple[int, int] | None:
    """Virtual offsets of a reference's first record and of the end of its last one, by the index."""
    store, inner = opened(path)
    found = next((p for p in (f"{inner}.bai", inner.removesuffix(".bam") + ".bai") if store.get_file_info(p).is_file), None)
    if found is None:
        return None
    with store.open_input_stream(found) as f:
        data = f.read()
    if data[:4] != b"BAI\1":
        raise ValueError(f"no index: {found}")
    at, (n_refs,) = 8, struct.unpack_from("<i", data, 4)
    for r in range(n_refs):
        (bins,) = struct.unpack_from("<i", data, at)
        at, chunks = at + 4, []
        for _ in range(bins):
            number, n = struct.unpack_from("<Ii", data, at)
            if number != NO_BIN:
                chunks += struct.unpack_from(f"<{2 * n}Q", data, at + 8)
            at += 8 + 16 * n
        at += 4 + 8 * struct.unpack_from("<i", data, at)[0]
        if r == ref:
            return (min(chunks), max(chunks)) if chunks else (0, 0)
    return 0, 0


class Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.ref, self.bytes = options["path"], options.get("ref"), int(options.get("splitbytes", SPLIT_BYTES))

    def partitions(self) -> list[Split]:
        return [s for path, size in listed(self.path) for s in self._splits(path, size)]

    def _splits(self, path: str, size: int) -> Iterator[Split]:
        low, high, at, limit = 0, size, None, None
        if not Blocks(path).blocked():
            yield Split(path, 0, size)
            return
        if self.ref is not None and self.ref != "*":
            names = [n for n, _ in header(path)[0]]
            if self.ref not in names:
                return
            found = index_range(path, names.index(self.ref))
            if found == (0, 0):
                return
            if found is not None:
                at, low, high = found[0], found[0] >> 16, (found[1] >> 16) + 1
                limit = high
        for start in range(low, high, self.bytes):
            yield Split(path, start, min(start + self.bytes, high), at if start == low else None, limit)

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in records(split):
            if self.ref is None or row[2] == self.ref:
                rows.append(row)
            if len(rows) >= ROWS:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)


class PushingReader(Reader):
    """For sessions that push filters to Python sources; others refuse a reader that takes them."""

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("ref",):
                self.ref = f.value
            yield f  # blocks hold other references too: Spark filters their rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], names=NAMES)


def _bin(start: int, end: int) -> int:
    """The smallest bin that holds [start, end)."""
    for level, shift in enumerate((14, 17, 20, 23, 26)):
        if start >> shift == (end - 1) >> shift:
            return ((1 << 3 * (5 - level)) - 1) // 7 + (start >> shift)
    return 0


class Output:
    """A file that is written record by record, and its index."""

    def __init__(self, stream, refs: list[tuple[str, int]]):
        self.out, self.place, self.data = stream, 0, b""
        self.refs = {n: i for i, (n, _) in enumerate(refs)}
        self.bins: list[dict[int, list]] = [{} for _ in refs]
        self.windows: list[dict[int, int]] = [{} for _ in refs]
        self.ordered, self.last = True, (-1, -1)
        text = "".join(f"@SQ\tSN:{n}\tLN:{length}\n" for n, length in refs).encode()
        self._add(b"BAM\1" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(refs)))
        for n, length in refs:
            self._add(struct.pack("<i", len(n.encode()) + 1) + n.encode() + b"\0" + struct.pack("<i", length))
        self._flush(1)

    def _add(self, data: bytes) -> None:
        self.data += data
        self._flush(BLOCK)

    def _flush(self, least: int) -> None:
        while len(self.data) >= least and self.data:
            part, self.data = self.data[:BLOCK], self.data[BLOCK:]
            packer = zlib.compressobj(6, zlib.DEFLATED, -15)
            body = packer.compress(part) + packer.flush()
            block = MAGIC + bytes(5) + b"\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + HEAD + 7) + body + struct.pack("<II", zlib.crc32(part), len(part))
            self.out.write(block)
            self.place += len(block)

    def _here(self) -> int:
        return self.place << 16 | len(self.data)

    def write(self, read: str, flag: int, ref: str, pos: int, mapq: int, cigar: str, seq_len: int, sa: str) -> None:
        ops = []
        number = ""
        for c in "" if cigar == "*" else cigar:
            if c.isdigit():
                number += c
            else:
                ops.append((int(number), OPS.index(c)))
                number = ""
        at, start = self.refs.get(ref, -1), pos - 1
        end = start + max(1, sum(n for n, op in ops if OPS[op] in "MDN=X"))
        tags = b"SAZ" + sa.encode() + b"\0" if sa else b""
        body = struct.pack("<iiBBHHHiiii", at, start, len(read.encode()) + 1, mapq, _bin(max(start, 0), max(end, 1)), len(ops), flag, seq_len, -1, -1, 0) + read.encode() + b"\0"
        body += b"".join(struct.pack("<I", n << 4 | op) for n, op in ops) + b"\xff" * ((seq_len + 1) // 2) + b"\xff" * seq_len + tags
        before = self._here()
        self._add(struct.pack("<i", len(body)) + body)
        key = (at if at >= 0 else len(self.refs), start)
        self.ordered, self.last = self.ordered and key >= self.last, key
        if at >= 0:
            chunks = self.bins[at].setdefault(_bin(start, end), [])
            if chunks and chunks[-1][1] == before:
                chunks[-1][1] = self._here()
            else:
                chunks.append([before, self._here()])
            for w in range(start >> WINDOW, ((end - 1) >> WINDOW) + 1):
                self.windows[at].setdefault(w, before)

    def close(self) -> bytes | None:
        """Finish the file; its index, if records came in order."""
        self._flush(1)
        self.out.write(LAST)
        if not self.ordered:
            return None
        out = b"BAI\1" + struct.pack("<i", len(self.refs))
        for bins, windows in zip(self.bins, self.windows, strict=True):
            out += struct.pack("<i", len(bins))
            for number, chunks in sorted(bins.items()):
                out += struct.pack("<Ii", number, len(chunks)) + b"".join(struct.pack("<QQ", *c) for c in chunks)
            n, last = max(windows, default=-1) + 1, 0
            line = [last := windows.get(w, last) for w in range(n)]
            out += struct.pack(f"<i{n}Q", n, *line)
        return out


@dataclass
class Written(WriterCommitMessage):
    made: list[tuple[str, str]]  # a file's name while it is written, and its own


class Writer(DataSourceWriter):
    def __init__(self, options: dict):
        self.path, self.refs = options["path"], [tuple(x) for x in json.loads(options["references"])]

    def write(self, rows: Iterator) -> Written:
        store, inner = opened(self.path)
        store.create_dir(inner, recursive=True)
        name, made = uuid.uuid4().hex, []
        with store.open_output_stream(f"{inner}/_{name}.bam", compression=None) as stream:
            out = Output(stream, self.refs)
            for r in rows:
                out.write(*(r[c] for c in NAMES))
            index = out.close()
        made.append((f"{inner}/_{name}.bam", f"{inner}/part-{name}.bam"))
        if index is not None:
            with store.open_output_stream(f"{inner}/_{name}.bai", compression=None) as stream:
                stream.write(index)
            made.append((f"{inner}/_{name}.bai", f"{inner}/part-{name}.bam.bai"))
        return Written(made)

    def commit(self, messages: list) -> None:
        """Only files of tasks that came through get names that are read."""
        store, _ = opened(self.path)
        for m in messages:
            for old, new in m.made if m else ():
                store.move(old, new)

    def abort(self, messages: list) -> None:
        store, _ = opened(self.path)
        for m in messages:
            for old, _ in m.made if m else ():
                store.delete_file(old)


class Alignments(DataSource):
    """``path``; reading: ``ref`` (that reference only), ``splitBytes``, ``pushFilters`` (as the session's
    spark.sql.python.filterPushdown.enabled); writing: ``references``, as JSON pairs of name and length."""

    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        options = {k.lower(): v for k, v in self.options.items()}
        return PushingReader(options) if options.get("pushfilters") == "true" else Reader(options)

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer({k.lower(): v for k, v in self.options.items()})


def read_bam(spark: SparkSession, path: str, ref: str | None = None, split_bytes: int = SPLIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """(alignments, references) of binary alignment files, as ``read_sam`` has them but for nth.

    Files are split by bytes where they are made of blocks; others (plain gzip) are one task's. ``ref``
    reads the blocks of a reference only where a file has an index. A filter on the column ref does the
    same if spark.sql.python.filterPushdown.enabled is set.
    """
    spark.dataSource.register(Alignments)
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    read = spark.read.format("bam").option("splitBytes", str(split_bytes)).option("pushFilters", pushed)
    data = (read if ref is None else read.option("ref", ref)).load(path)
    paths = spark.createDataFrame([(p,) for p, _ in listed(path)], "path string")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs = [r for p in batch.column(0) for r in header(p.as_py())[0]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in refs], t) for i, t in enumerate((pa.string(), pa.int32()))], names=["ref", "length"])

    return data, paths.mapInArrow(kernel, "ref string, length int").distinct()


def write_bam(alignments: DataFrame, path: str, references: list[tuple[str, int]]) -> None:
    """Alignments (the columns of ``SCHEMA``) as files at path, one a partition, with an index for those
    whose records are in order of reference and place. Bases and qualities are left open."""
    alignments.sparkSession.dataSource.register(Alignments)
    alignments.select(*NAMES).write.format("bam").mode("append").option("references", json.dumps(references)).save(path)


ship_by_value(__name__)
