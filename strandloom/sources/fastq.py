"""FASTQ as a Python data source (S02): plain files by byte range, block-compressed ones (gzip members that tell their size) likewise, other gzip files whole.

A record belongs to the range in which its first line begins, a line that begins exactly at a range's end to that range. So a range that isn't a file's first one skips the line it
begins in, then finds a record's first line: ``@``, with ``+`` two lines on. A line of qualities may begin with ``@`` too, but two lines on from there stands a sequence.
"""

from __future__ import annotations

import io
import os
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "name STRING, mate INT, seq STRING, qual STRING"
ARROW = pa.schema([("name", pa.string()), ("mate", pa.int32()), ("seq", pa.string()), ("qual", pa.string())])
CHUNK, ROWS = 1 << 20, 1 << 14
MEMBER = re.compile(rb"\x1f\x8b\x08\x04.{6}\x06\x00BC\x02\x00", re.DOTALL)  # fixed value: a gzip header with one extra field, the member's size
NAME = re.compile(r"@(\S+)")
COMMENT = re.compile(r"\S+\s+([12]):")


class Range(InputPartition):
    def __init__(self, uri: str, kind: str, start: int, stop: int):
        self.uri, self.kind, self.start, self.stop = uri, kind, start, stop


def _open(uri: str):
    store, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else os.path.abspath(uri))
    return store, path


def _plain(f, part: Range) -> Iterator[tuple[bytes, bool]]:
    f.seek(part.start)
    at = part.start
    while data := f.read(min(CHUNK, part.stop - at) if at < part.stop else CHUNK):
        yield data, at < part.stop
        at += len(data)


def _gzip(f, part: Range) -> Iterator[tuple[bytes, bool]]:
    left, z = b"", None
    while left or (left := f.read(CHUNK)):
        z = z or zlib.decompressobj(31)
        out = z.decompress(left, CHUNK)
        if out:
            yield out, True
        if z.eof:
            left, z = z.unused_data.lstrip(b"\0"), None
        else:
            left = z.unconsumed_tail
    if z:
        raise ValueError(f"{part.uri} ends within a gzip member")


def _first_member(f, part: Range) -> int | None:
    """The place of the first member that begins in the range: a header, with another one, or the file's end, where it says that it ends."""
    at, held = part.start, b""
    f.seek(at)
    while at - len(held) < part.stop and (data := f.read(CHUNK)):
        held += data
        at += len(data)
        for hit in MEMBER.finditer(held):
            place = at - len(held) + hit.start()
            if place >= part.stop:
                return None
            f.seek(place + 16)
            f.seek(place + struct.unpack("<H", f.read(2))[0] + 1)
            if MEMBER.match(following := f.read(18)) or not following:
                return place
        held = held[-17:]
        f.seek(at)
    return None


def _blocks(f, part: Range) -> Iterator[tuple[bytes, bool]]:
    at = _first_member(f, part)
    if at is None:
        return
    f.seek(at)
    while len(head := f.read(18)) == 18:
        size = struct.unpack("<H", head[16:18])[0] + 1
        body = f.read(size - 18)
        data = zlib.decompress(body[:-8], -15)
        if zlib.crc32(data) != struct.unpack("<I", body[-8:-4])[0]:
            raise ValueError(f"{part.uri}: the member at {at} doesn't match its checksum")
        yield data, at < part.stop
        at += size


def _lines(chunks: Iterator[tuple[bytes, bool]]) -> Iterator[tuple[bool, bytes]]:
    """Lines, and whether each one begins in the range or at its end."""
    held, begins, end = [], 0, 0
    at = 0
    for data, inside in chunks:
        end += len(data) if inside else 0
        lines = data.split(b"\n")
        for line in lines[:-1]:
            whole = b"".join([*held, line])
            held = []
            yield begins <= end, whole.removesuffix(b"\r")
            begins += len(whole) + 1
        held.append(lines[-1])
        at += len(data)
    if at > begins:
        yield begins <= end, b"".join(held).removesuffix(b"\r")


def _records(part: Range) -> Iterator[list[bytes]]:
    """The lines of each record of a range, four, or fewer where a file ends."""
    store, path = _open(part.uri)
    with io.BufferedReader(store.open_input_file(path), CHUNK) as f:
        lines = _lines({"plain": _plain, "gzip": _gzip, "blocks": _blocks}[part.kind](f, part))
        ahead: list[tuple[bool, bytes]] = []
        if part.start:
            next(lines, None)
            ahead = [x for _, x in zip(range(3), lines, strict=False)]
            while len(ahead) == 3 and ahead[0][0] and not (ahead[0][1].startswith(b"@") and ahead[2][1].startswith(b"+")):
                ahead = ahead[1:] + [x for x in [next(lines, None)] if x]
            if len(ahead) < 3:
                return
        while True:
            while len(ahead) < 4 and (x := next(lines, None)):
                ahead.append(x)
            if not ahead or not ahead[0][0]:
                return
            yield [x for _, x in ahead]
            ahead = []


def _parsed(record: list[bytes]) -> tuple[str, int | None, str, str] | None:
    """A clean record's columns, as ``formats.fastq`` has them."""
    if len(record) < 4 or record[0][:1] != b"@" or record[2][:1] != b"+" or not record[1] or len(record[1]) != len(record[3]) or not record[3].strip():
        return None
    head, seq, _, qual = (x.decode("utf-8", "replace") for x in record)
    found = NAME.match(head)
    name = found[1] if found else ""
    if name.endswith(("/1", "/2")):
        return name[:-2], int(name[-1]), seq, qual
    mate = COMMENT.match(head)
    return name, int(mate[1]) if mate else None, seq, qual


class FastqReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("split", 64 << 20))
        self.ignore = options.get("ignoredirty", "true").lower() == "true"

    def partitions(self) -> list[Range]:
        store, path = _open(self.path)
        info = store.get_file_info(path)
        files = [info] if info.is_file else [x for x in store.get_file_info(fs.FileSelector(path)) if x.is_file and x.base_name[0] not in "._"]
        out = []
        for file in sorted(files, key=lambda x: x.path):
            uri, kind = self.path if info.is_file else f"{self.path.rstrip('/')}/{file.base_name}", "plain"
            if file.extension in ("gz", "bgz", "bgzf"):
                with store.open_input_file(file.path) as f:
                    kind = "blocks" if MEMBER.match(f.read(18)) else "gzip"
            step = self.split if kind != "gzip" else max(file.size, 1)
            out += [Range(uri, kind, at, min(at + step, file.size)) for at in range(0, file.size, step)]
        return out or [Range("", "none", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        rows = []
        for record in _records(partition) if partition.uri else ():
            row = _parsed(record)
            if row:
                rows.append(row)
            elif not self.ignore and any(record):
                raise ValueError(f"dirty record: {record[0].decode('utf-8', 'replace')}")
            if len(rows) == ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


class FastqSource(DataSource):
    """``spark.read.format("fastq").load(path)`` of a file or a folder. Options: ``split``, bytes a task (64 MB); ``ignoreDirty`` (true), leave dirty records out or fail."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader(self.options)


def fastq(spark: SparkSession, path: str, split: int = 64 << 20, ignore_dirty: bool = True) -> DataFrame:
    """(name, mate, seq, qual) as ``formats.fastq`` gives them for files of four-line records, also from block-compressed files in parallel."""
    spark.dataSource.register(FastqSource)
    return spark.read.format("fastq").option("split", str(split)).option("ignoreDirty", str(ignore_dirty).lower()).load(path)
