"""Media columns: the Ogg container (RFC 3533), written and read by Arrow batches.

``mux`` builds one physical stream of two logical streams; ``demux`` verifies every page's
checksum, reassembles packets from lacing values (across pages), separates the logical
streams by serial number and derives packet times from granule positions.

A null, an empty or a damaged value never fails: pages whose checksum is wrong and bytes that
belong to no page are skipped and counted, packets that miss a part are dropped and counted.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import common

CAPTURE = b"OggS"
CONTINUED, FIRST, LAST = 1, 2, 4
HEADER = struct.Struct("<4sBBqIIIB")  # capture, version, flags, granule, serial, page number, checksum, segments
NO_GRANULE = -1
FRAME = 576  # samples of a frame; payloads are padded to a multiple of it
FRAMES_PER_PACKET = 8
RATE = 8000
SAMPLES, INFO = 1, 2  # serial numbers of the two logical streams
PCM_ID, INFO_ID = b"pcm-u8\0", b"srcinfo"
_ID_HEADER = struct.Struct("<7sIIB")

_REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def page_checksum(page: bytes) -> int:
    """CRC-32 of polynomial 0x04c11db7, no reflection, start and end value 0. zlib's CRC is the
    reflected form of the same polynomial: bits are reversed on the way in and out."""
    raw = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(raw.to_bytes(4, "little").translate(_REVERSED), "big")


def build_page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = HEADER.pack(CAPTURE, 0, flags, granule, serial, number, 0, len(lacing)) + lacing
    page = head + body
    return page[:22] + struct.pack("<I", page_checksum(page)) + page[26:]


def lacing_values(size: int) -> bytes:
    return b"\xff" * (size // 255) + bytes([size % 255])


def stream_pages(serial: int, packets: Iterable[tuple[bytes, int]], lone_first: bool = True) -> list[bytes]:
    """Pages of one logical stream from (packet, granule position at its end)."""
    todo = list(packets)
    pages: list[tuple[int, int, bytes, bytes]] = []
    lacing, body, granule, continued = bytearray(), [], NO_GRANULE, False

    def flush(next_continued: bool) -> None:
        nonlocal lacing, body, granule, continued
        pages.append((CONTINUED * continued, granule, bytes(lacing), b"".join(body)))
        lacing, body, granule, continued = bytearray(), [], NO_GRANULE, next_continued

    for k, (packet, at) in enumerate(todo):
        values, done = lacing_values(len(packet)), 0
        while done < len(values):
            room = 255 - len(lacing)
            take = values[done : done + room]
            body.append(packet[done * 255 : done * 255 + sum(take)])
            lacing += take
            done += len(take)
            if done == len(values):
                granule = at
            if len(lacing) == 255:
                flush(done < len(values))
        if k == 0 and lone_first and lacing:
            flush(False)
    if lacing:
        flush(False)
    out = []
    for number, (flags, at, values, data) in enumerate(pages):
        flags |= FIRST * (number == 0) | LAST * (number == len(pages) - 1)
        out.append(build_page(flags, at, serial, number, values, data))
    return out


def mux(payload: bytes, note: bytes) -> bytes:
    """payload as 8-bit samples in one logical stream, note in another. First pages come first,
    as the format demands; the other pages of the two streams alternate."""
    step = FRAME * FRAMES_PER_PACKET
    packets = [(_ID_HEADER.pack(PCM_ID, RATE, FRAME, 1), 0)]
    packets += [(payload[i : i + step], min(i + step, len(payload))) for i in range(0, len(payload), step)]
    samples = stream_pages(SAMPLES, packets)
    info = stream_pages(INFO, [(_ID_HEADER.pack(INFO_ID, 1, 0, 0), 0), (note, 1)])
    pages = [samples[0], info[0]]
    for k in range(1, max(len(samples), len(info))):
        pages += samples[k : k + 1] + info[k : k + 1]
    return b"".join(pages)


@dataclass
class Stream:
    """One logical stream as it was read."""

    serial: int
    packets: list[bytes] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)  # granule position at the packet's end, or -1
    pages: int = 0
    lost: int = 0  # packets that miss a part, and gaps in page numbers
    ended: bool = False
    _part: list[bytes] | None = None
    _next: int | None = None

    def add(self, flags: int, granule: int, number: int, lacing: bytes, body: bytes) -> None:
        gap = self._next is not None and number != self._next
        if gap:
            self.lost += 1
            self._part = None
        continued = bool(flags & CONTINUED)
        skip = continued and self._part is None  # its beginning isn't here
        if not continued and self._part is not None:
            self.lost += 1
        part = self._part if continued and self._part is not None else []
        at, first = 0, len(self.packets)
        start = 0
        for value in lacing:
            at += value
            if value < 255:
                if skip:
                    skip = False
                    self.lost += not gap
                else:
                    part.append(body[start:at])
                    self.packets.append(b"".join(part))
                    self.ends.append(NO_GRANULE)
                part, start = [], at
        if start < at or lacing[-1:] == b"\xff":
            self._part = None if skip else [*part, body[start:at]]
        else:
            self._part = None
        if granule != NO_GRANULE and len(self.packets) > first:
            self.ends[-1] = granule  # the page's granule position belongs to the last packet that ends on it
        self.pages += 1
        self._next = number + 1
        self.ended |= bool(flags & LAST)


@dataclass
class Reading:
    streams: dict[int, Stream]
    bad_pages: int = 0
    skipped_bytes: int = 0


def demux(media: bytes | None) -> Reading:
    """All logical streams of a physical stream, by serial number."""
    out = Reading({})
    data, at = media or b"", 0
    while at < len(data):
        found = data.find(CAPTURE, at)
        if found < 0:
            out.skipped_bytes += len(data) - at
            break
        out.skipped_bytes += found - at
        at = found
        if len(data) - at < HEADER.size:
            out.skipped_bytes += len(data) - at
            break
        _, version, flags, granule, serial, number, crc, segments = HEADER.unpack_from(data, at)
        table_end = at + HEADER.size + segments
        lacing = data[at + HEADER.size : table_end]
        end = table_end + sum(lacing)
        page = data[at:end]
        if version or len(lacing) < segments or end > len(data) or page_checksum(page[:22] + b"\0\0\0\0" + page[26:]) != crc:
            out.bad_pages += 1
            out.skipped_bytes += 4
            at += 4
            continue
        out.streams.setdefault(serial, Stream(serial)).add(flags, granule, number, lacing, data[table_end:end])
        at = end
    return out


def packet_times(stream: Stream, rate: int) -> list[tuple[float, float] | None]:
    """(start, end) in seconds of each data packet. Where a page ends several packets, only the
    last has a granule position; the others follow from their sizes, counted backwards."""
    times: list[tuple[float, float] | None] = [None] * len(stream.packets)
    end: int | None = None
    for k in range(len(stream.packets) - 1, 0, -1):
        if stream.ends[k] != NO_GRANULE:
            end = stream.ends[k]
        if end is not None:
            start = end - len(stream.packets[k])
            times[k] = (start / rate, end / rate)
            end = start
    return times


def read_payload(media: bytes | None) -> tuple[bytes, bytes, Reading, list]:
    """(samples, note, reading, times) of what ``mux`` made."""
    reading = demux(media)
    samples, note, times = b"", b"", []
    for stream in reading.streams.values():
        if not stream.packets:
            continue
        head = stream.packets[0]
        if head[:7] == PCM_ID and len(head) == _ID_HEADER.size:
            samples = b"".join(stream.packets[1:])
            times = packet_times(stream, _ID_HEADER.unpack(head)[1])
        elif head[:7] == INFO_ID:
            note = b"".join(stream.packets[1:])
    return samples, note, reading, times


def features(samples: bytes, reading: Reading, times: list) -> str:
    """Counts of the container, the length in seconds and plain measures of the signal."""
    x = np.frombuffer(samples, np.uint8)
    high = x >= 128
    crossings = int(np.count_nonzero(high[1:] != high[:-1]))
    seconds = max((t[1] for t in times if t), default=0.0)
    streams = reading.streams.values()
    return (
        f"streams={len(streams)};pages={sum(s.pages for s in streams)};packets={sum(len(s.packets) for s in streams)}"
        f";bad={reading.bad_pages};lost={sum(s.lost for s in streams)};seconds={seconds:.4f}"
        f";sum={int(x.sum(dtype=np.int64))};peak={int(x.max()) if len(x) else 0};crossings={crossings}"
    )


def pad(data: bytes) -> bytes:
    """data and bytes 255 up to a positive multiple of FRAME."""
    return data + b"\xff" * (max(FRAME, -(-len(data) // FRAME) * FRAME) - len(data))


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, media binary): each whole text as an Ogg stream. A null text is stored as an empty one."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            media = []
            for text in b.column(1):
                data = text.as_py().encode()
                media.append(mux(pad(data), struct.pack("<Q", len(data))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(media, pa.binary())], ["id", "media"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), common.text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(encode, f"id {kind}, media binary")


_DIGEST = pa.schema(
    [("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()),
     ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
)


def digest_media(df: DataFrame, id_name: str = "doc_id") -> DataFrame:
    """From (id, media): what the stored bytes hold, with checksums and features. n_bytes comes from
    the second logical stream; it is null where that stream can't be read."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            rows = []
            for value in b.column(1):
                media = value.as_py() or b""
                samples, note, reading, times = read_payload(media)
                rows.append((
                    struct.unpack("<Q", note)[0] if len(note) == 8 else None, len(samples), hashlib.sha256(samples).hexdigest(),
                    zlib.crc32(samples[-32:]), len(media), hashlib.sha256(media).hexdigest(), features(samples, reading, times),
                ))
            cols = list(zip(*rows, strict=True)) or [()] * len(_DIGEST)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, f.type) for c, f in zip(cols, _DIGEST, strict=True))], ["id", *_DIGEST.names])

    kind = df.schema["id"].dataType.simpleString()
    out = df.mapInArrow(read, f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    return out.withColumnRenamed("id", id_name)


def rate_of(stream: Stream, rate: int | None = None) -> int | None:
    """Granules a second: what the stream's own header says if its packets are samples; else ``rate``, as the unit of other granule positions is their codec's."""
    head = stream.packets[0] if stream.packets else b""
    return _ID_HEADER.unpack(head)[1] or rate if head[:7] == PCM_ID and len(head) == _ID_HEADER.size else rate


def packets(df: DataFrame, id_col: str, media_col: str, rate: int | None = None) -> DataFrame:
    """One row per packet of every logical stream: id, serial, packet (0 is the header), granule at its
    end (null if its page doesn't tell), start_s and end_s (null for headers, and for streams whose rate neither
    their header nor ``rate`` tells), size, data. A null or unreadable value gives no rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.slices(batches):
            cols: list[list] = [[] for _ in range(8)]
            for key, value in zip(b.column(0), b.column(1), strict=True):
                for serial, stream in sorted(demux(value.as_py()).streams.items()):
                    of = rate_of(stream, rate)
                    times = packet_times(stream, of) if of else [None] * len(stream.packets)
                    for k, packet in enumerate(stream.packets):
                        granule = stream.ends[k]
                        row = (key.as_py(), serial, k, None if granule == NO_GRANULE else granule, *(times[k] or (None, None)), len(packet), packet)
                        for c, v in zip(cols, row, strict=True):
                            c.append(v)
            kinds = [b.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["id", "serial", "packet", "granule", "start_s", "end_s", "size", "data"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(media_col).alias("media")).mapInArrow(
        read, f"id {kind}, serial long, packet long, granule long, start_s double, end_s double, size long, data binary"
    )


def op1(spark, sf_dir: str) -> DataFrame:
    """Every text of documents stored as Ogg, read back and digested."""
    return digest_media(encode_texts(common.table(spark, sf_dir, "documents")))
