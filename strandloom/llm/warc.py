"""WARC archives with a two-level capture index.

``write_archives`` writes a record a page, each a gzip member of its own, into files of the shared
folder: a response, or a revisit of the page with the same payload and the largest id. ``build_index``
sorts the captures by reversed-host URL key and writes them as compressed blocks, a file a range of
keys, each with a sparse directory of its blocks. ``look_up`` finds captures: a binary search over the
files' first keys (as many as there are partitions), one over the file's directory, one in the
block; then it reads just the record's bytes.

Files are written once under names of their own, so a task that runs again leaves at most a file
that no index names. A null html is an empty payload; a null url has the key ``)``. Captures
with the same url are told apart by id; a null id is kept and comes back as null. Rows that share
both id and payload are all responses.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import io
import json
import struct
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm import common, places

LEVEL = 4
FILE_BYTES = 1 << 30
BLOCK_ENTRIES = 1000
NO_ID = -(1 << 63)
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FOOTER = struct.Struct("<8sQQ")
_MAGIC = b"capidx01"
BATCH = 256


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC record. A revisit keeps the HTTP header of the response, its length included, but no payload."""
    target = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _page(value: str | None) -> int | None:
    digits = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def parse(data: bytes) -> dict:
    """A record's type, ids, target, payload (None for revisits), its length and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = _fields(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    out = {"type": warc["warc-type"], "page_id": _page(warc.get("warc-record-id")), "url": warc.get("warc-target-uri"), "refers_to": _page(warc.get("warc-refers-to"))}
    if warc["warc-type"] == "revisit":
        return out | {"payload": None, "size": int(_fields(http)["content-length"]), "digest": warc["warc-payload-digest"].removeprefix("sha1:")}
    found = digest_of(payload)
    if warc["warc-payload-digest"] != f"sha1:{found}":
        raise ValueError(f"payload of {warc.get('warc-record-id')} doesn't have its digest")
    return out | {"payload": payload, "size": len(payload), "digest": found}


def url_key(url: Column) -> Column:
    """Reversed host, then path and query: com,example,www)/path?query."""
    rest = F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^(?:[^/?#@]*@)?([^/?#:]*)", 1))
    tail = F.regexp_extract(rest, r"^[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail)


def _rows(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _payloads(rows: DataFrame, least: int) -> DataFrame:
    """(place, sha, keep, n): the different payloads of at least ``least`` bytes of each input file, the largest id of each, and how many rows have it."""
    sha = F.unhex(F.sha1(F.col("html").cast("binary")))
    some = rows.select(places.input_place().alias("place"), "id", sha.alias("sha"), F.octet_length("html").alias("size")).where(F.col("size") >= least)
    return some.groupBy("place", "sha").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n"))


def _save_repeats(payloads: DataFrame, folder: str) -> None:
    """For each input file those of its payloads that rows of any file share, with the largest id of all: a payload counts once a file here, however many rows have it, so none is a
    hot key, and only digests move."""
    again = payloads.groupBy("sha").agg(F.max("keep").alias("last"), F.sum("n").alias("rows")).where("rows > 1 AND last IS NOT NULL").select("sha", "last")
    shared = payloads.select("place", "sha").join(again, "sha").select("place", "sha", "last")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for b in batches:
            found: dict[int, list] = {}
            for place, sha, last in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found.setdefault(place, []).append(sha + struct.pack("<q", last))
            for place, entries in found.items():
                store, path = common.open_folder(f"{folder}/{place}")
                with store.open_output_stream(f"{path}/{uuid.uuid4().hex}.repeats", compression=None) as f:
                    f.write(b"".join(entries))
            n += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    common.written(shared.repartition("place").sortWithinPartitions("place").mapInArrow(save, "n long"), "warc-repeat-files")


def _repeats_of(folder: str, place: int) -> dict[bytes, int]:
    from pyarrow import fs

    out: dict[bytes, int] = {}
    store, path = common.open_folder(f"{folder}/{place}")
    for info in store.get_file_info(fs.FileSelector(path)):
        with store.open_input_stream(info.path, compression=None) as f:
            out.update(struct.iter_unpack("<20sq", f.read()))
    return out


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> DataFrame:
    """Writes all pages; gives (key, id, file, offset, length) of each record. Payloads below ``least`` bytes are always responses. Which payloads repeat is
    found from their digests and told to the tasks that read the pages, by input file; payloads themselves are never shuffled."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), common.text_or_empty(html_col).alias("html"))
    placed = lambda rows: common.written(_payloads(rows, least), "warc-payloads")
    payloads = placed(rows)
    source = places.from_files(rows, payloads, "warc-pages")
    if source is not rows:
        rows, payloads = source, placed(source)
    repeats = common.scratch(pages.sparkSession, "warc-repeats")
    _save_repeats(payloads, repeats)
    todo = rows.select(url_key(F.col("url")).alias("key"), "id", "url", "html", places.input_place().alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = common.open_folder(folder)
        out, name, at, found = None, "", 0, []
        place, keep = None, {}
        for key, page_id, url, html, where in _rows(common.slices(batches)):
            if where != place:
                place, keep = where, _repeats_of(repeats, where)
            if out is None or at >= FILE_BYTES:
                if out:
                    out.close()
                name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                out = store.open_output_stream(f"{path}/{name}", compression=None)
            payload = html.encode()
            last = keep.get(hashlib.sha1(payload).digest()) if keep else None
            squeeze = zlib.compressobj(LEVEL, wbits=31)
            data = squeeze.compress(record(page_id, url, payload, None if last == page_id else last)) + squeeze.flush()
            out.write(data)
            found.append((key, NO_ID if page_id is None else page_id, name, at, len(data)))
            at += len(data)
            if len(found) >= 4096:
                yield _entries(found)
                found = []
        if out:
            out.close()
        if found:
            yield _entries(found)

    return common.written(todo.mapInArrow(run, "key string, id long, file string, offset long, length long"), "warc-captures")


def _entries(found: list) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], ["key", "id", "file", "offset", "length"])


def index_file(entries: list[tuple], block_entries: int = BLOCK_ENTRIES) -> bytes:
    """Compressed blocks of sorted (key, id, file, offset, length), their directory, a footer."""
    body, directory = io.BytesIO(), []
    for i in range(0, len(entries), block_entries):
        block = entries[i : i + block_entries]
        data = zlib.compress(json.dumps(block, separators=(",", ":")).encode(), LEVEL)
        directory.append((*block[0][:2], body.tell(), len(data)))
        body.write(data)
    at = body.tell()
    data = zlib.compress(json.dumps(directory, separators=(",", ":")).encode(), LEVEL)
    return body.getvalue() + data + _FOOTER.pack(_MAGIC, at, len(data))


SHARD_ENTRIES = 500_000


def build_index(captures: DataFrame, folder: str, partitions: int | None = None) -> list[tuple[str, int, str]]:
    """Writes the index; gives the sorted (first key, first id, file) of its files. A file holds at most SHARD_ENTRIES
    captures, so what comes back is a few bytes for each half million of them."""
    spark = captures.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = captures.repartitionByRange(n, "key", "id").sortWithinPartitions("key", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = common.open_folder(folder)
        entries: list[tuple] = []
        made: list[tuple] = []

        def flush() -> None:
            name = f"captures-{uuid.uuid4().hex}.idx"
            with store.open_output_stream(f"{path}/{name}", compression=None) as f:
                f.write(index_file(entries))
            made.append((*entries[0][:2], name))
            entries.clear()

        for row in _rows(batches):
            entries.append(row)
            if len(entries) >= SHARD_ENTRIES:
                flush()
        if entries:
            flush()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)], ["key", "id", "file"])

    return sorted((r.key, r.id, r.file) for r in ranges.mapInArrow(run, "key string, id long, file string").collect())


class Lru(OrderedDict):
    """The last few values of an expensive function."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def of(self, key):
        if key in self:
            self.move_to_end(key)
        else:
            self[key] = self.make(key)
            if len(self) > self.most:
                self.popitem(last=False)
        return self[key]


class Reader:
    """Searches the index and reads records by ranges of bytes."""

    def __init__(self, folder: str, shards: list[tuple[str, int, str]]):
        self.store, self.path = common.open_folder(folder)
        self.shards = shards
        self.firsts = [s[:2] for s in shards]
        self.files = Lru(lambda name: self.store.open_input_file(f"{self.path}/{name}"), 32)
        self.directories = Lru(self._directory, 8)
        self.blocks = Lru(self._block, 16)

    def read(self, name: str, offset: int, length: int) -> bytes:
        return self.files.of(name).read_at(length, offset)

    def _directory(self, name: str) -> tuple[list, list]:
        f = self.files.of(name)
        magic, at, length = _FOOTER.unpack(f.read_at(_FOOTER.size, f.size() - _FOOTER.size))
        if magic != _MAGIC:
            raise ValueError(f"{name} isn't an index file")
        rows = json.loads(zlib.decompress(f.read_at(length, at)))
        return [tuple(r[:2]) for r in rows], rows

    def _block(self, where: tuple[str, int, int]) -> tuple[list, list]:
        rows = json.loads(zlib.decompress(self.read(*where)))
        return [tuple(r[:2]) for r in rows], rows

    def find(self, key: str, capture: int) -> list[tuple[str, int, int]]:
        """(file, offset, length) of all records with this key and id."""
        out: list[tuple[str, int, int]] = []
        shard = max(0, bisect.bisect_left(self.firsts, (key, capture)) - 1)
        while shard < len(self.shards) and self.firsts[shard] <= (key, capture):
            name = self.shards[shard][2]
            firsts, rows = self.directories.of(name)
            k = max(0, bisect.bisect_left(firsts, (key, capture)) - 1)
            while k < len(rows) and firsts[k] <= (key, capture):
                keys, entries = self.blocks.of((name, rows[k][2], rows[k][3]))
                for e in entries[bisect.bisect_left(keys, (key, capture)) : bisect.bisect_right(keys, (key, capture))]:
                    out.append((e[2], e[3], e[4]))
                k += 1
            shard += 1
        return out


def look_up(wanted: DataFrame, folder: str, shards: list[tuple[str, int, str]], partitions: int | None = None) -> DataFrame:
    """From (key, id): a row a record found: id, payload_bytes, payload_digest, record_type, refers_to. Keys asked for more
    than once are read once. Rows are dealt out by ranges of (key, id), as in the index, so a host with very many captures is no single task."""
    spark = wanted.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = wanted.select("key", F.coalesce(F.col("id"), F.lit(NO_ID)).alias("id")).distinct().repartitionByRange(n, "key", "id").sortWithinPartitions("key", "id")
    shared = spark.sparkContext.broadcast(shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(folder, shared.value)
        for b in batches:
            asked = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            for i in range(0, len(asked), BATCH):
                places = sorted(p for key, capture in asked[i : i + BATCH] for p in reader.find(key, capture))
                rows = []
                for p in places:
                    r = parse(zlib.decompress(reader.read(*p), wbits=31))
                    rows.append((r["page_id"], r["size"], r["digest"], r["type"], r["refers_to"]))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                cols = zip(*rows, strict=True) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return ranges.mapInArrow(run, "id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op4(spark, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, indexed, and each looked up and read back."""
    pages = common.table(spark, sf_dir, "pages")
    folder = common.scratch(spark, "warc")
    shards = build_index(write_archives(pages, folder), folder)
    wanted = pages.select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("long").alias("id"))
    return look_up(wanted, folder, shards).withColumnRenamed("id", "page_id")
