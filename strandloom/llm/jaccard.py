"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct 5-word shingles as 64-bit hashes. Its sketch has a parity bit a
slot: hashing a shingle flips one bit, so the Hamming distance of two sketches is at most the
symmetric difference of the sets. With similarity s, sets of a and b shingles link only if they differ in at
most d = (1 - s) / (1 + s) * (a + b) shingles.

*Candidates.* Sizes are parted into bands; a pair is met in the band of its larger set. A band cuts its
sketch (of very many bits) into P pieces, P > d. At least P - d pieces of a linked pair are equal, so if
both sort their P pieces by one fixed order and keep the first d + 1, they share a kept piece. The order
puts pieces of many shingles first: empty pieces and those of one shingle, which many documents share,
are kept only where there is nothing better. A piece is known by a 64-bit XOR of its shingles.

*Meeting.* Kept pieces travel as packed arrays. Within a task, sets are at hand: members of a piece that are
nearer than BALL to its first member are verified at once and travel no further; they form a ball around that
member. Where pieces meet, up to FEW documents are paired with each other, more are paired with
the smallest only, and remembered. Candidates whose sketches differ in more than d bits are dropped; the
others are verified on their full sets.

*Whole results.* After the components of these links are known, two kinds of pairs may still matter, and only
between different components: members of remembered pieces (and of their balls) that were never paired,
and members of balls whose centres met and are so near that the triangle inequality of the Jaccard distance
leaves room for a link. Those are paired too, the former in blocks, with sketches deciding first. So no link
between components is lost, and no group emits all its pairs.

Null and empty texts, and texts without words, have empty sets, are linked with nothing and are their own component.
Texts of fewer than five words have one shingle, the whole sequence. Ids are meant to be unique; rows that share an id count as
one document for links. Rows with a null id are kept, with a null component.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import common, graphs

WORDS = 5
SIMILAR = (80, 100)  # 100 * common >= 80 * union
AROUND = (60, 100)  # centres of balls with linked members are this similar: 1 - 0.8 + 2 * BALL apart at most
BAND_RATIO = 1.5
SPARE = 0.15  # pieces beyond d + 1, by d
BALL = 0.1
FEW = 8
MEETING_PARTITIONS = 3  # times the session's shuffle partitions, so that what meets in one fits beside others
PARTS_PER_PARTITION = 4
BUFFER_SHINGLES = 1_500_000
MEET_ENTRIES = 2_000_000
TILE = 512
CHUNK = 128  # pairs of one document that are verified together

_U = np.uint64
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], _U)
_MOST_WORDS = 200_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= _MOST_WORDS:
            self.clear()
        self[word] = value
        return value


_hashes = _WordHashes()
common.cache("jaccard", _hashes)


def mix(x: np.ndarray, k: int = 1) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _K[k]
    x = (x ^ (x >> _U(29))) * _K[k + 1]
    return x ^ (x >> _U(32))


def shingles(text: str | None) -> np.ndarray:
    """The sorted hashes of a text's shingles. Words are what stands between ASCII white space, A-Z in lower case."""
    words = (text or "").encode().lower().split()
    n = len(words)
    w = np.fromiter(map(_hashes.__getitem__, words), _U, n)
    if n >= WORDS:
        m = n - WORDS + 1
        out = w[:m] * _K[0]
        for i in range(1, WORDS):
            out ^= out >> _U(27)
            out *= _K[5]
            out += w[i : m + i] * _K[i]
        return np.unique(mix(out))
    if not n:
        return w
    return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)], _U)


def most_different(total: int, similar: tuple[int, int] = SIMILAR) -> int:
    """d for sets of so many shingles together."""
    s, of = similar
    return (of - s) * total // (of + s)


def links(common_: int, a: int, b: int) -> bool:
    s, of = SIMILAR
    return of * common_ >= s * (a + b - common_) and a > 0 and b > 0


@lru_cache(maxsize=1)
def bands() -> np.ndarray:
    """The smallest size of each band."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * BAND_RATIO)))
    return np.array(out)


def bands_of(n: int) -> list[int]:
    """The bands in which a set of n shingles is met: its own, and those of larger sets that it can link with."""
    s, of = SIMILAR
    starts = bands()
    first = int(np.searchsorted(starts, n, "right")) - 1
    last = int(np.searchsorted(starts, n * of // s, "right")) - 1
    return list(range(first, last + 1))


def pieces(hashes: np.ndarray, band: int) -> np.ndarray:
    """The d + 1 kept pieces of a sorted set in a band, as 64-bit keys."""
    d = most_different(2 * (int(bands()[band + 1]) - 1))
    p = d + 1 + int(np.ceil(SPARE * d))
    at = ((hashes >> _U(32)) * _U(p)) >> _U(32)  # pieces are ranges of hashes, so their members are neighbours
    edges = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    number = at[edges]
    xor = np.bitwise_xor.reduceat(mix(hashes, 2), edges)
    count = np.diff(np.append(edges, len(hashes)))
    key = mix(xor + (number + _U(band << 40)) * _K[4], 3)
    if len(edges) <= d:  # empty pieces come last in the order
        empty = np.setdiff1d(np.arange(p, dtype=_U), number)
        key = np.concatenate([key, mix((empty + _U(band << 40)) * _K[4], 3)])
        count = np.concatenate([count, np.zeros(len(empty), count.dtype)])
    key = (_U(255) - np.minimum(count, 255).astype(_U)) << _U(56) | key >> _U(8)
    return key if len(key) == d + 1 else np.partition(key, d)[: d + 1]


def sketch(hashes: np.ndarray) -> bytes:
    """Parity bits, one to two a shingle; their number is a power of two."""
    bits = max(64, 1 << int(len(hashes) - 1).bit_length())
    return np.packbits((np.bincount((hashes & _U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A sketch with fewer slots: parities of slots that fall together add up."""
    while len(bits) > size:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def distance(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())


def shared(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0


def jaccard_distance(common_: int, a: int, b: int) -> float:
    return 1.0 - common_ / (a + b - common_)


# Rows of the first two steps. kind: doc (a id, b its partition, n size, f and g the set's fingerprint, data sketch), link (a, b verified),
# ball (a centre, b member, x distance), keys (part, data keys, more ids), pair (a, b candidates), member (a id, b the smallest of a piece's documents).
_ROWS = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("f", pa.int64()), ("g", pa.int64()), ("x", pa.float64()), ("data", pa.binary()), ("more", pa.binary())])
_ROWS_SQL = "kind string, part int, a long, b long, n long, f long, g long, x double, data binary, more binary"


class _Out:
    """Rows of _ROWS, given out in batches."""

    def __init__(self):
        self.rows: list[dict] = []

    def add(self, **row) -> None:
        self.rows.append(row)

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in self.rows], f.type) for f in _ROWS], schema=_ROWS)
        self.rows = []
        return out


def _signed(x: np.ndarray) -> int:
    return int(x.astype(np.int64))


class _Buffer:
    """Sets of one task's documents, one for each different set."""

    def __init__(self, parts: int, out: _Out, place: int = 0):
        self.parts, self.out, self.place = parts, out, place
        self.seen: dict[tuple, int] = {}
        self.clear()

    def clear(self) -> None:
        self.ids: list[int] = []
        self.sets: list[np.ndarray] = []
        self.size = 0

    def add(self, doc: int, hashes: np.ndarray) -> None:
        if not len(hashes):
            self.out.add(kind="doc", part=abs(doc) % self.parts, a=doc, n=0)
            return
        with np.errstate(over="ignore"):
            f, g = _signed(np.bitwise_xor.reduce(mix(hashes, 0))), _signed(np.add.reduce(mix(hashes, 2)))
        same = (len(hashes), f, g)
        first = self.seen.setdefault(same, doc)
        part = abs(doc) % self.parts
        if first != doc:
            self.out.add(kind="doc", part=part, a=doc, n=len(hashes))
            self.out.add(kind="link", part=part, a=min(first, doc), b=max(first, doc))
            return
        self.out.add(kind="doc", part=part, a=doc, b=self.place, n=len(hashes), f=f, g=g, data=sketch(hashes))
        self.ids.append(doc)
        self.sets.append(hashes)
        self.size += len(hashes)

    def flush(self) -> None:
        """Kept pieces of all sets; what is near within this buffer is settled here."""
        if not self.ids:
            return
        ids = np.array(self.ids, np.int64)
        found = [(k, pieces(h, band)) for k, h in enumerate(self.sets) for band in bands_of(len(h))]
        keys = np.concatenate([p for _, p in found])
        owner = np.repeat(np.array([k for k, _ in found]), [len(p) for _, p in found])
        order = np.lexsort((ids[owner], keys))
        keys, owner = keys[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ends = np.append(starts[1:], len(keys))
        keep = np.ones(len(keys), bool)
        known: dict[tuple[int, int], float] = {}
        for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
            first = int(owner[s])
            for i in range(s + 1, e):
                other = int(owner[i])
                if other == first:
                    keep[i] = False
                    continue
                if (first, other) not in known:
                    a, b = self.sets[first], self.sets[other]
                    n = shared(a, b)
                    far = known[first, other] = jaccard_distance(n, len(a), len(b))
                    pair = {"part": abs(self.ids[first]) % self.parts, "a": self.ids[first], "b": self.ids[other]}
                    if links(n, len(a), len(b)):
                        self.out.add(kind="link", **pair)
                    if far <= BALL:
                        self.out.add(kind="ball", x=far, **pair)
                keep[i] = known[first, other] > BALL
        keys, docs = keys[keep], ids[owner[keep]]
        part = (keys % _U(self.parts)).astype(np.int64)
        order = np.lexsort((docs, part))
        part, keys, docs = part[order], keys[order], docs[order]
        edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            self.out.add(kind="keys", part=int(part[s]), data=keys[s:e].tobytes(), more=docs[s:e].tobytes())
        self.clear()


def _signatures(docs: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("jaccard")
        out = _Out()
        buffer = _Buffer(parts, out, TaskContext.get().partitionId())
        for b in common.slices(batches):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                buffer.add(doc, shingles(text.as_py()))
                if buffer.size >= BUFFER_SHINGLES:
                    buffer.flush()
                    yield out.batch()
            if len(out.rows) >= 5000:
                yield out.batch()
        buffer.flush()
        if out.rows:
            yield out.batch()

    return docs.mapInArrow(run, _ROWS_SQL)


def _meet(rows: DataFrame) -> DataFrame:
    """Pairs that share a kept piece; other rows pass through. Rows come sorted by part; parts are held until they have MEET_ENTRIES pieces, so no more than those and one part are at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("jaccard pieces")
        now, keys, docs, held = None, [], [], 0
        for b in batches:
            is_keys = np.array(b.column(0).to_pylist(), object) == "keys"
            if not is_keys.all():
                yield b.filter(pa.array(~is_keys))
            for i in np.flatnonzero(is_keys).tolist():
                part = b.column(1)[i].as_py()
                if part != now and held >= MEET_ENTRIES:
                    yield from pairs_of(keys, docs)
                    keys, docs, held = [], [], 0
                now = part
                keys.append(np.frombuffer(b.column(8)[i].as_py(), _U))
                held += len(keys[-1])
                docs.append(np.frombuffer(b.column(9)[i].as_py(), np.int64))
        yield from pairs_of(keys, docs)

    def pairs_of(keys: list, docs: list) -> Iterator[pa.RecordBatch]:
        if not keys:
            return
        key, doc = np.concatenate(keys), np.concatenate(docs)
        keys.clear()
        docs.clear()
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        size = np.diff(np.append(np.flatnonzero(new), len(key)))
        several = np.repeat(size > 1, size)
        key, doc = key[several], doc[several]
        if not len(key):  # no piece here is another document's too
            return
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        again = np.concatenate([[False], (key[1:] == key[:-1]) & (doc[1:] == doc[:-1])])
        key, doc = key[~again], doc[~again]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(starts, len(key)))
        first = np.repeat(doc[starts], size)
        pairs = [np.stack([first, doc], 1)[first != doc]]
        few = np.repeat(size <= FEW, size)
        for step in range(1, FEW - 1):  # the others of small groups with each other
            same = few[:-step] & (key[step:] == key[:-step]) & (doc[:-step] != first[:-step])
            pairs.append(np.stack([doc[:-step], doc[step:]], 1)[same])
        found = np.unique(np.concatenate(pairs), axis=0)
        none = lambda n, t: pa.nulls(n, t)
        for i in range(0, len(found), 50_000):
            some = found[i : i + 50_000]
            n = len(some)
            yield pa.RecordBatch.from_arrays([pa.array(["pair"] * n), none(n, pa.int32()), pa.array(some[:, 0]), pa.array(some[:, 1]), *(none(n, f.type) for f in list(_ROWS)[4:])], schema=_ROWS)
        big = np.unique(np.stack([first[~few], doc[~few]], 1), axis=0)
        for i in range(0, len(big), 50_000):
            some = big[i : i + 50_000]
            n = len(some)
            yield pa.RecordBatch.from_arrays([pa.array(["member"] * n), none(n, pa.int32()), pa.array(some[:, 1]), pa.array(some[:, 0]), *(none(n, f.type) for f in list(_ROWS)[4:])], schema=_ROWS)

    return rows.mapInArrow(run, _ROWS_SQL)


def _near_sketches(pairs: DataFrame, sketches: DataFrame, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches leave this similarity possible."""
    pairs = common.written(pairs, "sketch-pairs")
    one = sketches.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    two = sketches.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    s, of = similar
    sized = graphs.matched(graphs.matched(pairs, one, "a", "b", graphs.frequent(pairs, "a")[0]), two, "b", "a", graphs.frequent(pairs, "b")[0]).where((F.col("n_a") * of >= F.col("n_b") * s) & (F.col("n_b") * of >= F.col("n_a") * s))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_a, s_a, n_b, s_b = (b.column(k).to_pylist() for k in (2, 3, 4, 5))
            near = [distance(x, y) <= most_different(p + q, similar) for p, x, q, y in zip(n_a, s_a, n_b, s_b, strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return sized.select("a", "b", "n_a", "s_a", "n_b", "s_b").mapInArrow(run, "a long, b long")


def _sets(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, hashes) of wanted documents (id, place). Rather than shuffle the texts, the ids go to files in the shared folder, one for each
    partition that the first reading found them in, and the texts are read once more in the same partitions. Should
    partitions have changed meanwhile, what is missing is fetched by a join."""
    folder = common.scratch(docs.sparkSession, "wanted")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, ids in _runs(batches, 1):
            store, path = common.open_folder(f"{folder}/{place[0]}")
            with store.open_output_stream(f"{path}/{uuid.uuid4().hex}.ids", compression=None) as f:
                f.write(np.array(ids[1], np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([place[0]], pa.int64()), pa.array([len(ids[1])], pa.int64())], ["place", "n"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        common.claim("jaccard")
        store, path = common.open_folder(f"{folder}/{TaskContext.get().partitionId()}")
        ids: set[int] = set()
        for info in store.get_file_info(fs.FileSelector(path)):
            with store.open_input_stream(info.path, compression=None) as f:
                ids.update(np.frombuffer(f.read(), np.int64).tolist())
        for b in common.slices(batches):
            keep = [doc in ids for doc in b.column(0).to_pylist()] if ids else []
            if any(keep):
                yield hashed(b.filter(pa.array(keep)))

    def hashed(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t.as_py()).tobytes() for t in b.column(1)], pa.binary())], ["id", "hashes"])

    common.written(wanted.select("place", "id").repartition("place").sortWithinPartitions("place").mapInArrow(save, "place long, n long"), "wanted-files")
    found = common.written(docs.mapInArrow(read, "id long, hashes binary"), "sets")
    missing = common.written(wanted.select("id").join(found.select("id"), "id", "left_anti"), "missing")
    if missing.isEmpty():
        return found
    return found.unionByName(docs.join(missing, "id").mapInArrow(lambda bs: map(hashed, common.slices(bs)), "id long, hashes binary"))


def _runs(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[tuple, list[list]]]:
    """Runs of rows with equal first n columns, as columns; rows must come sorted by them."""
    key, cols = None, []
    for b in batches:
        values = [c.to_pylist() for c in b.columns]
        for row in zip(*values, strict=True):
            if row[:n] != key:
                if key is not None:
                    yield key, cols
                key, cols = row[:n], [[] for _ in row]
            for c, v in zip(cols, row, strict=True):
                c.append(v)
    if key is not None:
        yield key, cols


def _verified(pairs: DataFrame, docs: DataFrame, places: DataFrame) -> DataFrame:
    """(a, b, common, n_a, n_b) of each pair on its full sets. A document's partners come in chunks, its own set once a chunk."""
    pairs = common.written(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    sets = _sets(common.written(ids.join(places, "id"), "wanted"), docs)
    parts, _ = graphs.frequent(pairs, "a", CHUNK)
    asked, own = pairs.withColumn("chunk", F.lit(0).cast("long")), sets.withColumnRenamed("id", "a").join(pairs.select("a").distinct(), "a", "left_semi").withColumn("chunk", F.lit(0).cast("long"))
    if parts is not None:
        light, heavy = asked.join(parts, "a", "left_anti"), pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), "_parts").alias("chunk"))
        asked = light.unionByName(heavy)
        more = own.join(parts, "a").where("_parts > 1").select("a", "hashes", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_parts") - 1)).alias("chunk"))
        own = own.unionByName(more)
    own = own.select("a", "chunk", "hashes")
    others = graphs.matched(asked, sets.withColumnRenamed("id", "b"), "b", "a", graphs.frequent(pairs, "b")[0]).select("a", "chunk", "b", "hashes")
    rows = own.select("a", "chunk", F.lit(None).cast("long").alias("b"), "hashes").unionByName(others)
    rows = rows.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mine = None, None
        for batch in batches:
            found = []
            for a, chunk, b, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = np.frombuffer(data, _U)
                if b is None:
                    at, mine = (a, chunk), hashes
                elif at == (a, chunk):
                    found.append((a, b, shared(mine, hashes), len(mine), len(hashes)))
            cols = zip(*found, strict=True) if found else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "common", "n_a", "n_b"])

    return rows.mapInArrow(run, "a long, b long, common long, n_a long, n_b long")


def _is_link(rows: DataFrame) -> DataFrame:
    s, of = SIMILAR
    return rows.where(of * F.col("common") >= s * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def _unpaired(members: DataFrame, balls: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs of different components among the documents that met the same smallest document in a remembered piece, in blocks of TILE by TILE. Pieces of
    one group of documents mostly have the same smallest one, so the group is looked at once and not once a piece."""
    around = members.join(balls.select(F.col("a").alias("id"), "b"), "id").select("low", F.col("b").alias("id"))
    everyone = members.unionByName(around).distinct()
    known = everyone.join(labels, everyone["id"] == labels["of"], "left").select("low", "id", F.coalesce("component", "id").alias("component"))
    known = common.written(known, "known")
    open_ = known.groupBy("low").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.ceil(F.count(F.lit(1)) / TILE).cast("long").alias("tiles")).where("least != most")
    rows = graphs.matched(known, open_.select("low", "tiles"), "low", "id", graphs.frequent(known, "low")[0]).join(sketches, "id").withColumn("mine", F.pmod(F.xxhash64("id"), "tiles"))
    rows = rows.withColumn("yours", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    tile = rows.select("low", F.least("mine", "yours").alias("i"), F.greatest("mine", "yours").alias("j"), "mine", "id", "component", "n", "sketch")
    s, of = SIMILAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), cols in _runs(batches, 3):
            mine, ids, comp, n = (np.array(c, np.int64) for c in cols[3:7])
            size = min(map(len, cols[7]))
            small = np.stack([folded(np.frombuffer(x, np.uint8), size) for x in cols[7]])
            here, there = (np.flatnonzero(mine == i), np.flatnonzero(mine == j))
            a, b = [], []
            for k in here.tolist():
                rest = there if i != j else there[ids[there] > ids[k]]
                rest = rest[(comp[rest] != comp[k]) & (n[rest] * of >= n[k] * s) & (n[k] * of >= n[rest] * s)]
                if len(rest):
                    near = rest[np.bitwise_count(small[rest] ^ small[k]).sum(1) <= (of - s) * (n[rest] + n[k]) // (of + s)]
                    a += [int(ids[k])] * len(near)
                    b += ids[near].tolist()
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])

    return tile.repartition("low", "i", "j").sortWithinPartitions("low", "i", "j").mapInArrow(run, "a long, b long")


def _between_balls(met: DataFrame, balls: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs of members of two balls whose centres met, aren't in one component and are near enough."""
    centres = balls.select(F.col("a").alias("centre")).distinct()
    known = [met.join(centres, met[side] == centres["centre"]).select("a", "b") for side in ("a", "b")]
    label = lambda name: labels.select(F.col("of").alias(name), F.col("component").alias(f"c_{name}"))
    apart = known[0].unionByName(known[1]).distinct().join(label("a"), "a", "left").join(label("b"), "b", "left")
    apart = apart.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")
    near = _near_sketches(apart, sketches, AROUND)
    own = balls.select(F.col("a").alias("centre"), F.col("b").alias("id")).unionByName(centres.select("centre", F.col("centre").alias("id")))
    left = near.join(own.select(F.col("centre").alias("a"), F.col("id").alias("p")), "a", "left").select("b", F.coalesce("p", "a").alias("p"))
    both = left.join(own.select(F.col("centre").alias("b"), F.col("id").alias("q")), "b", "left").select("p", F.coalesce("q", "b").alias("q"))
    return both.where("p != q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id): the smallest id that is reachable by links, itself included."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    texts = docs.select(F.col(id_col).cast("long").alias("id"), common.text_or_empty(text_col).alias("text"))
    named = texts.where("id IS NOT NULL")
    n = MEETING_PARTITIONS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = _signatures(named, n * PARTS_PER_PARTITION).repartition(n, "part").sortWithinPartitions("part")
    rows = common.written(_meet(sent), "meetings")

    all_docs = rows.where("kind = 'doc'")
    sketches = all_docs.where("data IS NOT NULL").select(F.col("a").alias("id"), "n", F.col("data").alias("sketch"))
    places = all_docs.where("data IS NOT NULL").select(F.col("a").alias("id"), F.col("b").alias("place"))
    firsts = all_docs.where("f IS NOT NULL").select("n", "f", "g", F.col("a").alias("b"))
    same = firsts.join(firsts.groupBy("n", "f", "g").agg(F.min("b").alias("a")), ["n", "f", "g"]).where("a != b").select("a", "b")
    settled = rows.where("kind = 'link'").select("a", "b").unionByName(same)
    settled = common.written(settled, "settled")

    met = common.written(rows.where("kind = 'pair'").select("a", "b").distinct(), "met")
    pairs = met.join(settled.distinct(), ["a", "b"], "left_anti")
    edges = common.written(settled.unionByName(_is_link(_verified(_near_sketches(pairs, sketches), named, places))), "links")
    labels = graphs.components(edges).withColumnRenamed("id", "of")

    members = rows.where("kind = 'member'").select(F.col("b").alias("low"), F.col("a").alias("id")).distinct()
    balls = rows.where("kind = 'ball'").select("a", "b").distinct()
    more = _unpaired(members, balls, labels, sketches).unionByName(_near_sketches(_between_balls(met, balls, labels, sketches), sketches))
    more = common.written(more.distinct(), "more-pairs")
    if not more.isEmpty():
        extra = common.written(_is_link(_verified(more, named, places)), "more-links")
        if not extra.isEmpty():
            labels = graphs.components(edges.unionByName(extra)).withColumnRenamed("id", "of")

    sizes = all_docs.groupBy(F.col("a").alias("id")).agg(F.max("n").alias("n_shingles"))
    found = sizes.join(labels, sizes["id"] == labels["of"], "left").select("id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    out = texts.select("id").join(found, "id", "left").select("id", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), "component_id")
    return out.select(F.col("id").cast(kind).alias(id_col), "n_shingles", F.col("component_id").cast(kind).alias("component_id"))


def op6(spark, sf_dir: str) -> DataFrame:
    """Components of near-equal documents."""
    return join(common.table(spark, sf_dir, "documents"))
