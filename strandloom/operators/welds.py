"""Welds of contigs from reads: the windows of reads whose left part stands in one contig and whose right part stands in another.

A weldmer is a left flank and a core of one contig, then that core's right flank in another. Contigs that share a core by chance have weldmers without number that no read holds, so none is made here: windows of
reads are looked up in contigs by their two parts. All three share the core, so they are dealt once, by the core's minimizer: neighbours with the same one travel as one number, many numbers as one row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators import packed

LETTERS, GROUPS, HELD = 6, 1 << 12, 1 << 21  # letters of a minimizer; lots that windows are dealt to; stretches that a task holds before it sends them
MOST = 30  # letters of a stretch, beside four bits for its windows
FULL, TAIL, HEAD, READ = range(4)  # what a row has: whole windows of contigs, left parts at their ends, right parts at their beginnings, windows of reads


def fits(k: int, flank: int) -> bool:
    return k >= LETTERS and k + 2 * flank <= MOST - 2


def _groups(code: np.ndarray, k: int) -> np.ndarray:
    return packed._minimizers(code, k, False, LETTERS) & (GROUPS - 1)


def _group_of(core: str) -> int:
    if set(core) <= set("ACGT"):
        return int(_groups(packed._CODE[np.frombuffer(core.encode(), np.uint8)], len(core))[0])
    return zlib.crc32(core.encode()) & (GROUPS - 1)


def _stretches(texts: pa.Array, size: int, before: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, str]]]:
    """(row, group, stretch) of the plain windows of so many letters, whose core of k letters begins after ``before`` of them, and (row, group, word) of all others."""
    row, place, code, words = packed.windows_of(texts, size, canonical=False)
    odd = [(r, _group_of(w[before : before + k]), w) for r, _, w in words]
    none = np.zeros(0, np.int64)
    if not len(row):
        return none, none, none, odd
    texts = texts.fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    starts = ends[:-1] - ends[0]
    at = starts[row] + place
    if (data > 127).any():  # places are letters, not bytes
        first = np.flatnonzero((data & 0xC0) != 0x80)
        at = first[np.searchsorted(first, starts)[row] + place]
    plain = packed._CODE[data]
    group = _groups(np.where(plain == 255, 0, plain), k)[at + before]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1) | (group[1:] != group[:-1])])
    i = np.arange(len(row))
    first = np.flatnonzero((i - np.maximum.accumulate(np.where(new, i, 0))) % (MOST - size + 1) == 0)
    n = np.diff(np.append(first, len(row)))
    more = 2 * (n - 1)
    run = code[first] << more | code[first + n - 1] & ((1 << more) - 1)
    return row[first], group[first].astype(np.int64), run << 4 | n, odd


def _unrolled(stretch: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which stretch each window is of, and its code."""
    return packed.unrolled((stretch.view(np.uint64) >> np.uint64(4)).astype(np.int64), stretch & 15, size)


_SENT = "group int, side int, runs binary, ids binary, word string"


def _sent(df: DataFrame, kinds: tuple[int, ...], k: int, flank: int) -> DataFrame:
    """Rows of _SENT of sequences (seq) or of contigs (seq, contig): the stretches of a group as one blob, and their contigs' ids as another; odd words are rows of their own."""
    half, whole = k + flank, k + 2 * flank
    how = {FULL: (whole, flank), READ: (whole, flank), TAIL: (half, flank), HEAD: (half, 0)}
    with_ids = READ not in kinds
    schema = pa.schema([("group", pa.int32()), ("side", pa.int32()), ("runs", pa.binary()), ("ids", pa.binary()), ("word", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            for side in kinds:
                mine = [h[1:] for h in held if h[0] == side]
                if not mine:
                    continue
                group, stretch, ids = (np.concatenate(x) for x in zip(*mine, strict=True))
                order = np.argsort(group, kind="stable")
                group, stretch = group[order], stretch[order]
                ids = ids[order] if with_ids else ids
                edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
                cuts = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
                packs = [pa.compress(np.diff(ids[s:e], prepend=0).tobytes(), codec="zstd", asbytes=True) if with_ids else b"" for s, e in cuts]
                yield pa.RecordBatch.from_arrays([pa.array(group[edges[:-1]].astype(np.int32)), pa.array(np.full(len(cuts), side, np.int32)), pa.array([stretch[s:e].tobytes() for s, e in cuts], pa.binary()), pa.array(packs, pa.binary()), pa.nulls(len(cuts), pa.string())], schema=schema)
            held.clear()

        def kept(b: pa.RecordBatch, side: int, texts: pa.Array) -> Iterator[pa.RecordBatch]:
            row, group, stretch, odd = _stretches(texts, *how[side], k)
            ids = b.column(1).to_numpy() if with_ids else None
            if len(row):
                held.append((side, group, stretch, ids[row] if with_ids else row[:0]))
            if odd:
                yield pa.RecordBatch.from_arrays([pa.array([g for _, g, _ in odd], pa.int32()), pa.array([side] * len(odd), pa.int32()), pa.array([b""] * len(odd), pa.binary()), pa.array([int(ids[r]).to_bytes(8, "little", signed=True) if with_ids else b"" for r, _, _ in odd], pa.binary()), pa.array([w for _, _, w in odd], pa.string())], schema=schema)

        for batch in batches:
            if with_ids:  # whole windows have both parts; these are the parts that have no room for the other flank
                texts = batch.column(0).fill_null("").to_pylist()
                yield from kept(batch, TAIL, pa.array([t[max(0, len(t) - whole + 1) :] for t in texts], pa.string()))
                yield from kept(batch, HEAD, pa.array([t[: whole - 1] for t in texts], pa.string()))
            for b in packed.pieces(iter([batch]), 0, whole):
                yield from kept(b, FULL if with_ids else READ, b.column(0))
                if sum(len(h[1]) for h in held) > HELD:
                    yield from flush()
        yield from flush()

    return df.mapInArrow(run, _SENT)


class _Held:
    """What a group's rows have said so far."""

    def __init__(self, k: int, flank: int):
        self.half, self.whole, self.flank = k + flank, k + 2 * flank, flank
        self.parts = {TAIL: [], HEAD: []}  # (code, id) of left and of right parts
        self.odd: dict[int, dict[str, set[int]]] = {TAIL: {}, HEAD: {}}
        self.code, self.cnt, self.words = np.zeros(0, np.int64), np.zeros(0, np.int64), {}
        self.more: list[np.ndarray] = []

    def take(self, side: int, runs: bytes, ids: bytes, word: str | None) -> None:
        if word is not None:
            if side == READ:
                self.words[word] = self.words.get(word, 0) + 1
            else:
                for kind, part in ((TAIL, word[: self.half]), (HEAD, word[-self.half :])):
                    if side in (FULL, kind):
                        self._part(kind, part, int.from_bytes(ids, "little", signed=True))
            return
        stretch = np.frombuffer(runs, np.int64)
        row, code = _unrolled(stretch, self.whole if side in (FULL, READ) else self.half)
        if side == READ:
            self.more.append(code)
            if sum(map(len, self.more)) > HELD:
                self.count()
            return
        contig = np.cumsum(np.frombuffer(pa.decompress(ids, 8 * len(stretch), codec="zstd", asbytes=True), np.int64))[row]
        if side in (FULL, TAIL):
            self.parts[TAIL].append((code >> 2 * self.flank if side == FULL else code, contig))
        if side in (FULL, HEAD):
            self.parts[HEAD].append((code & ((1 << 2 * self.half) - 1) if side == FULL else code, contig))

    def _part(self, kind: int, part: str, contig: int) -> None:
        if set(part) <= set("ACGT"):
            self.parts[kind].append((np.array([_number(part)]), np.array([contig])))
        else:
            self.odd[kind].setdefault(part, set()).add(contig)

    def count(self) -> None:
        code = np.concatenate([self.code, *self.more])
        self.code, self.cnt = packed._sums(code, np.concatenate([self.cnt, np.ones(len(code) - len(self.code), np.int64)]))
        self.more = []

    def found(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Parts and the ids that hold them, sorted, each pair once."""
        code, ids = (np.concatenate(x) for x in zip(*self.parts[kind], strict=True)) if self.parts[kind] else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.lexsort((ids, code))
        code, ids = code[order], ids[order]
        new = np.concatenate([[True], (code[1:] != code[:-1]) | (ids[1:] != ids[:-1])]) if len(code) else np.zeros(0, bool)
        return code[new], ids[new]

    def met(self, least: int) -> Iterator[tuple]:
        """Of windows that stand in reads at least so often: (codes or words, counts, ids of left parts, first and end of each window's, ids of right parts, first and end)."""
        self.count()
        (left, lid), (right, rid) = self.found(TAIL), self.found(HEAD)
        keep = self.cnt >= least
        code, cnt = self.code[keep], self.cnt[keep]
        p, s = code >> 2 * self.flank, code & ((1 << 2 * self.half) - 1)
        at = [np.searchsorted(left, p), np.searchsorted(left, p, "right"), np.searchsorted(right, s), np.searchsorted(right, s, "right")]
        both = (at[1] > at[0]) & (at[3] > at[2])
        yield code[both], cnt[both], lid, at[0][both], at[1][both], rid, at[2][both], at[3][both]
        for word, n in self.words.items():
            a, b = (np.array(sorted(self._holders(kind, part, x, ids)), np.int64) for kind, part, x, ids in ((TAIL, word[: self.half], left, lid), (HEAD, word[-self.half :], right, rid)))
            if n >= least and len(a) and len(b):
                yield [word], np.array([n]), a, np.array([0]), np.array([len(a)]), b, np.array([0]), np.array([len(b)])

    def _holders(self, kind: int, part: str, code: np.ndarray, ids: np.ndarray) -> list[int]:
        if part in self.odd[kind] or not set(part) <= set("ACGT"):
            return list(self.odd[kind].get(part, ()))
        x = _number(part)
        return ids[np.searchsorted(code, x) : np.searchsorted(code, x, "right")].tolist()


def _number(part: str) -> int:
    return int(part.translate(str.maketrans("ACGT", "0123")), 4)


def _by_group(contigs: DataFrame, reads: DataFrame, k: int, flank: int) -> DataFrame:
    own = contigs.where("contig IS NOT NULL").select(F.col("seq").cast("string").alias("seq"), F.col("contig").cast("long").alias("contig"))
    rows = _sent(own, (FULL, TAIL, HEAD), k, flank).unionByName(_sent(reads.select(F.col("seq").cast("string").alias("seq")), (READ,), k, flank))
    return rows.repartition("group").sortWithinPartitions("group", "side")


def _groups_held(batches: Iterator[pa.RecordBatch], k: int, flank: int) -> Iterator[_Held]:
    now, held = None, None
    for b in batches:
        for group, side, runs, ids, word in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if group != now:
                if held is not None:
                    yield held
                now, held = group, _Held(k, flank)
            held.take(side, runs, ids, word)
    if held is not None:
        yield held


def support(contigs: DataFrame, reads: DataFrame, k: int, flank: int) -> DataFrame:
    """(weldmer, cnt): how often reads hold each weldmer of two different contigs (A01). contigs: contig, a whole number, and seq; reads: seq."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _groups_held(batches, k, flank):
            for name, cnt, lid, a, z, rid, b, y in held.met(1):
                if not len(cnt):
                    continue
                ok = (lid[a] != lid[z - 1]) | (rid[b] != rid[y - 1]) | (lid[a] != rid[b])  # ids are sorted: else all of either part is one and the same contig
                n = int(ok.sum())
                words = isinstance(name, list)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, -1) if words else name[ok]), pa.array(name[:n] if words else [""] * n, pa.string()), pa.array(cnt[ok].astype(np.int64))], ["code", "word", "cnt"])

    found = _by_group(contigs, reads, k, flank).mapInArrow(run, "code long, word string, cnt long")
    return packed.decoded(found, k + 2 * flank, name="weldmer")


def pairs(contigs: DataFrame, reads: DataFrame, k: int, flank: int, least: int) -> DataFrame:
    """(a, b, cnt), a < b: contigs that a weldmer joins in either direction, and how often reads hold the one that they hold most, if at least so often."""

    def most(a: np.ndarray, b: np.ndarray, cnt: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((cnt, b, a))
        a, b, cnt = a[order], b[order], cnt[order]
        last = np.flatnonzero(np.concatenate([(a[1:] != a[:-1]) | (b[1:] != b[:-1]), [True]])) if len(a) else np.zeros(0, np.int64)
        return a[last], b[last], cnt[last]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            out = most(*(np.concatenate(x) for x in zip(*kept, strict=True)))
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["a", "b", "cnt"])

        for held in _groups_held(batches, k, flank):
            for _, cnt, lid, a, z, rid, b, y in held.met(least):
                n = z - a
                window = np.repeat(np.arange(len(cnt)), n)  # a row a window and left contig, then one a right contig of those, some at a time
                left = lid[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(len(window))]
                many = (y - b)[window]
                lot = (np.cumsum(many) - many) // HELD
                for at in np.split(np.arange(len(window)), np.flatnonzero(np.diff(lot)) + 1):
                    m = many[at]
                    row = np.repeat(at, m)
                    right = rid[np.repeat(b[window[at]] - (np.cumsum(m) - m), m) + np.arange(len(row))]
                    one = left[row]
                    ok = one != right
                    kept.append(most(np.minimum(one, right)[ok], np.maximum(one, right)[ok], cnt[window[row]][ok]))
                    if sum(len(x[0]) for x in kept) > HELD:
                        yield flush()
        if kept:
            yield flush()

    found = _by_group(contigs, reads, k, flank).mapInArrow(run, "a long, b long, cnt long")
    return found.groupBy("a", "b").agg(F.max("cnt").alias("cnt"))
