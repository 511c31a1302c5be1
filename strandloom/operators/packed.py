"""K-mers as numbers: windows of up to 31 letters in two bits a letter, A < C < G < T, so numbers sort as their letters do.

A batch of sequences is one run of bytes. The codes of all its windows come from a few shifts over that run (pieces of 1, 2, 4, 8 and 16
letters are joined), those of the other strand likewise, and equal windows are counted before they leave the task. Windows with any
other letter can't be packed; they travel as words. Everything after that, from the shuffle on, is plain DataFrame code on eight bytes a k-mer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 31
_CODE = np.full(256, 255, np.uint8)
_CODE[list(b"ACGT")] = range(4)
_PAIRS = str.maketrans("ACGTRYKMBVDHSWNacgtrykmbvdhswn", "TGCAYRMKVBHDSWNtgcayrmkvbhdswn")  # fixed values: letters and their complements


def letters(code: Column, k: int) -> Column:
    """The k-mer of a packed number."""
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), k, "0"), "0123", "ACGT")


def code(kmer: str) -> Column:
    """The packed number of a column of k-mers of A, C, G and T."""
    return F.conv(F.translate(kmer, "ACGT", "0123"), 4, 10).cast("long")


def _joined(letter: np.ndarray, k: int, mirrored: bool) -> np.ndarray:
    """Packed windows at every place of a run of codes. mirrored: the first letter is the lowest."""
    piece, size, out, done = letter.astype(np.int64), 1, None, 0
    while True:
        if k & size:
            if out is None:
                out, done = piece, size
            else:
                n = len(letter) - done - size + 1
                a, b = out[:n], piece[done : done + n]
                out, done = (b << 2 * done | a) if mirrored else (a << 2 * size | b), done + size
        if done == k:
            return out
        n = len(letter) - 2 * size + 1
        a, b = piece[:n], piece[size : size + n]
        piece, size = (b << 2 * size | a) if mirrored else (a << 2 * size | b), 2 * size


def windows_of(texts: pa.Array, k: int, canonical: bool, plain_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, str]]]:
    """(row, place, code) of the windows of plain letters, and a list of (row, place, word) of all others, unless they aren't wanted. Null texts have none."""
    texts = texts.fill_null("")
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8) if len(texts) else np.zeros(0, np.uint8)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data, ends = data[ends[0] : ends[-1]], ends - ends[0]
    none = np.zeros(0, np.int64)
    if len(data) < k:
        return none, none, none, []
    code = _CODE[data]
    odd = code == 255
    n = np.maximum(np.diff(ends) - k + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(ends[:-1], n) + place
    words: list[tuple[int, int, str]] = []
    if odd.any():
        before = np.concatenate([[0], np.cumsum(odd)])
        plain = before[at + k] == before[at]
        for r in [] if plain_only else np.unique(row[~plain]).tolist():
            text = texts[r].as_py()
            other = {i for i in range(len(text) - k + 1) if any(c not in "ACGT" for c in text[i : i + k])}
            for i in sorted(other):
                word = text[i : i + k]
                words.append((r, i, min(word, word.translate(_PAIRS)[::-1]) if canonical else word))
        if (data > 127).any():  # places are letters, not bytes
            wide = np.concatenate([[0], np.cumsum((data & 0xC0) == 0x80)])
            place = place - (wide[at] - wide[np.repeat(ends[:-1], n)])
        row, place, at = row[plain], place[plain], at[plain]
        code = np.where(odd, 0, code)
    found = _joined(code, k, False)[at]
    if canonical:
        found = np.minimum(found, _joined(3 - code, k, True)[at])
    return row, place, found, words


PIECE = 1 << 19  # letters that are worked on at a time; a task takes some 60 bytes for each


def pieces(batches: Iterator[pa.RecordBatch], seq: int, k: int, multiple: int = 1) -> Iterator[pa.RecordBatch]:
    """The same windows in batches of about PIECE letters: several rows, or a stretch of a longer sequence, whose next stretch begins k - 1 letters before
    its end and at a multiple of so many letters from its first one. Other columns are repeated."""
    step = PIECE - PIECE % multiple
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(seq)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.cumsum(size) // PIECE
        edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])) if len(size) else []
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            part = b.slice(int(s), int(e - s))
            if size[s:e].max() <= 2 * PIECE:
                yield part
                continue
            for i in range(part.num_rows):
                row = part.slice(i, 1)
                text = row.column(seq)[0].as_py() or ""
                for at in range(0, max(1, len(text) - k + 1), step):
                    yield row.set_column(seq, row.schema.field(seq), pa.array([text[at : at + step + k - 1]], pa.string()))


def _keys(b: pa.RecordBatch, n: int) -> tuple[list[pa.Array], np.ndarray]:
    """The different combinations of the first n columns, and which one each row has."""
    if not n:
        return [], np.zeros(b.num_rows, np.int64)
    if n == 1:
        coded = b.column(0).dictionary_encode(null_encoding="encode")
        return [coded.dictionary], coded.indices.to_numpy().astype(np.int64)
    table = pa.table([b.column(i) for i in range(n)], names=[str(i) for i in range(n)])
    rows = list(zip(*(c.to_pylist() for c in table.columns), strict=True))
    known: dict[tuple, int] = {}
    which = np.array([known.setdefault(r, len(known)) for r in rows], np.int64)
    return [pa.array(c, f.type) for c, f in zip(zip(*known, strict=True), table.schema, strict=True)] if known else [pa.array([], f.type) for f in table.schema], which


def count(df: DataFrame, k: int, seq: str = "seq", canonical: bool = False, weight: str | None = None, by: tuple[str, ...] = (), frames: int = 0, plain_only: bool = False, decode: bool = True, also: tuple[int, ...] = ()) -> DataFrame:
    """(*by, kmer, cnt), or (*by, code, word, cnt) if not decoded: how often each k-mer stands in the sequences, of both strands together if canonical; cnt sums a whole-number column if there is a weight.
    frames adds a column ``frame``, the place modulo so many. plain_only leaves out k-mers with other letters than A, C, G, T. also: further lengths to count on the same way; a column ``k`` says which, and nothing is decoded."""
    if not all(1 <= x <= MOST for x in (k, *also)):
        raise ValueError(f"k must be from 1 to {MOST}")
    if k in STRETCHED and not by and not frames and not also:
        total = _count_stretches(df, k, seq, canonical, weight, plain_only).hint("merge")
        return decoded(total, k) if decode else total
    width = len(by)
    rows = df.select(*by, F.col(seq).cast("string").alias("_seq"), *([F.col(weight).cast("long").alias("_w")] if weight else []))
    kinds = [df.schema[c].dataType.simpleString() for c in by]
    head = [f"`{c}` {t}" for c, t in zip(by, kinds, strict=True)] + (["frame int"] if frames else []) + (["k int"] if also else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not also:
            yield from counted(batches, k)
            return
        for b in batches:
            for size in (k, *also):
                for out in counted(iter([b]), size):
                    yield out.add_column(out.num_columns - 3, "k", pa.array(np.full(out.num_rows, size, np.int32)))

    def counted(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, width, k, max(frames, 1)):
            keys, which = _keys(b, width)
            row, place, code, words = windows_of(b.column(width), k, canonical, plain_only)
            w = b.column(width + 1).fill_null(0).to_numpy() if weight else None
            n_keys = max(1, len(keys[0]) if keys else 1)
            key = which[row] * max(frames, 1) + (place % frames if frames else 0)
            if 2 * k + (n_keys * max(frames, 1)).bit_length() < 64:  # key and code are one number, which is quicker to sort
                code = key << 2 * k | code
                order = np.argsort(code, kind="stable") if weight else None
                code = code[order] if weight else np.sort(code)
                key, code = code >> 2 * k, code & ((1 << 2 * k) - 1)
            else:
                order = np.lexsort((code, key))
                key, code = key[order], code[order]
            new = (key[1:] != key[:-1]) | (code[1:] != code[:-1])
            first = np.flatnonzero(np.concatenate([[True], new])) if len(code) else np.zeros(0, np.int64)
            cnt = (np.add.reduceat(w[row][order], first) if len(first) else first) if weight else np.diff(np.append(first, len(code)))
            code, key = code[first], key[first]
            more = [(which[r], i % frames if frames else 0, word, int(w[r]) if weight else 1) for r, i, word in words]
            key_at = np.concatenate([key // max(frames, 1), [m[0] for m in more]]).astype(np.int64)
            cols = [c.take(pa.array(key_at)) for c in keys]
            if frames:
                cols.append(pa.array(np.concatenate([key % frames, [m[1] for m in more]]).astype(np.int32)))
            cols += [
                pa.array(np.concatenate([code, np.full(len(more), -1)]).astype(np.int64)), pa.array([""] * len(code) + [m[2] for m in more], pa.string()),
                pa.array(np.concatenate([cnt, [m[3] for m in more]]).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(cols, [*by, *(["frame"] if frames else []), "code", "word", "cnt"])

    found = rows.mapInArrow(run, ", ".join([*head, "code long", "word string", "cnt long"]))
    keys = [*by, *(["frame"] if frames else []), *(["k"] if also else [])]
    total = found.groupBy(*keys, "code", "word").agg(F.sum("cnt").alias("cnt")).hint("merge")  # k-mers outgrow what Spark expects of their sequences
    return decoded(total, k) if decode and not also else total


def decoded(df: DataFrame, k: int, code: str = "code", word: str = "word", name: str = "kmer") -> DataFrame:
    """df with a k-mer's letters in place of its code and word. They are generated, so that what names them later doesn't compute them again each time."""
    kmer = F.when(F.col(code) >= 0, letters(F.col(code), k)).otherwise(F.col(word))
    out = [F.explode(F.array(kmer)).alias(name) if c == code else F.col(c) for c in df.columns if c != word]
    return df.select(*out)


def encoded(kmer: str, k: int) -> list[Column]:
    """Code and word of a column of k-mers. Others than those of k letters are words."""
    plain = F.col(kmer).rlike(f"^[ACGT]{{{k}}}$")
    return [F.when(plain, code(kmer)).otherwise(F.lit(-1).cast("long")).alias("code"), F.when(plain, "").otherwise(F.col(kmer)).alias("word")]


def _part(code: Column, rest: Column) -> list[Column]:
    """Code and word of a part of a k-mer: of its code where it has one, else of the part's letters, which may be plain where the k-mer isn't."""
    plain = rest.rlike("^[ACGT]+$")
    digits = F.conv(F.translate(rest, "ACGT", "0123"), 4, 10).cast("long")
    return [F.when(F.col("code") >= 0, code).when(plain, digits).otherwise(F.lit(-1).cast("long")), F.when((F.col("code") >= 0) | plain, "").otherwise(rest)]


def without_last(k: int) -> list[Column]:
    """(code, word) of a k-mer's first k - 1 letters."""
    return _part(F.shiftright("code", 2), F.expr("substring(word, 1, length(word) - 1)"))


def without_first(k: int) -> list[Column]:
    """(code, word) of a k-mer's last k - 1 letters."""
    return _part(F.col("code").bitwiseAND(F.lit((1 << 2 * (k - 1)) - 1)), F.expr("substring(word, 2)"))


def last_letter() -> Column:
    return F.when(F.col("code") >= 0, F.substring(F.lit("ACGT"), F.col("code").bitwiseAND(F.lit(3)).cast("int") + 1, F.lit(1))).otherwise(F.expr("substring(word, -1, 1)"))


def first_letter(k: int) -> Column:
    return F.when(F.col("code") >= 0, F.substring(F.lit("ACGT"), F.shiftright("code", 2 * (k - 1)).cast("int") + 1, F.lit(1))).otherwise(F.expr("substring(word, 1, 1)"))


def windows(df: DataFrame, k: int, key: str, seq: str = "seq", canonical: bool = False) -> DataFrame:
    """(key, pos, code, word) of every window; word is empty where the code tells it all, and the code -1 where it can't. Joins on code and word are joins on k-mers."""
    if not 1 <= k <= MOST:
        raise ValueError(f"k must be from 1 to {MOST}")
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, place, code, words = windows_of(b.column(1), k, canonical)
            at = np.concatenate([row, [w[0] for w in words]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), pa.array(np.concatenate([place, [w[1] for w in words]]).astype(np.int32)),
                 pa.array(np.concatenate([code, np.full(len(words), -1)]).astype(np.int64)), pa.array([""] * len(code) + [w[2] for w in words], pa.string())],
                [key, "pos", "code", "word"],
            )

    return df.select(key, F.col(seq).cast("string").alias("_seq")).mapInArrow(run, f"`{key}` {kind}, pos int, code long, word string").hint("merge")  # windows outgrow what Spark expects of them


LETTERS, WORDS = 10, 31  # of a minimizer, and of a stretch, which is one number
STRETCHED = range(16, 28)  # k for which stretches hold five windows or more


def _turned(code: np.ndarray, k: int) -> np.ndarray:
    """Packed k-mers of the other strand."""
    x = ~code.astype(np.uint64)
    for by, mask in ((2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)):
        x = (x >> np.uint64(by)) & np.uint64(mask) | (x & np.uint64(mask)) << np.uint64(by)
    x = x >> np.uint64(32) | x << np.uint64(32)
    return (x >> np.uint64(64 - 2 * k)).astype(np.int64)


def _minimizers(code: np.ndarray, k: int, canonical: bool, letters: int = LETTERS) -> np.ndarray:
    """The least hash of the words of so many letters in each window of a run of codes; if canonical, of those of either strand."""
    words = _joined(code, letters, False)
    if canonical:
        words = np.minimum(words, _joined(3 - code, letters, True))
    h = words.astype(np.uint32) * np.uint32(0x9E3779B1)
    h = (h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA77)
    h = (h ^ h >> np.uint32(13)).view(np.int32)
    size, width = 1, k - letters + 1
    while size < width:
        step = min(size, width - size)
        h, size = np.minimum(h[: len(h) - step], h[step:]), size + step
    return h


def stretches(df: DataFrame, k: int, keep: tuple[str, ...] = (), seq: str = "seq", canonical: bool = False, plain_only: bool = False) -> DataFrame:
    """(*keep, bucket, run, n, word): the windows of k letters, n neighbours with the same minimizer as one number of k + n - 1 letters. Windows that can't be packed are a row each, with n 0 and their word.
    Equal windows have the same bucket, so rows dealt by it meet, and are several times fewer than windows. If canonical, a window and its mirror have the same bucket."""
    if k not in STRETCHED:
        raise ValueError(f"k must be from {STRETCHED[0]} to {STRETCHED[-1]}")
    most, width = WORDS - k + 1, len(keep)
    kinds = [df.schema[c].dataType.simpleString() for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, width, k):
            texts = b.column(width).fill_null("")
            row, place, code, words = windows_of(texts, k, canonical=False, plain_only=plain_only)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            plain = _CODE[data[ends[0] : ends[-1]]]
            odd = plain == 255
            if len(row):
                starts = ends[:-1] - ends[0]
                at = starts[row] + place
                if (data > 127).any():  # places are letters, not bytes
                    first = np.flatnonzero((data[ends[0] : ends[-1]] & 0xC0) != 0x80)
                    at = first[np.searchsorted(first, starts)[row] + place]
                bucket = _minimizers(np.where(odd, 0, plain), k, canonical)[at]
                new = np.concatenate([[True], (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1) | (bucket[1:] != bucket[:-1])])
                i = np.arange(len(row))
                first = np.flatnonzero((i - np.maximum.accumulate(np.where(new, i, 0))) % most == 0)
                n = np.diff(np.append(first, len(row)))
                last = code[first + n - 1]
                more = 2 * (n - 1)
                packed_run = code[first] << more | last & ((1 << more) - 1)
                row, bucket = row[first], bucket[first]
            else:
                bucket, n, packed_run = np.zeros(0, np.int32), row, row
            none = [None] * len(row)
            at = pa.array(np.concatenate([row, [w[0] for w in words]]).astype(np.int64))
            names = [min(w[2], w[2].translate(_PAIRS)[::-1]) if canonical else w[2] for w in words]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i).take(at) for i in range(width)), pa.array(np.concatenate([bucket, [zlib.crc32(w.encode()) >> 1 for w in names]]).astype(np.int32)),
                 pa.array(np.append(packed_run, np.zeros(len(words), np.int64))), pa.array(np.append(n, np.zeros(len(words), np.int64)).astype(np.int32)), pa.array(none + names, pa.string())],
                [*keep, "bucket", "run", "n", "word"],
            )

    rows = df.select(*keep, F.col(seq).cast("string").alias("_seq"))
    return rows.mapInArrow(run, ", ".join([*(f"`{c}` {t}" for c, t in zip(keep, kinds, strict=True)), "bucket int, run long, n int, word string"]))


def unrolled(run: np.ndarray, n: np.ndarray, k: int, canonical: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Which row each window of some stretches is of, and its code."""
    row = np.repeat(np.arange(len(n)), n)
    back = np.repeat(np.cumsum(n), n) - 1 - np.arange(len(row))
    code = run[row] >> 2 * back & ((1 << 2 * k) - 1)
    return row, np.minimum(code, _turned(code, k)) if canonical else code


def _sums(code: np.ndarray, cnt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(code):
        return code, cnt
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    return code[first], np.add.reduceat(cnt[order], first)


def _count_stretches(df: DataFrame, k: int, seq: str, canonical: bool, weight: str | None, plain_only: bool) -> DataFrame:
    """(code, word, cnt), as ``count``: stretches are shuffled in place of windows, and a task counts a bucket's windows as they come. It holds the different k-mers of one bucket."""
    rows = df.select(seq, F.coalesce(F.col(weight).cast("long"), F.lit(0)).alias("_w")) if weight else df
    met = stretches(rows, k, ("_w",) if weight else (), seq, canonical, plain_only).repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, code, cnt, words, at = None, np.zeros(0, np.int64), np.zeros(0, np.int64), {}, 0

        def out(code: np.ndarray, cnt: np.ndarray, words: dict[str, int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([code, np.full(len(words), -1)]).astype(np.int64)), pa.array([""] * len(code) + list(words), pa.string()), pa.array(np.append(cnt, np.array(list(words.values()), np.int64)))],
                ["code", "word", "cnt"],
            )

        for b in batches:
            if not b.num_rows:
                continue
            bucket, runs, n = (b.column(i).to_numpy() for i in range(3))
            w = b.column(4).to_numpy() if weight else np.ones(len(n), np.int64)
            odd = np.flatnonzero(n == 0)
            row, found = unrolled(runs, n, k, canonical)
            last = int(bucket[-1])
            done = bucket[row] != last
            if held is not None and held != last:  # what was held has ended in this batch at the latest
                yield out(*_sums(np.concatenate([code, found[done]]), np.concatenate([cnt, w[row[done]]])), {})
                code, cnt = found[~done], w[row[~done]]
            else:
                if done.any():
                    yield out(*_sums(found[done], w[row[done]]), {})
                code, cnt = np.concatenate([code, found[~done]]), np.concatenate([cnt, w[row[~done]]])
            code, cnt = _sums(code, cnt)
            for i, word in zip(odd.tolist(), b.column(3).take(pa.array(odd)).to_pylist(), strict=True):
                if words and at != bucket[i]:
                    yield out(code[:0], cnt[:0], words)
                    words = {}
                at = bucket[i]
                words[word] = words.get(word, 0) + int(w[i])
            held = last
        yield out(code, cnt, words)

    return met.select("bucket", "run", "n", "word", *(["_w"] if weight else [])).mapInArrow(run, "code long, word string, cnt long")


def labelled(reads: DataFrame, key: str, contigs: DataFrame, label: str, k: int, seq: str = "seq") -> DataFrame:
    """(key, label, hits, windows): how many windows of a read have each label, where a k-mer has the largest label of the contigs that hold it. Windows sum up to all of a read's, those without a label are
    rows with no hits. key and label are whole numbers. Stretches of both sides meet by bucket,
    those of contigs first; a task holds the labels of one bucket."""
    of = lambda df, name, side: stretches(df.select(F.col(name).cast("long").alias("_id"), seq), k, ("_id",), seq).withColumn("_side", F.lit(side))
    rows = of(contigs, label, 0).unionByName(of(reads, key, 1))
    met = rows.repartition("bucket").sortWithinPartitions("bucket", "_side")
    none = -(1 << 63)  # stands for null, which any label is larger than

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, code, owner, words, at = None, np.zeros(0, np.int64), np.zeros(0, np.int64), {}, None
        for b in batches:
            if not b.num_rows:
                continue
            bucket, runs, n, side = (b.column(i).to_numpy() for i in (0, 1, 2, 4))
            ids = b.column(5).fill_null(none).to_numpy()
            row, found = unrolled(runs, n, k)
            mine = side[row] == 0
            if len(row) and mine.any():
                code, owner = np.concatenate([code, found[mine]]), np.concatenate([owner, ids[row[mine]]])
                order = np.argsort(code)
                code, owner = code[order], owner[order]
                first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                code, owner = code[first], np.maximum.reduceat(owner, first)
            asked, letters_of = row[~mine], found[~mine]
            place = np.minimum(np.searchsorted(code, letters_of), max(len(code) - 1, 0))
            hit = code[place] == letters_of if len(code) else np.zeros(len(asked), bool)
            reader, given = asked[hit], owner[place[hit]] if len(code) else owner[:0]
            odd = np.flatnonzero(n == 0)
            more: list[tuple[int, int]] = []
            for i, word in zip(odd.tolist(), b.column(3).take(pa.array(odd)).to_pylist(), strict=True):
                if at != bucket[i]:
                    words, at = {}, bucket[i]
                if side[i] == 0:
                    words[word] = max(words.get(word, int(ids[i])), int(ids[i]))
                elif word in words:
                    more.append((i, words[word]))
            reader, given = np.append(reader, np.array([m[0] for m in more], np.int64)), np.append(given, np.array([m[1] for m in more], np.int64))
            first = np.flatnonzero(np.concatenate([[True], (reader[1:] != reader[:-1]) | (given[1:] != given[:-1])])) if len(reader) else reader
            hits = np.diff(np.append(first, len(reader)))
            reader, given = reader[first], given[first]
            begins = np.concatenate([[True], reader[1:] != reader[:-1]]) if len(reader) else np.zeros(0, bool)
            rest = np.flatnonzero(side == 1)
            rest = rest[~np.isin(rest, reader)]
            windows = np.append(np.where(begins, np.maximum(n[reader], 1), 0), np.maximum(n[rest], 1))
            reader, given, hits = np.append(reader, rest), np.append(given, np.full(len(rest), none)), np.append(hits, np.zeros(len(rest), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids[reader], mask=ids[reader] == none), pa.array(given, mask=given == none), pa.array(hits.astype(np.int64)), pa.array(windows.astype(np.int64))], ["_id", "_label", "hits", "windows"])
            last = bucket[-1]
            if len(code):  # labels of the last bucket may be asked for again
                if held != last:
                    stay = np.isin(code, found[mine & (bucket[row] == last)])
                    code, owner = code[stay], owner[stay]
            held = last

    kinds = reads.schema[key].dataType.simpleString(), contigs.schema[label].dataType.simpleString()
    found = met.select("bucket", "run", "n", "word", "_side", "_id").mapInArrow(run, "_id long, _label long, hits long, windows long")
    found = found.select(F.col("_id").cast(kinds[0]).alias(key), F.col("_label").cast(kinds[1]).alias(label), "hits", "windows")
    return found.repartition(key).groupBy(key, label).agg(F.sum("hits").alias("hits"), F.sum("windows").alias("windows"))  # dealt by read, so what ranks a read's labels has them in one place


def sharing(df: DataFrame, key: str, k: int, seq: str = "seq") -> DataFrame:
    """(a, b), a < b: keys, whole numbers, whose sequences share a window of k letters. Stretches meet by bucket, and a task holds those of one bucket; a bucket's pairs leave it once."""
    kind = df.schema[key].dataType.simpleString()
    met = stretches(df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("_id"), seq), k, ("_id",), seq).repartition("bucket").sortWithinPartitions("bucket")

    def pairs(group: np.ndarray, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of rows that are sorted by group and id, each once: all pairs within a group, about PIECE at a time."""
        ends = np.repeat(np.flatnonzero(np.append(group[1:] != group[:-1], True)), np.diff(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])))) if len(group) else np.zeros(0, np.int64)
        more = ends - np.arange(len(group))
        lot = (np.cumsum(more) - more) // PIECE
        for at in np.split(np.arange(len(group)), np.flatnonzero(np.diff(lot)) + 1) if len(group) else []:
            n = more[at]
            a = np.repeat(at, n)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            yield ids[a], ids[b]

    def of_bucket(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, runs, n = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (3, 1, 2))
        words = [w for b in held for w in b.column(4).to_pylist()] if (n == 0).any() else []
        row, code = unrolled(runs, n, k)
        known: dict[str, int] = {}
        odd = np.flatnonzero(n == 0)
        code = np.append(code, np.array([-1 - known.setdefault(words[i], len(known)) for i in odd], np.int64))
        who = ids[np.append(row, odd)]
        order = np.lexsort((who, code))
        code, who = code[order], who[order]
        new = np.concatenate([[True], (code[1:] != code[:-1]) | (who[1:] != who[:-1])])
        for a, b in pairs(code[new], who[new]):
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            first = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole buckets at a time: a bucket's rows may go on in the next batch."""
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            bucket = b.column(0).to_numpy()
            goes_on = int(np.searchsorted(bucket, bucket[-1]))
            if held and (goes_on or held[-1].column(0)[0].as_py() != bucket[0]):
                if goes_on:
                    held.append(b.slice(0, goes_on))
                yield from of_bucket(held)
                held = []
            elif goes_on:
                yield from of_bucket([b.slice(0, goes_on)])
            held.append(b.slice(goes_on))
        if held:
            yield from of_bucket(held)

    found = met.select("bucket", "run", "n", "_id", "word").mapInArrow(run, "a long, b long")
    return found.distinct().select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b"))
