"""Pairwise alignment with affine gaps, by Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators import kmers as K
from strandloom.operators import packed
from strandloom.operators.lineage import cut

NEG = -(10**9)
OUT = ("score", "matches", "mismatches", "gaps")


def align(a: str, b: str, match: int = 4, mismatch: int = -5, gap_open: int = 10, gap_extend: int = 1, local: bool = False) -> dict:
    """Best alignment by affine gaps (N18): score, matches, mismatches, gaps (letters against gaps), and the aligned stretch of a and b (0-based, end exclusive).
    A gap of n letters costs gap_open + (n - 1) gap_extend; global alignments pay for gaps at the ends."""
    n, m = len(a), len(b)
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    best = np.full((3, n + 1, m + 1), NEG, np.int64)  # ends in a pair, in a gap in b, in a gap in a
    best[0, 0, 0] = 0
    if local:
        best[0, 0, :] = best[0, :, 0] = 0
    else:
        best[1, 1:, 0] = -gap_open - gap_extend * np.arange(n)
        best[2, 0, 1:] = -gap_open - gap_extend * np.arange(m)
    along = gap_extend * np.arange(m + 1)
    for i in range(1, n + 1):
        diagonal = best[:, i - 1, :-1].max(0) + np.where(y == x[i - 1], match, mismatch)
        best[0, i, 1:] = np.maximum(diagonal, 0) if local else diagonal
        best[1, i, 1:] = np.maximum(best[0, i - 1, 1:] - gap_open, np.maximum(best[1, i - 1, 1:] - gap_extend, best[2, i - 1, 1:] - gap_open))
        if m:  # a gap in a that ends here began behind the best earlier cell, its length counted off
            reach = np.maximum.accumulate(np.maximum(best[0, i, :-1], best[1, i, :-1]) + along[:-1])
            best[2, i, 1:] = np.maximum(reach - gap_open - along[:-1], NEG)
    if local:
        i, j = np.unravel_index(np.argmax(best[0]), best[0].shape)
        s = 0
    else:
        i, j, s = n, m, int(np.argmax(best[:, n, m]))
    score, end = int(best[s, i, j]), (int(i), int(j))
    matches = mismatches = gaps = 0
    while (i or j) and not (local and s == 0 and best[0, i, j] == 0):
        here = best[s, i, j]
        if s == 0:
            same = x[i - 1] == y[j - 1]
            matches, mismatches = matches + int(same), mismatches + int(not same)
            i, j = i - 1, j - 1
            want = here - (match if same else mismatch)
            found = [t for t in range(3) if best[t, i, j] == want]
            s = found[0] if found else 0
        elif s == 1:
            gaps += 1
            i -= 1
            s = 1 if best[1, i, j] - gap_extend == here and i > 0 else 0 if best[0, i, j] - gap_open == here else 2
        else:
            gaps += 1
            j -= 1
            s = 2 if best[2, i, j] - gap_extend == here and j > 0 else 0 if best[0, i, j] - gap_open == here else 1
    return {"score": score, "matches": matches, "mismatches": mismatches, "gaps": gaps, "a_start": int(i), "a_end": end[0], "b_start": int(j), "b_end": end[1]}


CELLS = 1 << 25  # cells of a lot of pairs, two bytes or more each


def align_lot(a: np.ndarray, b: np.ndarray, match: int = 4, mismatch: int = -5, gap_open: int = 10, gap_extend: int = 1) -> np.ndarray:
    """(score, matches, mismatches, gaps) of global alignments, as ``align`` gives them, for many pairs at a time: letters of a by n, of b by m, a column a pair. A row of all pairs' cells is one step."""
    (n, many), m = a.shape, b.shape[0]
    most = (n + m + 2) * max(map(abs, (match, mismatch, gap_open, gap_extend)))
    kind, neg = (np.int16, -16000) if most < 7000 else (np.int32, -(10**9))
    x = lambda v: kind(v)
    best = np.full((3, n + 1, m + 1, many), neg, kind)
    best[0, 0, 0] = 0
    best[1, 1:, 0] = (-gap_open - gap_extend * np.arange(n)).astype(kind)[:, None]
    best[2, 0, 1:] = (-gap_open - gap_extend * np.arange(m)).astype(kind)[:, None]
    along = (gap_extend * np.arange(m)).astype(kind)[:, None]
    for i in range(1, n + 1):
        p0, p1, p2 = best[:, i - 1]
        either = np.maximum(p0, p2)
        best[0, i, 1:] = np.maximum(either, p1)[:-1] + np.where(b == a[i - 1], x(match), x(mismatch))
        best[1, i, 1:] = np.maximum(either[1:] - x(gap_open), p1[1:] - x(gap_extend))
        if m:
            reach = np.maximum.accumulate(np.maximum(best[0, i, :-1], best[1, i, :-1]) + along, axis=0)
            best[2, i, 1:] = np.maximum(reach - x(gap_open) - along, x(neg))
    who = np.arange(many)
    i, j, s = np.full(many, n), np.full(many, m), np.argmax(best[:, n, m], axis=0)
    out = np.zeros((4, many), np.int64)
    out[0] = best[s, n, m, who]
    while len(who := who[(i[who] > 0) | (j[who] > 0)]):
        at, to, now = i[who], j[who], s[who]
        here = best[now, at, to, who].astype(np.int64)
        pair = now == 0
        same = pair.copy()
        same[pair] = a[at[pair] - 1, who[pair]] == b[to[pair] - 1, who[pair]]
        out[1, who] += same
        out[2, who] += pair & ~same
        out[3, who] += ~pair
        at, to = at - (now < 2), to - (now != 1)
        i[who], j[who] = at, to
        before = best[:, at, to, who].astype(np.int64)
        want = here - np.where(same, match, mismatch)
        first = np.where(before[0] == want, 0, np.where(before[1] == want, 1, np.where(before[2] == want, 2, 0)))
        opened = before[0] - gap_open == here
        up = np.where((before[1] - gap_extend == here) & (at > 0), 1, np.where(opened, 0, 2))
        along_ = np.where((before[2] - gap_extend == here) & (to > 0), 2, np.where(opened, 0, 1))
        s[who] = np.where(pair, first, np.where(now == 1, up, along_))
    return out


def align_all(a: list[str], b: list[str], **costs) -> np.ndarray:
    """As ``align_lot``, of texts of any lengths: those of the same two lengths go together."""
    out = np.zeros((4, len(a)), np.int64)
    lots: dict[tuple[int, int], list[int]] = {}
    x, y = [t.encode() for t in a], [t.encode() for t in b]
    for i, (p, q) in enumerate(zip(x, y, strict=True)):
        lots.setdefault((len(p), len(q)), []).append(i)
    for (n, m), rows in lots.items():
        step = max(1, CELLS // (3 * (n + 1) * (m + 1)))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            letters = [np.ascontiguousarray(np.frombuffer(b"".join(t[i] for i in part), np.uint8).reshape(len(part), k).T) for t, k in ((x, n), (y, m))]
            out[:, part] = align_lot(*letters, **costs)
    return out


def align_pairs(pairs: DataFrame, local: bool = False, **costs) -> DataFrame:
    """All columns of pairs (a_seq, b_seq, ...), with score, matches, mismatches and gaps. Nulls count as empty."""
    names = pairs.columns

    def run(batches):
        for pdf in batches:
            a, b = ([x or "" for x in pdf[c]] for c in ("a_seq", "b_seq"))
            if local:
                each = [align(x, y, local=True, **costs) for x, y in zip(a, b, strict=True)]
                found = np.array([[f[k] for f in each] for k in OUT], np.int64).reshape(len(OUT), len(a))
            else:
                found = align_all(a, b, **costs)
            yield pdf.assign(**{k: pd.Series(found[i], index=pdf.index) for i, k in enumerate(OUT)})[[*names, *OUT]]

    schema = pairs.select(*names, *[F.lit(0).cast("long").alias(k) for k in ("score", "matches", "mismatches", "gaps")]).schema
    return pairs.mapInPandas(run, schema)


def align_sharing(seqs: DataFrame, k: int = 25) -> DataFrame:
    """(id, other, score, matches, mismatches, gaps): whole sequences (id, seq) aligned with all that share a k-mer with them. Equal sequences are aligned
    as one: other is the smallest id of each sequence, so any two ids x and y that share a k-mer are compared in the row of x and the smallest id that
    has y's sequence, and rows grow with ids, not with their pairs. Sequences shorter than k share theirs as a whole."""
    ids = seqs.where("seq IS NOT NULL").select("id", "seq")
    distinct = ids.groupBy("seq").agg(F.min("id").alias("first")).transform(cut)
    if k in packed.STRETCHED and dict(distinct.dtypes)["first"] in ("tinyint", "smallint", "int", "bigint"):
        shared = packed.sharing(distinct.where(F.length("seq") >= k), "first", k)
    else:
        kmers = K.explode_kmers(distinct, k, keep=("first",)).distinct().transform(cut)
        shared = kmers.select("kmer", F.col("first").alias("a")).join(kmers.select("kmer", F.col("first").alias("b")), "kmer").where("a < b").select("a", "b").distinct()
    named = lambda n: distinct.select(F.col("first").alias(n), F.col("seq").alias(f"{n}_seq"))
    pairs = shared.join(named("a"), "a").join(named("b"), "b").repartition("a", "b")
    found = align_pairs(pairs).drop("a_seq", "b_seq").transform(cut)
    long = lambda c: c.cast("long")
    n, no = long(F.octet_length("seq")), long(F.lit(0))
    own = distinct.select(F.col("first").alias("a"), F.col("first").alias("b"), (n * 4).alias("score"), n.alias("matches"), no.alias("mismatches"), no.alias("gaps"))  # a sequence with itself: all letters match
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"), "score", "matches", "mismatches", "gaps")).unionByName(own)
    first = ids.join(distinct, "seq").select("id", F.col("first").alias("a"))
    return first.join(both, "a").where("id != b").select("id", F.col("b").alias("other"), "score", "matches", "mismatches", "gaps")


def too_similar(gaps, mismatches, matches):
    """At most 10 gaps, and at most 2 mismatches or 95 % identity (F21). Columns or numbers."""
    return (gaps <= 10) & ((mismatches <= 2) | (matches / (matches + mismatches + gaps) >= 0.95))
