"""Filter interaction audit: what each of several filters removes, alone and after any others, from a packed bitmap index.

The index has a row for each block of rows and each part in it: the number of rows and, for each filter and mark, a bitset (64 rows a word) of
the rows that fail the filter or bear the mark. Within a block rows are sorted by part and each part starts a new word, so a part's own bitset is its run
of words, and work grows with rows and not with rows times parts. From the index, every task counts by AND-NOT and popcount how many rows, marked rows included, pass each subset of the
filters; those counts are summed over partitions. Every order's steps follow from them, as a step's rows are those that pass the filters before it.

With k filters there are 2**k subsets, and k! orders of k steps in the table of steps, so ``steps`` takes six filters at most.

Odd inputs: a null filter or mark counts as false, a null part as the empty string. Rows that repeat an id are counted each. An empty table has no parts, so no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm import common, graphs

BLOCK = 1 << 20  # rows of a block at most


def index(rows: DataFrame, part: Column, filters: dict[str, Column], marks: dict[str, Column]) -> DataFrame:
    """(part, n, one binary column a filter and a mark): the bitmap index. filters: what fails. Filters and marks have names of their own, other than part, n, subset and kept."""
    names = [*filters, *marks]
    flags = F.lit(0)
    for k, c in enumerate([*filters.values(), *marks.values()]):
        flags = flags + F.when(c, 1 << k).otherwise(0)
    slim = rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), flags.cast("int").alias("flags"))

    def block(parts: pa.Array, flags: np.ndarray) -> pa.RecordBatch:
        found = parts.dictionary_encode()
        code = found.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        n = np.bincount(code, minlength=len(found.dictionary))
        words = -(-n // 64)
        first = np.cumsum(words) - words
        bit = np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first * 64, n)
        spread = np.zeros(int(words.sum()) * 64, np.int32)
        spread[bit] = flags[order]
        out = [found.dictionary, pa.array(n.astype(np.int64))]
        for k in range(len(names)):
            bits = np.packbits((spread >> k & 1).astype(bool), bitorder="little")
            out.append(pa.array([bits[8 * f : 8 * (f + w)].tobytes() for f, w in zip(first.tolist(), words.tolist(), strict=True)], pa.binary()))
        return pa.RecordBatch.from_arrays(out, ["part", "n", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            for i in range(0, b.num_rows, BLOCK):
                held.append(b.slice(i, BLOCK))
                n += held[-1].num_rows
                if n >= BLOCK:
                    yield of(held)
                    held, n = [], 0
        if n:
            yield of(held)

    def of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        return block(t.column(0).combine_chunks(), t.column(1).to_numpy())

    schema = "part string, n long, " + ", ".join(f"`{x}` binary" for x in names)
    return slim.mapInArrow(run, schema)


def subset_counts(bitmaps: DataFrame, filters: list[str], marks: list[str]) -> DataFrame:
    """(part, subset, kept, one column a mark): rows of each part that pass all filters of a subset, a number with bit k for filter k."""
    k, width = len(filters), 1 + len(marks)
    subsets = 1 << k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(1).to_numpy()
            words = -(-n // 64)
            first = np.cumsum(words) - words
            col = lambda c: np.frombuffer(b"".join(x.as_py() for x in b.column(c)), np.uint64)
            live = np.full(int(words.sum()), ~np.uint64(0))
            rest = n - 64 * (words - 1)  # rows in a part's last word
            live[first + words - 1] >>= (64 - rest).astype(np.uint64)
            fails, marked = [col(2 + i) for i in range(k)], [col(2 + k + i) for i in range(len(marks))]
            passing = [live]
            for s in range(1, subsets):
                top = s.bit_length() - 1
                passing.append(passing[s ^ (1 << top)] & ~fails[top])
            count = lambda bits: np.add.reduceat(np.bitwise_count(bits).astype(np.int64), first)
            found = np.array([[count(p), *(count(p & m) for m in marked)] for p in passing])  # subset, column, row of the index
            parts = b.column(0).take(pa.array(np.repeat(np.arange(len(n)), subsets)))
            flat = found.transpose(1, 2, 0).reshape(width, -1)
            yield pa.RecordBatch.from_arrays([parts, pa.array(np.tile(np.arange(subsets, dtype=np.int32), len(n))), *map(pa.array, flat)], names)

    names = ["part", "subset", "kept", *marks]
    some = bitmaps.where("n > 0").select("part", "n", *filters, *marks)
    got = some.mapInArrow(run, "part string, subset int, kept long" + "".join(f", `{m}` long" for m in marks))
    return got.groupBy("part", "subset").agg(*(F.sum(c).alias(c) for c in names[2:]))


def steps(counts: DataFrame, filters: list[str], marks: dict[str, str]) -> DataFrame:
    """A row for each part, order of the filters and step, from ``subset_counts``. marks: mark to the name of its column of losses."""
    k = len(filters)
    if k > 6:
        raise ValueError("the table of steps takes six filters at most")
    every = (1 << k) - 1
    of_part = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("subset", F.struct("kept", *marks)))).alias("c"))
    table = []
    for order in permutations(range(k)):
        before = 0
        for at, f in enumerate(order):
            table.append(f"named_struct('o', '{''.join(filters[x] for x in order)}', 's', {at + 1}, 'f', {f}, 'b', {before}, 'a', {before | 1 << f})")
            before |= 1 << f
    c = lambda subset, name="kept": f"c[{subset}].{name}"
    shares = []
    for f in range(k):
        others = [s for s in range(every + 1) if not s >> f & 1]
        weight = lambda s: factorial(bin(s).count("1")) * factorial(k - 1 - bin(s).count("1"))
        shares.append(" + ".join(f"{weight(s)} * ({c(s)} - {c(s | 1 << f)})" for s in others))
    rows = of_part.selectExpr("part", "c", f"array({', '.join(shares)}) AS shares").select("part", "c", "shares", F.explode(F.expr(f"array({', '.join(table)})")).alias("t"))
    removed = f"{c('t.b')} - {c('t.a')}"
    alone = f"{c(f'{every} - shiftleft(1, t.f)')} - {c(every)}"
    fails = f"{c(0)} - {c('shiftleft(1, t.f)')}"
    return rows.selectExpr(
        "part", "t.o AS filter_order", "t.s AS step", f"{c('t.a')} AS kept", f"{removed} AS removed", f"({fails}) - ({removed}) AS redundant", f"{alone} AS unique_fails",
        *(f"{c('t.b', m)} - {c('t.a', m)} AS {name}" for m, name in marks.items()), "shares[t.f] AS shapley",
    )


UPPER, CONTINUED, ODD = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", bytes(range(128, 192)), b"#$%&*|"


def text_facts(docs: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, part, words, distinct, upper, points, odd, digest) of every whole text; digest is SHA-256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("audit")
        for b in common.slices(batches):
            rows = []
            for t in b.column(2):
                raw = t.as_py() or b""
                words = raw.split()
                n = len(raw)
                rows.append((len(words), len(set(words)), n - len(raw.translate(None, UPPER)), len(raw.translate(None, CONTINUED)), len(raw.translate(None, ODD)) < n, hashlib.sha256(raw).digest()))
            out = zip(*rows, strict=True)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x, t) for x, t in zip(out, kinds, strict=True))], ["id", "part", "words", "distinct", "upper", "points", "odd", "digest"])

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), common.text_or_empty(text_col).cast("binary").alias("text"))
    return slim.mapInArrow(run, "id long, part string, words long, distinct long, upper long, points long, odd boolean, digest binary")


def with_first(facts: DataFrame) -> DataFrame:
    """facts (a written table) with first: the smallest id whose text is the same, by digest. A text that a large share of rows has is split."""
    least = facts.groupBy("digest").agg(F.min("id").alias("first"))
    parts, _ = graphs.frequent(facts, "digest")
    if parts is None:
        return facts.join(least, "digest")
    return graphs.matched(facts.withColumn("row", F.monotonically_increasing_id()), least, "digest", "row", parts).drop("row")


def with_labels(facts: DataFrame, labels: DataFrame, id_col: str = "doc_id", cols: tuple[str, ...] = ("quality", "toxic")) -> DataFrame:
    """facts with a boolean for each label: whether any label row of the id says 1. Rows without an id have no labels."""
    rows = labels.where(F.col(id_col).isNotNull())
    one = rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(*(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c) for c in cols))
    named = facts.where("id IS NOT NULL").join(one.where(" OR ".join(cols)), "id", "left")
    return named.unionByName(facts.where("id IS NULL").withColumns({c: F.lit(False) for c in cols}))


def filters() -> dict[str, Column]:
    """What fails the five filters of op12."""
    return {"A": F.expr("words < 50"), "B": F.expr("100 * distinct < 65 * words"), "C": F.expr("100 * upper > 5 * points"), "D": F.expr("odd"), "E": F.expr("id > first")}


def op12(spark, sf_dir: str) -> DataFrame:
    """Every order of five filters over every document, by source."""
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    facts = common.written(text_facts(docs), "facts")
    rows = with_labels(with_first(facts), labels)
    marks = {"quality": "good_lost", "toxic": "toxic_lost"}
    bitmaps = common.written(index(rows, F.col("part"), filters(), {m: F.col(m) for m in marks}), "bitmaps")
    return steps(subset_counts(bitmaps, list(filters()), list(marks)), list(filters()), marks)


OP12_SQL = """
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
m AS (SELECT text, min(doc_id) AS first FROM t GROUP BY text),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels GROUP BY doc_id),
f AS MATERIALIZED (SELECT t.part, coalesce(l.good, false) AS good, coalesce(l.bad, false) AS bad, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 5 * length(t.text),
        regexp_matches(t.text, '[#$%&*|]'), coalesce(t.doc_id > m.first, false)] AS fails FROM t JOIN m ON m.text = t.text LEFT JOIN l ON l.doc_id = t.doc_id),
e AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM e a, e b, e c, e d, e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, ascii(substr(filter_order, step, 1)) - 64 AS k, list_transform(string_split(substr(filter_order, 1, step - 1), ''), lambda c: ascii(c) - 64) AS prior FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o) x),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM f GROUP BY part, fails),
r AS (SELECT part, filter_order, step, k, n, good, bad, fails[k] AS now, step > 1 AND list_bool_or(list_transform(prior, lambda p: fails[p])) AS gone, len(list_filter(fails, lambda x: x)) AS all_fails FROM g, s),
q AS (SELECT part, filter_order, step, k, coalesce(sum(n) FILTER (NOT gone AND NOT now), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND now), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (gone AND now), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (now AND all_fails = 1), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (NOT gone AND now), 0)::BIGINT AS good_lost, coalesce(sum(bad) FILTER (NOT gone AND now), 0)::BIGINT AS toxic_lost FROM r GROUP BY part, filter_order, step, k)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley FROM q
"""
