"""Benchmark decontamination: one Aho-Corasick automaton over normalised test questions and answers.

Texts are lower-cased (A-Z only) and read as words of digits, a-z and characters beyond ASCII. Every run of WINDOW words of a test text is
a pattern; a text of fewer words, but not none, is one pattern. The automaton's letters are words, numbered, so ten words are a path of ten
nodes; a word that no test text has leads back to the root. A document is read once; hits are mapped to code points of the original text.

The patterns are made by Spark and dealt by hash to shards of about SHARD patterns (item and window), so an automaton has a size bound
whatever the size of the benchmark. Up to SHARD patterns there is one automaton. It is built by a task, goes to the shared folder and is loaded by
workers; documents never move.

Odd inputs: a null text has no words and no hits. Null test texts and texts without words have no pattern. Patterns of an item without an id hit words,
but no item is listed for them. Rows that repeat an item's id are one item. Rows that repeat a document's id are scanned one by one. An empty
benchmark hits nothing. Very long texts are read whole. Further columns of the documents stay, whatever their names; the result's column replaces one of its name.
"""

from __future__ import annotations

import pickle
import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import common

WINDOW = 10
SHARD = 80_000  # patterns of an automaton; its words are numbered by characters, of which there are 1.1 million
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOUND = "struct<n_words: bigint, n_hit: bigint, items: array<string>, spans: array<struct<start: bigint, end: bigint>>>"
_FOUND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

_PLAIN = bytes(ord(LOWER[UPPER.index(chr(c))]) if chr(c) in UPPER else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_TOKEN = re.compile(rb"[^ ]+")
_loaded: dict[str, tuple[dict, object]] = {}
common.cache("leaks", _loaded)


def patterns(items: DataFrame, id_col: str = "item_id", text_cols: tuple[str, ...] = ("text",), window: int = WINDOW) -> DataFrame:
    """(item string, words array): the distinct windows of the given text columns, each column for itself."""
    parts = []
    for c in text_cols:
        words = F.regexp_extract_all(F.translate(common.text_or_empty(c), UPPER, LOWER), F.lit(WORD), F.lit(0))
        rows = items.select(F.col(id_col).cast("string").alias("item"), words.alias("words")).where("size(words) > 0")
        starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
        parts.append(rows.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, F.lit(window)))).alias("words")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def build(found: DataFrame, shard: int = SHARD) -> list[str]:
    """Automata of patterns as files in the shared folder: one file for each ``shard`` patterns."""
    spark = found.sparkSession
    found = common.written(found, "patterns")
    n = -(-found.count() // shard)
    if not n:
        return []
    folder = common.scratch(spark, "automata")

    def make(group: pa.Table) -> pa.Table:
        numbers: dict[bytes, str] = {}
        items: dict[str, list] = {}
        for item, words in zip(group.column(1).to_pylist(), group.column(2).to_pylist(), strict=True):
            key = "".join(numbers.setdefault(w.encode(), chr(len(numbers) + 1)) for w in words)
            items.setdefault(key, []).append(item)
        automaton = ahocorasick.Automaton()
        for key, of in items.items():
            automaton.add_word(key, (len(key), tuple(x for x in of if x is not None)))
        automaton.make_automaton()
        store, path = common.open_folder(folder)
        name = f"{uuid.uuid4().hex}.automaton"
        with store.open_output_stream(f"{path}/{name}", compression=None) as f:
            f.write(pickle.dumps((numbers, automaton), pickle.HIGHEST_PROTOCOL))
        return pa.table({"shard": group.column(0)[:1], "name": [name]})

    dealt = found.select(F.pmod(F.xxhash64("item", "words"), F.lit(n)).alias("shard"), "item", "words")
    made = common.written(dealt.groupBy("shard").applyInArrow(make, "shard long, name string"), "automaton-names")
    return [f"{folder}/{r.name}" for r in made.orderBy("shard").collect()]


def load(file: str) -> tuple[dict, object]:
    """(numbers of words, automaton) of a file; a worker holds the last one."""
    if file not in _loaded:
        _loaded.clear()
        folder, name = file.rsplit("/", 1)
        store, path = common.open_folder(folder)
        with store.open_input_stream(f"{path}/{name}", compression=None) as f:
            _loaded[file] = pickle.loads(f.read())
    return _loaded[file]


def plain(text: str) -> bytes:
    """The normalised text: as many bytes as the text has in UTF-8, words between spaces."""
    return text.encode("utf-8", "replace").translate(_PLAIN)


def occurrences(normal: bytes, numbers: dict, automaton) -> Iterator[tuple[int, int, tuple]]:
    """(first word, word after the last, items) of every place where a pattern stands."""
    for last, (n, items) in automaton.iter("".join(map(numbers.get, normal.split(), repeat("\0")))):
        yield last + 1 - n, last + 1, items


def stretches(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and adjoining ranges joined."""
    out: list[list[int]] = []
    for s, e in sorted(found):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def places(normal: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as ranges of code points of the text."""
    edges = np.array([m.span() for m in _TOKEN.finditer(normal)], np.int64).reshape(-1, 2)
    raw = np.frombuffer(normal, np.uint8)
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points that start before each byte
    return [(int(before[edges[s, 0]]), int(before[edges[e - 1, 1]])) for s, e in ranges]


def scan(docs: DataFrame, automata: list[str], text_col: str = "text", name: str = "found") -> DataFrame:
    """docs with a struct: n_words, n_hit (words inside any occurrence), items (sorted ids whose patterns occur), spans (start and end, in code points of the
    original text, of each maximal run of hit words)."""
    docs = docs.drop(name)
    at = docs.columns.index(text_col)
    schema = docs.withColumn(name, F.lit(None).cast(FOUND)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("leaks")
        for b in common.slices(batches) if len(automata) < 2 else batches:
            texts = [plain(t.as_py() or "") for t in b.column(at)]
            ranges: list[list] = [[] for _ in texts]
            items: list[set] = [set() for _ in texts]
            for file in automata:
                numbers, automaton = load(file)
                for k, t in enumerate(texts):
                    for s, e, of in occurrences(t, numbers, automaton):
                        ranges[k].append((s, e))
                        items[k].update(of)
            out = []
            for t, r, of in zip(texts, ranges, items, strict=True):
                joined = stretches(r)
                spans = [{"start": s, "end": e} for s, e in places(t, joined)] if joined else []
                out.append({"n_words": len(t.split()), "n_hit": sum(e - s for s, e in joined), "items": sorted(of), "spans": spans})
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, _FOUND)], schema=b.schema.append(pa.field(name, _FOUND)))

    return common.over_arrow(docs, run, schema)


def cleaned(text: str = "text", found: str = "found"):
    """The text without its hit stretches; null stays null."""
    keep = F.expr(
        f"""transform(sequence(0, size({found}.spans)), i -> named_struct(
            'a', if(i = 0, 0, {found}.spans[i - 1].end), 'b', if(i = size({found}.spans), length({text}), {found}.spans[i].start)))"""
    )
    rest = F.array_join(F.transform(keep, lambda k: F.substring(F.col(text), (k.a + 1).cast("int"), (k.b - k.a).cast("int"))), "")
    return F.when(F.col(text).isNotNull(), rest)


def op11(spark, sf_dir: str) -> DataFrame:
    """What of benchmark stands in every document."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, build(patterns(common.table(spark, sf_dir, "benchmark"))))
    items = F.col("found.items")
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), F.col("found.n_hit").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (F.col("found.n_hit") > 0).alias("contaminated"),
    )


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
OP11_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS MATERIALIZED (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(list_slice(w, p, p + {WINDOW - 1}), ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS p FROM i WHERE len(w) > 0) x),
dw AS (SELECT r, p, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) l WHERE len(w) >= n) x),
m AS MATERIALIZED (SELECT r, p, n, item_id FROM dw JOIN iw USING (n, win)),
h AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM m) x GROUP BY r),
k AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT r, item_id FROM m WHERE item_id IS NOT NULL) x GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN k USING (r)
"""
