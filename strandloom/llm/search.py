"""Exact top-k search: BM25 over inverted indexes with block-max WAND, a shard at a time.

*Index.* Each task makes parts of at most PART_POSTINGS postings of the rows that it reads. Terms' document frequencies are summed over all parts and handed back,
and parts are joined to shards of about SHARD_POSTINGS. A shard numbers its documents by most frequent term and length, so that blocks of BLOCK numbers hold
similar documents. A term's postings are cut by block; a cut has an entry with the block, where its postings start, and the largest of their impacts. An impact is a
whole number, round(idf * tf part * SCALE), so sums are exact in any order. A posting takes five bytes in a file: its place in the block and its impact.

*Queries.* A query is its whole text: a term counts as often as it stands there (or once, by choice). Equal texts of a block of queries are searched for once. A task takes a block
of queries over GROUP shards and carries each query's k best, and so its threshold, from shard to shard. No name, query or frequency is broadcast.

*Pivots.* A query's terms have cursors over their entries. As in WAND, terms' largest impacts are added first: where all together stay below the threshold,
no document of the shard is a pivot. A block is one if the maxima of its entries reach the threshold; cursors jump over all others, whose postings
are never read. While there is no threshold yet, the blocks of the highest bounds are taken first. Pivots then come in the order of documents, few at a time and then more,
and each time the threshold has risen those ahead that no longer reach it are passed over. In a pivot block, terms that only together could lift a document to the threshold
are read first; the others are read in blocks where a document seen so far can still reach it with their maxima. Pivots are blocks rather than documents since a step over one
document costs as much here as the summing of a block.

The best of each group of shards are merged, ties by the smaller id, so the result is the exact top k. Null and empty texts match nothing and, as queries, find nothing; rows with a null id
are no documents and no queries. Rows that repeat an id are documents of their own and may both be found; as queries, each finds its k, ranked together under the id, so those have the best k of all. A query has fewer than k
hits if fewer documents share a term with it. A document finds itself.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm import common

K = 10
K1, B = 1.2, 0.75
SCALE = 65536
BLOCK = 128
PART_POSTINGS = 2_000_000
SHARD_POSTINGS = 4_000_000
GROUP = 32  # shards that one task takes a block of queries through
QUERY_BLOCK = 512  # different queries of a block,
QUERY_TERMS = 500_000  # and their terms at most (but for a query alone)
SEEDS, FIRST_PIVOTS = 2, 8
EVERY = 20

_WORD = re.compile(r"[^\W_]+")
_MOST_WORDS = 400_000


class _Terms(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= _MOST_WORDS:
            self.clear()
        self[word] = value
        return value


_terms = _Terms()
common.cache("search", _terms)


def counted(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted term hashes, counts) of a text."""
    found = _WORD.findall((text or "").lower())
    return np.unique(np.fromiter(map(_terms.__getitem__, found), np.uint64, len(found)), return_counts=True)


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all [start, end), one after the other."""
    size = ends - starts
    if not len(size) or not size.sum():
        return np.zeros(0, np.int64)
    before = np.cumsum(size) - size
    return np.repeat(starts - before, size) + np.arange(size.sum())


def narrow(x: np.ndarray) -> np.ndarray:
    """The numbers, none below 0, in as few bytes as the largest one needs."""
    most = int(x.max(initial=0))
    return x.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


def part_of(ids: list[int], texts: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
    """The postings of some documents, by term: terms, how many documents have each, documents (numbers in ids) and counts; ids, lengths and most frequent terms of documents."""
    sizes = np.array([len(t) for t, _ in texts], np.int64)
    term = np.concatenate([np.zeros(0, np.uint64), *(t for t, _ in texts)])
    count = np.concatenate([np.zeros(0, np.int64), *(c for _, c in texts)]).astype(np.int32)
    by = np.argsort(term, kind="stable")
    terms, df = np.unique(term, return_counts=True)
    length = np.array([int(c.sum()) for _, c in texts], np.int64)
    top = np.array([t[np.argmax(c)] if len(t) else 0 for t, c in texts], np.uint64)
    docs = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)[by]
    return {"terms": terms, "df": df.astype(np.int64), "docs": narrow(docs), "counts": narrow(count[by]), "ids": np.array(ids, np.int64), "lengths": length, "tops": top}


def shard_of(parts: list[dict[str, np.ndarray]], n_docs: int, mean_length: float) -> dict[str, np.ndarray]:
    """The index of the documents of some parts, whose "df" are those over all rows."""
    ids, length, top = (np.concatenate([p[k] for p in parts]) for k in ("ids", "lengths", "tops"))
    order = np.lexsort((ids, length, top))
    number = np.empty(len(ids), np.int32)
    number[order] = np.arange(len(ids), dtype=np.int32)
    before = np.cumsum([0, *(len(p["ids"]) for p in parts)])
    doc = number[np.concatenate([p["docs"].astype(np.int64) + b for p, b in zip(parts, before, strict=False)])]
    term = np.concatenate([np.repeat(p["terms"], p["sizes"]) for p in parts])
    terms, which = np.unique(np.concatenate([p["terms"] for p in parts]), return_index=True)
    df = np.concatenate([p["df"] for p in parts])[which]
    by = np.lexsort((doc, term))
    doc, size = doc[by], np.diff(np.append(np.searchsorted(term[by], terms), len(term)))
    del term
    tf = np.concatenate([p["counts"] for p in parts])[by].astype(np.float64)
    del by
    idf = np.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))
    tf = tf * (K1 + 1.0) / (tf + K1 * (1.0 - B + B * length[order][doc] / mean_length))
    impact = np.rint(np.repeat(idf, size) * tf * SCALE).astype(np.int32)
    del tf
    block = doc // BLOCK
    at = np.cumsum([0, *size])
    new = np.concatenate([[True], block[1:] != block[:-1], [True]]) if len(doc) else np.zeros(1, bool)
    new[at[:-1]] = True
    starts = np.flatnonzero(new)
    largest = np.maximum.reduceat(impact, at[:-1]) if len(terms) else impact
    return {
        "terms": terms, "entries": np.searchsorted(starts, at).astype(np.int32), "cuts": np.diff(starts).astype(np.uint8), "blocks": narrow(block[starts[:-1]] if len(doc) else block),
        "largest": largest, "places": (doc % BLOCK).astype(np.uint8), "impacts": impact, "ids": ids[order],
    }


class Searcher:
    """A shard's index."""

    def __init__(self, index: dict[str, np.ndarray]):
        self.terms, self.entries, self.largest, self.impacts, self.ids = (index[k] for k in ("terms", "entries", "largest", "impacts", "ids"))
        self.blocks = index["blocks"].astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(index["cuts"], dtype=np.int64)])
        self.most = np.maximum.reduceat(self.impacts, self.starts[:-1]) if len(self.blocks) else self.impacts
        self.docs = index["places"] + np.repeat(self.blocks * BLOCK, index["cuts"])
        self.n_blocks = -(-len(self.ids) // BLOCK)

    def _sums(self, entry: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the postings of these entries add to each document."""
        start, end = self.starts[entry], self.starts[entry + 1]
        posting, size = ranges(start, end), end - start
        return np.bincount(self.docs[posting], weights=self.impacts[posting] * np.repeat(weight, size), minlength=self.n_blocks * BLOCK)

    def top(self, terms: np.ndarray, counts: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best of these documents and of ``best``, best first, ties by id. counts: how often each term counts."""
        ids, scores = best or (np.zeros(0, np.int64), np.zeros(0, np.int64))
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        at, weight = at[known], counts[known].astype(np.int64)
        reach = self.largest[at] * weight
        threshold = int(scores[k - 1]) if len(scores) >= k else 0
        if not len(at) or reach.sum() < threshold:
            return ids, scores
        order = np.argsort(-reach, kind="stable")
        at, weight = at[order], weight[order]
        rest = np.append(reach[order][::-1].cumsum()[::-1], 0)  # what terms from the i-th on can add
        first, last = self.entries[at], self.entries[at + 1]
        entry, cuts = ranges(first, last), last - first
        block, weight = self.blocks[entry], np.repeat(weight, cuts)
        after = np.cumsum(cuts)  # entries of the terms up to the i-th
        most = self.most[entry] * weight
        bound = np.bincount(block, weights=most, minlength=self.n_blocks)

        def evaluate(pivots: np.ndarray) -> None:
            nonlocal ids, scores, threshold
            here = np.zeros(self.n_blocks, bool)
            here[pivots] = True
            chosen = np.flatnonzero(here[block])
            # terms from the ``strong``-th on can't lift a document to the threshold by themselves
            strong = int(np.searchsorted(-rest, -threshold, "right")) if threshold else len(at)
            cut = int(np.searchsorted(chosen, after[strong - 1])) if strong else 0
            now, later = chosen[:cut], chosen[cut:]
            sums = self._sums(entry[now], weight[now])
            if len(later):
                more = np.bincount(block[later], weights=most[later], minlength=self.n_blocks)
                able = (sums > 0) & (sums + np.repeat(more, BLOCK) >= threshold)
                here[:] = False
                here[np.flatnonzero(able) // BLOCK] = True
                later = later[here[block[later]]]
                sums = np.where(able, sums, -1.0)
                if len(later):
                    sums += np.where(able, self._sums(entry[later], weight[later]), 0.0)
            seen = np.flatnonzero((sums > 0) & (sums >= threshold))
            if len(seen):
                ids, scores = np.concatenate([ids, self.ids[seen]]), np.concatenate([scores, sums[seen].astype(np.int64)])
                if len(scores) > 4 * k:
                    keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                    ids, scores = ids[keep], scores[keep]
                order = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[order], scores[order]
                if len(scores) >= k:
                    threshold = int(scores[k - 1])

        pivots = np.flatnonzero(bound > 0)
        if not threshold:
            seeds = pivots[np.argsort(-bound[pivots], kind="stable")[:SEEDS]]
            evaluate(seeds)
            pivots = np.setdiff1d(pivots, seeds, assume_unique=True)
        few = FIRST_PIVOTS
        while True:
            pivots = pivots[bound[pivots] >= threshold]
            if not len(pivots):
                return ids, scores
            evaluate(pivots[:few])
            pivots, few = pivots[few:], 4 * few


def _saved(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """A file of arrays: the length of a directory, the directory, the arrays' bytes."""
    store, path = common.open_folder(folder)
    head = json.dumps([(k, a.dtype.str, len(a)) for k, a in arrays.items()]).encode()
    head += b" " * (-len(head) % 8)
    with store.open_output_stream(f"{path}/{name}", compression=None) as f:
        f.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            f.write(np.ascontiguousarray(a).data)
            f.write(b"\0" * (-a.nbytes % 8))


def _loaded(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays, as views of one buffer."""
    store, path = common.open_folder(folder)
    with store.open_input_file(f"{path}/{name}") as f:
        data = f.read_buffer(f.size())
    at = 8 + int(np.frombuffer(data, np.int64, 1)[0])
    out = {}
    for k, kind, n in json.loads(data[8:at].to_pybytes()):
        out[k] = np.frombuffer(data, kind, n, at)
        at += -(-out[k].nbytes // 8) * 8
    return out


_PART = "shard string, terms binary, dfs binary, docs long, length long, postings long"


def write_parts(docs: DataFrame, folder: str) -> DataFrame:
    """Files of the parts of (id, text). Gives _PART rows, some a part: packed hashes of terms, their document frequencies in the part; and once a part how many
    documents, words and postings it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("search")
        ids, texts, postings = [], [], 0

        def flush() -> pa.RecordBatch:
            part = part_of(ids, texts)
            name = f"part-{uuid.uuid4().hex}"
            _saved(f"{folder}/parts", name, part)
            terms, df = part["terms"], part["df"]
            rows = max(1, -(-len(df) // 50_000))
            facts = (len(ids), int(part["lengths"].sum()), len(part["docs"]))
            cols = zip(*((name, terms[k::rows].tobytes(), df[k::rows].tobytes(), *(facts if k == 0 else (0, 0, 0))) for k in range(rows)), strict=True)
            ids.clear()
            texts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["shard", "terms", "dfs", "docs", "length", "postings"])

        for b in common.slices(batches):
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids.append(key)
                texts.append(counted(text.as_py()))
                postings += len(texts[-1][0])
                if postings >= PART_POSTINGS:
                    postings = 0
                    yield flush()
        if ids:
            yield flush()

    return common.written(docs.mapInArrow(run, _PART), "parts")


def write_shards(parts: DataFrame, folder: str, n_docs: int, mean_length: float) -> DataFrame:
    """Joins parts (shard, df, the names of their files) to shards of at least SHARD_POSTINGS postings, but for a task's last one; gives their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("search")
        held: list[dict] = []

        def flush() -> pa.RecordBatch:
            name = f"shard-{uuid.uuid4().hex}"
            _saved(folder, name, shard_of(held, n_docs, mean_length))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

        for b in batches:
            for part, df in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                arrays = _loaded(f"{folder}/parts", part)
                held.append(arrays | {"sizes": arrays["df"], "df": _loaded(f"{folder}/parts", df)["df"]})
                if sum(len(p["docs"]) for p in held) >= SHARD_POSTINGS:
                    yield flush()
        if held:
            yield flush()

    return common.written(parts.select("shard", "df").mapInArrow(run, "name string"), "shards")


def spread_frequencies(shards: DataFrame, folder: str, partitions: int) -> DataFrame:
    """Writes each shard's terms' frequencies over all rows next to its index; gives the names of the shards. Terms travel packed by hash
    range and task, counts are summed there, and go back packed to the shards that asked."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, terms, dfs in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                t, d = np.frombuffer(terms.as_py(), np.uint64), np.frombuffer(dfs.as_py(), np.int64)
                part = (t % np.uint64(partitions * 4)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                edges = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1], [True]]))
                if not len(t):
                    continue
                rows = [(int(part[order[s]]), shard, t[order[s:e]].tobytes(), d[order[s:e]].tobytes()) for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.string(), pa.binary(), pa.binary()), strict=True)], ["part", "shard", "terms", "dfs"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        if not rows:
            return
        terms = [np.frombuffer(r[2], np.uint64) for r in rows]
        every, back = np.unique(np.concatenate(terms), return_inverse=True)
        sums = np.bincount(back, weights=np.concatenate([np.frombuffer(r[3], np.int64) for r in rows])).astype(np.int64)
        for r, t in zip(rows, terms, strict=True):
            yield pa.RecordBatch.from_arrays([pa.array([r[1]]), pa.array([t.tobytes()], pa.binary()), pa.array([sums[np.searchsorted(every, t)].tobytes()], pa.binary())], ["shard", "terms", "dfs"])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list] = {}
        for b in batches:
            for shard, t, d in zip(*(c.to_pylist() for c in b.columns), strict=True):
                got.setdefault(shard, []).append((np.frombuffer(t, np.uint64), np.frombuffer(d, np.int64)))
        for shard, parts in got.items():
            t, d = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            name = f"df-{uuid.uuid4().hex}"
            _saved(f"{folder}/parts", name, {"df": d[np.argsort(t)]})
            yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([name])], ["shard", "df"])

    sent = shards.select("shard", "terms", "dfs").mapInArrow(cut, "part int, shard string, terms binary, dfs binary").repartition(partitions, "part")
    back = sent.mapInArrow(total, "shard string, terms binary, dfs binary").repartition(partitions, "shard")
    return common.written(back.mapInArrow(save, "shard string, df string"), "shard-frequencies")


def write_queries(queries: DataFrame, folder: str, repeats: bool) -> DataFrame:
    """Query blocks as files; gives their names. ``of`` has the place of each id's query among the different ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("search")
        ids: list[int] = []
        of: list[int] = []
        places: dict[tuple[bytes, bytes], int] = {}
        terms = 0

        def flush() -> pa.RecordBatch:
            name = f"queries-{uuid.uuid4().hex}"
            sizes = [len(t) // 8 for t, _ in places]
            _saved(folder, name, {"ids": np.array(ids, np.int64), "of": np.array(of, np.int64), "offsets": np.cumsum([0, *sizes]), "terms": np.frombuffer(b"".join(t for t, _ in places), np.uint64), "counts": np.frombuffer(b"".join(c for _, c in places), np.int64)})
            ids.clear()
            of.clear()
            places.clear()
            return pa.RecordBatch.from_arrays([pa.array([name])], ["file"])

        for b in common.slices(batches):
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t, c = counted(text.as_py())
                query = (t.tobytes(), (c if repeats else np.ones_like(c)).astype(np.int64).tobytes())
                if query not in places and (len(places) >= QUERY_BLOCK or (places and terms + len(t) > QUERY_TERMS)) or len(ids) >= 100 * QUERY_BLOCK:
                    yield flush()
                    terms = 0
                if query not in places:
                    places[query] = len(places)
                    terms += len(t)
                ids.append(key)
                of.append(places[query])
        if ids:
            yield flush()

    return common.written(queries.mapInArrow(run, "file string"), "query-blocks")


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, repeats: bool = True) -> DataFrame:
    """(query_id, rank, id, score) of the k best documents of each query. queries: the same columns. repeats: a query's term counts as
    often as it stands in the query, else once."""
    spark = docs.sparkSession
    folder = common.scratch(spark, "bm25")
    plain = lambda df: df.select(F.col(id_col).cast("long").alias("id"), common.text_or_empty(text_col).alias("text")).where("id IS NOT NULL")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = write_parts(plain(docs), folder)
    n_docs, words, postings = (x or 0 for x in parts.agg(F.sum("docs"), F.sum("length"), F.sum("postings")).first())
    named = spread_frequencies(parts, folder, partitions)
    n_shards = max(1, -(-postings // SHARD_POSTINGS))
    shards = write_shards(named.repartition(n_shards, "shard"), folder, n_docs, max(words, 1) / max(1, n_docs))
    common.remove(spark, f"{folder}/parts")  # shards are written, and nothing reads their parts again
    groups = max(1, -(-shards.count() // GROUP))
    grouped = shards.groupBy(F.pmod(F.xxhash64("name"), F.lit(groups)).alias("group")).agg(F.sort_array(F.collect_list("name")).alias("names"))
    blocks = write_queries(plain(queries), folder, repeats).withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    todo = common.written(blocks.join(grouped, "group").select("file", "names"), "searches")  # a row a block of queries and group of shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("search")
        for b in batches:
            for file, names in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                q = _loaded(folder, file)
                found: list = [None] * (len(q["offsets"]) - 1)
                for name in names:
                    searcher = Searcher(_loaded(folder, name))
                    for i in range(len(found)):
                        s, e = q["offsets"][i], q["offsets"][i + 1]
                        found[i] = searcher.top(q["terms"][s:e], q["counts"][s:e], k, found[i])
                sizes = np.array([len(found[i][0]) for i in q["of"].tolist()], np.int64)
                for s in range(0, len(sizes), 1000):
                    mine = [found[i] for i in q["of"][s : s + 1000].tolist()]
                    cols = np.repeat(q["ids"][s : s + 1000], sizes[s : s + 1000]), np.concatenate([f[0] for f in mine]), np.concatenate([f[1] for f in mine])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "id", "points"])

    found = todo.repartition(max(1, min(todo.count(), 4 * partitions))).mapInArrow(run, "query_id long, id long, points long")
    best = Window.partitionBy("query_id").orderBy(F.desc("points"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), (F.col("points") / SCALE).alias("score"))


def op8(spark, sf_dir: str) -> DataFrame:
    """The best documents for every document whose id is divisible by EVERY, as a query of its whole text."""
    docs = common.table(spark, sf_dir, "documents")
    return search(docs, docs.where(F.col("doc_id") % EVERY == 0))


OP8_SQL = f"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS w FROM documents WHERE text IS NOT NULL),
tf AS (SELECT doc_id, w, count(*)::DOUBLE AS tf FROM words GROUP BY doc_id, w),
len AS (SELECT doc_id, sum(tf) AS dl FROM tf GROUP BY doc_id),
stat AS (SELECT (SELECT count(*) FROM documents)::DOUBLE AS n, (SELECT sum(dl) FROM len) / (SELECT count(*) FROM documents) AS mean),
df AS (SELECT w, count(*)::DOUBLE AS df FROM tf GROUP BY w),
impact AS (SELECT doc_id, w, CAST(round_even(ln(1.0 + (n - df + 0.5) / (df + 0.5)) * (tf * ({K1} + 1.0) / (tf + {K1} * (1.0 - {B} + {B} * dl / mean))) * {SCALE}, 0) AS BIGINT) AS points FROM tf JOIN df USING (w) JOIN len USING (doc_id), stat),
hits AS (SELECT q.doc_id AS query_id, i.doc_id, sum(q.tf * i.points)::BIGINT AS points FROM tf q JOIN impact i USING (w) WHERE q.doc_id % {EVERY} = 0 GROUP BY q.doc_id, i.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY points DESC, doc_id) AS rank FROM hits)
SELECT query_id, rank::INTEGER AS rank, doc_id, points / {SCALE}.0::DOUBLE AS score FROM ranked WHERE rank <= {K}
"""
