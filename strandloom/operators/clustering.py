"""Contig clustering: overlaps, welding support, components, bounded groups, reads by component."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions import seq as S
from strandloom.operators import kmers as K
from strandloom.operators import packed
from strandloom.operators import welds as WE
from strandloom.operators.lineage import cut

WHOLE = ("tinyint", "smallint", "int", "bigint")


def shared_kmer_pairs(contigs: DataFrame, k: int, both_strands: bool = True) -> DataFrame:
    """(a, b, kmer) of contigs that share a k-mer on either strand."""
    own = K.explode_kmers(contigs, k, keep=("contig",))
    other = own.unionByName(own.select("contig", S.revcomp(F.col("kmer")).alias("kmer"))) if both_strands else own
    a, b = own.select(F.col("contig").alias("a"), "kmer").distinct(), other.select(F.col("contig").alias("b"), "kmer").distinct()
    return a.join(b, "kmer").where("a < b").select("a", "b", "kmer").distinct()


def weldmers(contigs: DataFrame, k: int, flank: int) -> DataFrame:
    """(a, b, weldmer): left flank of one contig, a shared k-mer, right flank of the other (A01). Only windows with full flanks count."""
    own = K.explode_kmers(contigs, k, keep=("contig", "seq"), position=True)
    left = own.where(F.col("pos") >= flank).select(F.col("contig").alias("a"), "kmer", F.expr(f"substring(seq, pos + 1 - {flank}, {flank})").alias("_l"))
    right = own.where(F.col("pos") + k + flank <= F.length("seq")).select(F.col("contig").alias("b"), "kmer", F.expr(f"substring(seq, pos + 1 + {k}, {flank})").alias("_r"))
    return left.join(right, "kmer").where("a != b").select("a", "b", F.concat("_l", "kmer", "_r").alias("weldmer")).distinct().transform(cut)  # what follows reads it several times


def weld_support(candidates: DataFrame, reads: DataFrame) -> DataFrame:
    """(weldmer, cnt): how often each candidate stands in reads; reads' windows are reduced to candidates before they are counted."""
    wanted = candidates.select("weldmer").distinct().hint("merge")
    size = wanted.select(F.length("weldmer").alias("n")).agg(F.max("n")).first()[0] or 1
    seen = K.count_in(reads, size).select(F.col("kmer").alias("weldmer"), "cnt")
    return seen.join(wanted, "weldmer", "left_semi")


def weld_decision(candidates: DataFrame, support: DataFrame | None, coverage: DataFrame, glue: float = 0.05, least: int = 2, iso_ratio: float = 0.05) -> DataFrame:
    """(a, b) that reads weld in either direction (A02): at least max(int(max coverage * glue), least) reads, and coverages within iso_ratio (F09). support None: candidates
    have counts."""
    cov = lambda side: coverage.select(F.col("contig").alias(side), F.col("cov").alias(f"cov_{side}"))
    rows = (candidates if support is None else candidates.hint("merge").join(support, "weldmer")).join(cov("a"), "a").join(cov("b"), "b")
    need = F.greatest(F.floor(F.greatest("cov_a", "cov_b") * glue), F.lit(least))
    ok = (F.col("cnt") >= need) & good_coverage(F.col("cov_a"), F.col("cov_b"), iso_ratio)
    return rows.where(ok).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def welded_in(contigs: DataFrame, reads: DataFrame, k: int, flank: int) -> DataFrame:
    """(weldmer, cnt) of weldmers of two different contigs that reads hold (A01), without those that no read holds."""
    if WE.fits(k, flank) and contigs.schema["contig"].dataType.simpleString() in WHOLE:
        return WE.support(contigs, reads, k, flank)
    return weld_support(weldmers(contigs, k, flank), reads)


def welds(contigs: DataFrame, reads: DataFrame, coverage: DataFrame, k: int, flank: int, glue: float = 0.05, least: int = 2, iso_ratio: float = 0.05) -> DataFrame:
    """(a, b) that reads weld (A02), as weld_decision has them, without weldmers that no read holds. A pair's weldmer with most reads decides, as coverage doesn't depend on it."""
    if not (WE.fits(k, flank) and contigs.schema["contig"].dataType.simpleString() in WHOLE):
        candidates = weldmers(contigs, k, flank)
        return weld_decision(candidates, weld_support(candidates, reads), coverage, glue, least, iso_ratio)
    pairs = WE.pairs(contigs, reads, k, flank, least)
    return weld_decision(pairs, None, coverage, glue, least, iso_ratio)


def good_coverage(a: Column, b: Column, ratio: float) -> Column:
    """Whether the smaller coverage is more than ``ratio`` of the larger."""
    return F.least(a, b) / F.greatest(a, b) > ratio


def scaffold_decision(links: DataFrame, coverage: DataFrame, glue: float = 0.05, least: int = 2) -> DataFrame:
    """Pair links with enough reads for their contigs' coverage."""
    cov = lambda side: coverage.select(F.col("contig").alias(side), F.col("cov").alias(f"cov_{side}"))
    rows = links.join(cov("a"), "a").join(cov("b"), "b")
    return rows.where(F.col("links") >= F.greatest(F.floor(F.greatest("cov_a", "cov_b") * glue), F.lit(least))).select("a", "b", "links")


HEAVY = 4096


def _with_least(rows: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """(u, v) with m, the least neighbour of u, from least (u, m, n). Nodes of more than total / HEAVY edges, of which there are at most HEAVY, are met by a broadcast,
    so the centre of a star that holds a third of all edges is no single task."""
    bound = max(8, -(-total // HEAVY))
    marked = rows.join(F.broadcast(least.where(F.col("n") > bound).select("u", F.col("m").alias("_heavy"))), "u", "left")
    light = marked.where("_heavy IS NULL").select("u", "v").join(least.where(F.col("n") <= bound).select("u", "m"), "u")
    return light.select("u", "v", "m").unionByName(marked.where("_heavy IS NOT NULL").select("u", "v", F.col("_heavy").alias("m")))


LOCAL = 1 << 20  # edges that a task joins up at a time


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the smallest node that these edges join each to."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, up = place[: len(a)], place[len(a) :], np.arange(len(nodes))
    while True:
        x, y = up[x], up[y]
        x, y = np.minimum(x, y)[x != y], np.maximum(x, y)[x != y]
        if not len(x):
            return nodes, nodes[up]
        np.minimum.at(up, y, x)
        while (up[up] != up).any():
            up = up[up]


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        found = _roots(*(np.concatenate([x.column(i).to_numpy() for x in held]) for i in range(2)))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["node", "root"])

    for batch in batches:
        whole = pc.and_(batch.column(0).is_valid(), batch.column(1).is_valid())
        if not pc.all(whole).as_py() and batch.num_rows:  # ends of edges to nowhere are nodes too
            rest = batch.filter(pc.invert(whole))
            ends = pa.concat_arrays([rest.column(0), rest.column(1)])
            yield pa.RecordBatch.from_arrays([ends, ends], ["node", "root"])
        held.append(batch.filter(whole))
        if sum(x.num_rows for x in held) >= LOCAL:
            yield flush()
            held.clear()
    if held:
        yield flush()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each (a, b) is joined to (P05). Where nodes are numbers, each task first joins up the edges that it has, and only nodes that several lots of edges hold
    link those lots' smallest nodes; so edges that lie with their neighbours leave little to the rounds over all tasks."""
    edges = edges.select("a", "b")
    if [kind for _, kind in edges.dtypes] != ["bigint", "bigint"]:
        return _starred(edges)
    own = edges.mapInArrow(_joined_up, "node long, root long").groupBy("node").agg(F.min("root").alias("root"), F.collect_set("root").alias("_roots")).transform(cut)  # a node has a root a lot
    between = own.where(F.size("_roots") > 1).select(F.col("root").alias("a"), F.explode("_roots").alias("b")).where("a != b").distinct().transform(cut)
    if between.isEmpty():
        return own.select("node", F.col("root").alias("component"))
    above = _starred(between).withColumnRenamed("node", "root")
    return own.select("node", "root").join(above, "root", "left").select("node", F.coalesce("component", "root").alias("component"))


def _starred(edges: DataFrame) -> DataFrame:
    """(node, component) by alternating large and small stars. Rounds go on until no edge changes; each is checkpointed."""
    now = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().transform(cut)
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen = state(now)
    minima = lambda e: e.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = minima(both).select("u", F.least("u", "m").alias("m"), "n")
        large = _with_least(both, least, 2 * seen[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().transform(cut)
        low = minima(large)
        small = _with_least(large, low, seen[0]).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().transform(cut)
        if (new := state(now)) == seen:
            break
        seen = new
    return nodes.join(now.withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("v", "node").alias("component"))


def bounded_groups(edges: DataFrame, most: int) -> DataFrame:
    """(node, grp): groups that grow along edges but hold at most ``most`` nodes (P06): in each component, smallest groups are absorbed first, by
    (size, smallest node), into the neighbour group that is smallest by the same order and still has room."""
    edges = edges.transform(cut)  # components read it several times
    labelled = edges.join(components(edges).withColumnRenamed("node", "a"), "a").select("a", "b", "component")

    def grouped(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
        near: dict[int, set] = {}
        for x, y in zip(a, b, strict=True):
            near.setdefault(x, set()).add(y)
            near.setdefault(y, set()).add(x)
        group = {n: n for n in near}
        members = {n: [n] for n in near}
        open_ = [(1, n) for n in near]
        heapq.heapify(open_)
        while open_:
            size, g = heapq.heappop(open_)
            if g not in members or len(members[g]) != size:  # it has grown or gone meanwhile
                continue
            around = {group[m] for n in members[g] for m in near[n]} - {g}
            fits = [h for h in around if len(members[h]) + size <= most]
            if not fits:
                continue
            h = min(fits, key=lambda x: (len(members[x]), x))
            keep, gone = min(g, h), max(g, h)
            for n in members[gone]:
                group[n] = keep
            members[keep] += members.pop(gone)
            heapq.heappush(open_, (len(members[keep]), keep))
        return list(group), list(group.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Components one after the other; a task holds the edges of one."""
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.stack([c.to_numpy() for c in batch.columns]))
            if held[0].shape[1] and batch.num_rows and held[0][0, 0] == held[-1][0, -1]:
                continue
            yield from parted(held, False)
        yield from parted(held, True)

    def parted(held: list[np.ndarray], all_: bool) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held, axis=1) if held else np.zeros((3, 0), np.int64)
        held.clear()
        edges_of = np.flatnonzero(np.diff(rows[0])) + 1
        lots = np.split(rows, edges_of, axis=1)
        if not all_:
            held.append(lots.pop())  # the last one may go on
        found = [grouped(lot[1].tolist(), lot[2].tolist()) for lot in lots if lot.shape[1]]
        yield pa.RecordBatch.from_arrays([pa.array([x for f in found for x in f[i]], pa.int64()) for i in range(2)], ["node", "grp"])

    met = labelled.select(*(F.col(c).cast("long").alias(c) for c in ("component", "a", "b"))).dropna().repartition("component").sortWithinPartitions("component")
    return met.mapInArrow(run, "node long, grp long")


def with_singletons(groups: DataFrame, contigs: DataFrame) -> DataFrame:
    """Contigs in no group get one of their own."""
    alone = contigs.select(F.col("contig").alias("node")).join(groups, "node", "left_anti")
    return groups.unionByName(alone.select("node", F.col("node").alias("grp")))


def label_reads(reads: DataFrame, contigs: DataFrame, k: int) -> DataFrame:
    """(read_id, component, hits, n_kmers) of the component with most k-mers in common with a read (J02, A04). A k-mer of several
    components goes to the largest, as one table with a label a k-mer would hold; ties of hits go to the smallest component."""
    total = reads.select("read_id", F.greatest(F.length("seq") - k + 1, F.lit(0)).cast("long").alias("n_kmers"))
    of_read = Window.partitionBy("read_id")
    best = F.row_number().over(of_read.orderBy(F.desc("hits"), "component"))
    whole = ("tinyint", "smallint", "int", "bigint")
    if k in packed.STRETCHED and reads.schema["read_id"].dataType.simpleString() in whole and contigs.schema["component"].dataType.simpleString() in whole:
        hits = packed.labelled(reads, "read_id", contigs, "component", k).withColumn("n_kmers", F.sum("windows").over(of_read))
        return hits.withColumn("_k", best).where("_k = 1 AND hits > 0 AND read_id IS NOT NULL").select("read_id", "component", "hits", "n_kmers")
    labels = packed.windows(contigs, k, "component").groupBy("code", "word").agg(F.max("component").alias("component"))
    rows = packed.windows(reads, k, "read_id").select("read_id", "code", "word")
    total = reads.select("read_id", F.greatest(F.length("seq") - k + 1, F.lit(0)).cast("long").alias("n_kmers"))
    hits = rows.join(labels, ["code", "word"]).groupBy("read_id", "component").agg(F.count(F.lit(1)).alias("hits"))
    total = total.groupBy("read_id").agg(F.sum("n_kmers").alias("n_kmers")).hint("merge")
    return hits.withColumn("_k", best).where("_k = 1").join(total, "read_id").select("read_id", "component", "hits", "n_kmers")


def assigned(labelled: DataFrame, least_pct: int) -> DataFrame:
    """Reads whose best component has at least so many percent of their k-mers, and that percentage."""
    pct = F.floor(F.col("hits") / F.col("n_kmers") * 100 + 0.5).cast("int")
    return labelled.withColumn("pct", pct).where(F.col("pct") >= least_pct)


def link_jaccard(edges: DataFrame) -> DataFrame:
    """(a, b, jaccard): (common neighbours + 2) / (neighbours of a + of b - common) (A38). edges: undirected (a, b), a < b."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    x, y = both.select("a", F.col("b").alias("z")), both.select(F.col("a").alias("b"), F.col("b").alias("z"))
    common = edges.join(x, "a").join(y, ["b", "z"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
    rows = edges.select("a", "b").join(common, ["a", "b"], "left").na.fill(0, ["c"])
    rows = rows.join(degree.withColumnRenamed("n", "n_a"), "a").join(degree.select(F.col("a").alias("b"), F.col("n").alias("n_b")), "b")
    return rows.select("a", "b", F.round((F.col("c") + 2) / (F.col("n_a") + F.col("n_b") - F.col("c")), 6).alias("jaccard"))


def low_complexity(seq: Column, least: float = 1.3) -> Column:
    """Entropy below the limit."""
    return S.entropy(seq) < least


def simple_halves(seq: Column, least: float = 1.3) -> Column:
    """Either half of low complexity."""
    half = F.floor(F.length(seq) / 2).cast("int")
    return low_complexity(F.substring(seq, F.lit(1), half), least) | low_complexity(F.substring(seq, half + 1, F.length(seq) - half), least)


def internal_identity(seq: Column, least_overlap: int = 4) -> Column:
    """The best identity of a sequence with itself shifted (F08): shares of equal letters over all shifts that leave enough overlap. Sequences of one length are compared together."""
    @F.pandas_udf("double")
    def best(texts: pd.Series) -> pd.Series:
        texts = texts.fillna("")
        sizes, out = texts.str.len().to_numpy(), np.zeros(len(texts))
        for n in np.unique(sizes[sizes > least_overlap]):
            for at in np.array_split(np.flatnonzero(sizes == n), -(-int((sizes == n).sum()) * int(n) // (1 << 22)) or 1):
                letters = np.frombuffer("".join(texts.iloc[at]).encode("utf-32-le"), np.uint32).reshape(len(at), n)
                for shift in range(1, n - least_overlap + 1):
                    out[at] = np.maximum(out[at], (letters[:, :-shift] == letters[:, shift:]).sum(axis=1) / (n - shift))
        return pd.Series(out)

    return best(seq)


def is_shadow(a: Column, b: Column, k: int) -> Column:
    """Whether the differences of two sequences laid side by side from the left mostly stand k + 1 apart, as from errors in k-mers (F10): more than 4 steps between neighbouring
    differences are k + 1 long, at least 0.9 of those that the compared length has room for, and fewer than a fifth as many are not. The comparison
    ends at the third difference in a row (places above 4). One pass over the letters carries the counts."""
    n = F.least(F.length(a), F.length(b))
    zero = F.lit(0)
    start = F.struct(zero.alias("last"), zero.alias("row"), zero.alias("hit"), zero.alias("miss"), zero.alias("stop"))

    def step(acc: Column, i: Column) -> Column:
        differs = F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))
        ends = differs & (acc["row"] >= 2) & (i > 4)
        on = (acc["last"] > 0) & (i - acc["last"] == k + 1)
        counted = F.struct(i.alias("last"), (acc["row"] + 1).alias("row"), (acc["hit"] + on.cast("int")).alias("hit"), (acc["miss"] + ((acc["last"] > 0) & ~on).cast("int")).alias("miss"), acc["stop"].alias("stop"))
        stopped = F.struct(acc["last"].alias("last"), acc["row"].alias("row"), acc["hit"].alias("hit"), acc["miss"].alias("miss"), i.alias("stop"))
        equal = F.struct(acc["last"].alias("last"), F.lit(0).alias("row"), acc["hit"].alias("hit"), acc["miss"].alias("miss"), acc["stop"].alias("stop"))
        return F.when(acc["stop"] > 0, acc).when(ends, stopped).when(differs, counted).otherwise(equal)

    def verdict(acc: Column) -> Column:
        length = F.when(acc["stop"] > 0, acc["stop"]).otherwise(n)
        return (acc["hit"] > 4) & (acc["hit"] >= F.floor(0.9 * (F.floor(length / (k + 1)) - 1))) & (acc["miss"] < F.floor(acc["hit"] / 5))

    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), start, step, verdict)).otherwise(False)
