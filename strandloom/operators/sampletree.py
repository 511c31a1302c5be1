"""Clusters of samples by rank correlation (P27): log2(x + 1) with each feature's mean over samples taken off, 1 - Spearman's rho as the distance, complete linkage, cut into k.

Ranks are those of one sort of all values by sample and size, in ranges. Products of ranks are summed by numpy over batches of features, so each task gives a
matrix of samples by samples, and those are added up. Only that matrix, a number for each pair of samples whatever the number of features, meets in one task, which links samples.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators.lineage import cut, numbered


def centred(values: DataFrame) -> tuple[DataFrame, list[str]]:
    """((feature, at, value), samples): a row for each feature and sample, at the place of the sample in the sorted list of names; what isn't in (feature, sample, value) is 0."""
    samples = [r["sample"] for r in values.select("sample").distinct().orderBy("sample").collect()]  # the columns of the matrix
    by_sample = values.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("sample", F.log2(F.col("value") + 1)))).alias("m"))
    row = F.array(*[F.coalesce(F.col("m")[s], F.lit(0.0)) for s in samples]) if samples else F.array().cast("array<double>")
    mean = F.aggregate("v", F.lit(0.0), lambda a, x: a + x) / max(1, len(samples))
    rows = by_sample.select("feature", row.alias("v")).select("feature", "v", mean.alias("mean"))
    return rows.select("feature", "mean", F.posexplode("v").alias("at", "x")).select("feature", "at", F.round(F.col("x") - F.col("mean"), 9).alias("value")), samples


def rank_products(values: DataFrame) -> tuple[DataFrame, list[str]]:
    """((i, j, s), samples): sums over features of products of their ranks, less the middle rank, in samples i and j; equal values share their mean rank."""
    rows, samples = centred(values)
    rows = numbered(rows, "at", "value", "feature").transform(cut)
    ties = rows.groupBy("at", "value").agg(((F.min("rank") + F.max("rank")) / 2).alias("mid"))
    sizes = rows.groupBy("at").agg(((F.min("rank") + F.max("rank")) / 2).alias("centre"))  # a sample's ranks follow each other
    ranked = rows.join(ties, ["at", "value"]).join(F.broadcast(sizes), "at").select("feature", "at", (F.col("mid") - F.col("centre")).alias("z"))
    wide = ranked.groupBy("feature").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "z"))), lambda s: s["z"]).alias("z"))

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(samples)
        total = np.zeros((n, n))
        for b in batches:
            x = b.column(0).flatten().to_numpy().reshape(-1, n)
            total += x.T @ x
        i, j = np.triu_indices(n)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "s"])

    found = wide.select("z").mapInArrow(gram, "i int, j int, s double")
    return found.groupBy("i", "j").agg(F.sum("s").alias("s")), samples


def correlations(values: DataFrame) -> DataFrame:
    """(a, b, rho) of pairs of samples, a before b. Where a sample's values are all equal, rho is 0."""
    products, samples = rank_products(values)
    products = products.transform(cut)
    own = products.where("i = j").select("i", F.col("s").alias("own"))
    both = products.where("i < j").join(F.broadcast(own), "i").join(F.broadcast(own.select(F.col("i").alias("j"), F.col("own").alias("other"))), "j")  # a row a sample
    name = lambda c: F.element_at(F.array(*map(F.lit, samples)), F.col(c) + 1) if samples else F.lit(None).cast("string")
    rho = F.when((F.col("own") > 0) & (F.col("other") > 0), F.col("s") / F.sqrt(F.col("own") * F.col("other"))).otherwise(0.0)
    return both.select(name("i").alias("a"), name("j").alias("b"), rho.alias("rho"))


def linkage(d: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges (a, b, height) of complete linkage over a matrix of distances, lowest first, by chains of nearest neighbours; a and b are the smallest members of what is merged."""
    d = d.copy()
    np.fill_diagonal(d, np.inf)
    alive, chain, out = np.ones(len(d), bool), [], []
    for _ in range(len(d) - 1):
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            a = chain[-1]
            row = np.where(alive, d[a], np.inf)
            b = int(row.argmin())
            if len(chain) > 1 and row[chain[-2]] <= row[b]:
                b = chain[-2]
                break
            chain.append(b)
        chain = chain[:-2]
        a, b = sorted((a, b))
        out.append((a, b, float(d[a, b])))
        d[a] = d[:, a] = np.maximum(d[a], d[b])
        d[a, a] = np.inf
        alive[b] = False
    return sorted(out, key=lambda m: m[2])


def clusters(values: DataFrame, k: int) -> DataFrame:
    """(sample, cluster): k clusters, numbered from 1 by their first samples."""
    pairs = correlations(values)
    names = values.select("sample").distinct()
    rows = pairs.unionByName(names.select(F.col("sample").alias("a"), F.col("sample").alias("b"), F.lit(1.0).alias("rho")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [row for x in batches for row in zip(*(c.to_pylist() for c in x.columns), strict=True)]
        order = {s: i for i, s in enumerate(sorted({s for row in got for s in row[:2]}))}
        d = np.zeros((len(order), len(order)))
        for x, y, r in got:
            d[order[x], order[y]] = d[order[y], order[x]] = 1 - r
        top = np.arange(len(order))
        for x, y, _ in linkage(d)[: max(0, len(order) - k)]:
            top[top == top[y]] = top[x]
        least = [int(np.flatnonzero(top == t)[0]) for t in top]
        number = {t: i + 1 for i, t in enumerate(sorted(set(least)))}
        yield pa.RecordBatch.from_arrays([pa.array(list(order), pa.string()), pa.array([number[x] for x in least], pa.int32())], ["sample", "cluster"])

    return rows.coalesce(1).mapInArrow(run, "sample string, cluster int")
