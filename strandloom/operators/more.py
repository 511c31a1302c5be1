"""Smaller operators of several stages: capped extensions, exon chains, weighted EM, spliced ends, dangling nodes, clustering of rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.abundance import settled
from strandloom.operators.lineage import cut


def top_paths(paths: DataFrame, most: int) -> DataFrame:
    """The best supported paths of each node, most + 1 of them (W01), ties by path."""
    k = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("support"), "path"))
    return paths.withColumn("_k", k).where(F.col("_k") <= most + 1).drop("_k")


def attach_sequences(aligns: DataFrame, reads: DataFrame) -> DataFrame:
    """Alignment rows with their reads' sequences by name (J10); rows without one stay."""
    return aligns.join(reads.select(F.col("name").alias("qname"), "seq"), "qname", "left")


def exon_compatible(a: Column, b: Column) -> Column:
    """Whether the chain of intervals b lies within a and all splice borders of b are those of a (J16). Arrays of struct<lend, rend>, sorted."""
    inner = lambda x: F.flatten(F.transform(x, lambda e: F.array(e["lend"], e["rend"])))
    borders = lambda x: F.slice(inner(x), 2, F.greatest(F.size(x) * 2 - 2, F.lit(0)))
    start = F.array_position(F.transform(F.sequence(F.lit(1), F.size(a)), lambda i: F.element_at(a, i)["lend"] <= F.element_at(b, 1)["lend"]), False) - 1
    first = F.when(start < 0, F.size(a)).otherwise(start).cast("int")
    part = F.slice(a, F.greatest(first, F.lit(1)), F.size(b))
    inside = (F.size(part) == F.size(b)) & (F.element_at(part, 1)["lend"] <= F.element_at(b, 1)["lend"]) & (F.element_at(part, -1)["rend"] >= F.element_at(b, -1)["rend"])
    return F.when(first >= 1, inside & (borders(part) == borders(b)) & (F.element_at(part, 1)["rend"] >= F.element_at(b, 1)["lend"])).otherwise(False)


def weighted_em(hits: DataFrame, rounds: int = 10_000, least_rounds: int = 20, delta: float = 1e-3, noise: float = 1e-7) -> DataFrame:
    """(feature, theta, converged) by EM over (frag, feature, prob) with conditional probabilities of each hit, and a noise feature -1 that fits
    every fragment with probability ``noise`` (A23). Rounds end when no theta of at least 1e-7 changes by more than ``delta`` of itself,
    or else after ``rounds`` with converged false."""
    member = F.struct(F.col("feature").cast("long").alias("feature"), F.coalesce(F.col("prob").cast("double"), F.lit(0.0)).alias("weight"))
    sets = hits.groupBy("frag").agg(F.sort_array(F.collect_list(member)).alias("members"))
    packed = sets.groupBy("members").agg(F.count(F.lit(1)).alias("cnt"))
    return settled(packed, rounds, delta, least_rounds, noise, relative=True).select("feature", "theta", "converged")


def trim_short_ends(blocks: Column, least: int = 10) -> Column:
    """Spliced blocks without a first or last one shorter than ``least`` (N13); a single block stays."""
    size = lambda b: b["rend"] - b["lend"] + 1
    head = F.when((F.size(blocks) > 1) & (size(F.element_at(blocks, 1)) < least), F.slice(blocks, 2, F.size(blocks) - 1)).otherwise(blocks)
    return F.when((F.size(head) > 1) & (size(F.element_at(head, -1)) < least), F.slice(head, 1, F.size(head) - 1)).otherwise(head)


def without_dangling(edges: DataFrame, least: int) -> DataFrame:
    """Edges without those to leaves whose only edge weighs less than ``least`` (P25)."""
    into = edges.groupBy("component", F.col("dst").alias("node")).agg(F.count(F.lit(1)).alias("i"), F.max("w").alias("w"))
    out = edges.select("component", F.col("src").alias("node")).distinct()
    weak = into.where((F.col("i") == 1) & (F.col("w") < least)).join(out, ["component", "node"], "left_anti").select("component", F.col("node").alias("dst"))
    return edges.join(weak, ["component", "dst"], "left_anti").select("component", "src", "dst", "w")


def walk_flanks(counts: DataFrame, starts: DataFrame, steps: int) -> DataFrame:
    """(start, seq): all ways to extend k-mers by so many letters to the right along counted k-mers (P04). Each step is one join."""
    links = counts.select(F.expr("substring(kmer, 1, length(kmer) - 1)").alias("_j"), F.expr("substring(kmer, -1, 1)").alias("_b"))
    now = starts.select(F.col("kmer").alias("start"), F.col("kmer").alias("seq"), F.length("kmer").alias("_k"))
    for _ in range(steps):
        now = now.withColumn("_j", F.expr("substring(seq, length(seq) - _k + 2)")).join(links, "_j").select("start", F.concat("seq", "_b").alias("seq"), "_k")
    return now.select("start", "seq")


def agglomerate(values: DataFrame, clusters: int, most: int = 5000) -> DataFrame:
    """(feature, cluster, step) of all rows (feature, value array) by average linkage on Euclidean distances, cut into so many clusters (P27); identical rows
    are never parted. Up to ``most`` distinct values this is exact. Beyond, values are gathered first in the cells of a grid, the finest
    with at most so many cells of steps that double from 1/64; the cells' means are linked by their numbers of rows, and each row gets the cluster of
    its cell. ``step`` says which it was: 0 for the values themselves, else the side of the grid's cells. Clusters are numbered by their smallest features."""
    rows = values.where("value IS NOT NULL").select(F.col("feature").cast("long").alias("feature"), F.col("value").cast("array<double>").alias("value")).transform(cut)
    width = rows.agg(F.max(F.size("value"))).first()[0] or 0
    in_grid = lambda step: rows.withColumn("_key", F.transform("value", lambda x: F.floor(x / step).cast("double")))
    keyed, step = rows.withColumn("_key", F.col("value")), 1 / 64
    while keyed.select("_key").distinct().limit(most + 1).count() > most:
        keyed, step = in_grid(step), step * 2
    side = 0.0 if step == 1 / 64 else step / 2
    means = F.col("_key") if not side else F.array(*[F.avg(F.get("value", F.lit(i))) for i in range(width)])
    cells = keyed.groupBy("_key").agg(F.min("feature").alias("feature"), F.count(F.lit(1)).cast("double").alias("n"), means.alias("value"))

    def run(batches):
        found = pd.concat(list(batches), ignore_index=True).sort_values("feature", ignore_index=True)
        label = linked(np.array(found["value"].tolist(), float), found["n"].to_numpy(), clusters)
        yield pd.DataFrame({"_key": found["_key"], "cluster": label.astype("int32")})

    labels = cells.repartition(1).mapInPandas(run, "_key array<double>, cluster int")
    return keyed.join(F.broadcast(labels), "_key").select("feature", "cluster", F.lit(side).alias("step"))


def linked(x: np.ndarray, size: np.ndarray, clusters: int) -> np.ndarray:
    """The cluster, from 1 in the order of their first rows, of each row of x by average linkage; a row counts as ``size`` equal ones. Each row's nearest one is
    kept, so a merge looks again only at rows whose nearest one it changed."""
    n = len(x)
    d = np.zeros((n, n))
    for i in range(n):
        d[i] = np.sqrt(((x - x[i]) ** 2).sum(1))
    np.fill_diagonal(d, np.inf)
    size, of, alive = size.astype(float).copy(), np.arange(n), np.ones(n, bool)
    near = d.argmin(1) if n else np.zeros(0, np.int64)
    least = d[np.arange(n), near]
    for _ in range(n - max(1, clusters)):
        i = int(least.argmin())
        i, j = sorted((i, int(near[i])))
        d[i] = (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        d[i, i] = d[i, j] = np.inf
        d[:, i] = d[i]
        d[j] = d[:, j] = np.inf
        size[i] += size[j]
        alive[j] = False
        of[of == j] = i
        least[j] = np.inf
        closer = alive & (d[i] < least)
        again = alive & ((near == i) | (near == j))
        near[closer], least[closer] = i, d[i][closer]
        same = alive & (d[i] == least) & (near > i)
        near[same] = i
        again[i] = True
        again = np.flatnonzero(again)
        near[again] = d[again].argmin(1)
        least[again] = d[again, near[again]]
    return np.unique(of, return_inverse=True)[1] + 1
