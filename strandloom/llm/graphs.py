"""Connected components by alternating large-star and small-star contraction.

Every round replaces edges by edges to smaller ids until each component is one star around its
smallest id. Minima are partial aggregates. They are handed back by a join, except to vertices of so many edges that
at most HEAVY can have as many: those, a few bytes each, are broadcast, so a vertex that is part of a third of all edges is no single task.
Rounds are written to the shared folder and go on until nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import common

HEAVY = 4096


def frequent(rows: DataFrame, key: str, least: int = 128) -> tuple[DataFrame | None, int]:
    """((key, parts), total): the values of key in more than max(least, total / HEAVY) of the rows, at most HEAVY of them, and into how many parts of at most so many rows to split each; None
    if there is none. rows are counted, so they should be a written table."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total, most = (x or 0 for x in counts.agg(F.sum("n"), F.max("n")).first())
    bound = max(least, -(-total // HEAVY))
    if most <= bound:
        return None, total
    return F.broadcast(counts.where(F.col("n") > bound).select(key, F.ceil(F.col("n") / bound).cast("long").alias("_parts"))), total


def matched(many: DataFrame, one: DataFrame, key: str, other: str, parts: DataFrame | None) -> DataFrame:
    """Inner join of many rows a key with one row a key. Frequent keys (from ``frequent``) are split by a hash of the column ``other``, and the one row goes to each of their
    parts; those parts are at most 2 * HEAVY more rows."""
    if parts is None:
        return many.join(one, key)
    light = many.join(parts, key, "left_anti").join(one, key)
    dealt = many.join(parts, key).withColumn("_part", F.pmod(F.xxhash64(other), "_parts")).drop("_parts")
    copies = one.join(parts, key).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
    return light.unionByName(dealt.join(copies, [key, "_part"]).drop("_part"))


def _with_least(rows: DataFrame, least: DataFrame, total: int) -> DataFrame:
    """rows (u, v) with m, the least neighbour of u."""
    bound = max(8, -(-total // HEAVY))
    heavy = F.broadcast(least.where(F.col("n") > bound).select("u", F.col("m").alias("heavy")))
    marked = rows.join(heavy, "u", "left")
    light = marked.where("heavy IS NULL").select("u", "v").join(least.where(F.col("n") <= bound).select("u", "m"), "u")
    return light.select("u", "v", "m").unionByName(marked.where("heavy IS NOT NULL").select("u", "v", F.col("heavy").alias("m")))


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every vertex that isn't the smallest of its component. edges: (a, b), any direction; loops, repeats
    and nulls do no harm."""
    now = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = common.written(now, "edges")
    seen = _state(now)
    count = lambda rows: rows.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = count(both).select("u", F.least("u", "m").alias("m"), "n")
        large = _with_least(both, least, 2 * seen[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = common.written(large, "large-stars")
        least = count(large)
        small = _with_least(large, least, seen[0]).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = common.written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        state = _state(now)
        if state == seen:
            break
        seen = state
    return now.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
