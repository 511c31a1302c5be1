"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same expected number of copies: the source's target over its
size. Whole copies are given outright; the fractional rest is rounded by the pivotal method: two
documents transfer mass, in a random direction whose odds keep each document's expectation, until
one of them is integral. The transferred mass is weighed by document size, so a source's words stay
fixed but for its last document. Blocks of a source are rounded independently; the one document
that a block leaves undecided goes up a reduction tree, where residuals of many blocks are paired
again, until one is left of each source. It is rounded to the nearer side, the only deviation from the
target. Blocks go by size, largest first, so what stays undecided is small where there are many.

Sources go by code point, null last, and weigh WEIGHTS in turn. Targets share all words by weight,
limited to LIMIT times the source's size. Null or empty texts have size 0 and are taken 0 times. Equal
rows are interchangeable, so results don't depend on their order. Random numbers derive from the
seed, the source and the place in the tree: reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm import common

WEIGHTS = (5, 2, 1)
LIMIT = 3
BLOCK = 4096  # documents that are rounded together
WORD = r"[^\x20\x09-\x0D]+"


def n_words(name: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(name).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """From (source, source_size, n): adds rank, weight, target. A source is at its limit or gets level x
    weight. In order of limit over weight, sources are at their limits as long as what is left by all
    before, divided by the weights of the rest, is not below their own ratio; the level is that of the first
    source of which this isn't so, and there it is highest. These windows see one row a source."""
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = ranked.withColumn("weight", weight).withColumn("most", F.lit(float(limit)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    rows = rows.withColumn("total", F.sum(F.col("source_size").cast("double")).over(everything))
    rows = rows.withColumn("left_words", F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
    rows = rows.withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level_here", F.col("left_words") / F.col("left_weight"))
    open_here = F.col("most") / F.col("weight") > F.col("level_here")
    rows = rows.withColumn("level", F.max(F.when(open_here, F.col("level_here"))).over(everything))
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("weight") * F.col("level")))
    return rows.select("source", "source_size", "n", "rank", "weight", target.alias("target"))


def round_block(sizes: np.ndarray, p: np.ndarray, seed: int) -> np.ndarray:
    """Pivotal rounding in place of the given order: all but at most one become 0 or 1, and sizes . p stays."""
    p = p.copy()
    draw = np.random.Generator(np.random.PCG64(seed)).random(max(1, len(p)))
    held = -1
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b = sizes[held], sizes[i]
        up = min((1.0 - p[held]) * a, p[i] * b)  # mass that can go from i to the held one
        down = min(p[held] * a, (1.0 - p[i]) * b)
        moved = up if draw[i] * (up + down) < down else -down
        full = moved > 0 and moved == (1.0 - p[held]) * a or moved < 0 and -moved == p[held] * a
        tight = moved > 0 and moved == p[i] * b or moved < 0 and -moved == (1.0 - p[i]) * b
        p[held] = (1.0 if moved > 0 else 0.0) if full else p[held] + moved / a
        p[i] = (0.0 if moved > 0 else 1.0) if tight else p[i] - moved / b
        if full:
            held = i if not tight else -1
    return p


def _seed(*parts) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(map(str, parts)))


def _rounded(groups: DataFrame, level: int, seed: int) -> DataFrame:
    """p of each row after its block's rounding."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "tie", "id"], ascending=[False, True, True], kind="stable", ignore_index=True)
        key = _seed(seed, level, pdf["rank"].iat[0], pdf["block"].iat[0])
        p = round_block(pdf["size"].to_numpy(np.float64), pdf["p"].to_numpy(np.float64), key)
        if pdf["blocks"].iat[0] <= 1:  # the tree ends here: what is left goes to the nearer side
            p = np.round(p)
        return pdf.assign(p=p)

    return groups.groupBy("rank", "block").applyInPandas(run, groups.schema)


def depth(n: int) -> int:
    """Levels of the tree over n documents."""
    levels, blocks = 1, math.ceil(n / BLOCK)
    while blocks > 1:
        levels, blocks = levels + 1, math.ceil(blocks / BLOCK)
    return levels


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT, seed: int = 0) -> DataFrame:
    """A row a document: id, source, size, source_size, target, copies. The tree is as deep as the largest source
    needs; a level above the first sees at most one document a block below. Ids are meant to be unique; rows
    that share one are rounded in one block."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"))
    rows = common.written(rows, "mix-sizes")
    totals = common.written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")), weights, limit), "mix-targets")

    joined = rows.join(totals, rows["source"].eqNullSafe(totals["source"])).select("id", rows["source"], "size", "source_size", "target", "rank", "n")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(limit)))).otherwise(F.lit(0.0))
    joined = joined.withColumn("whole", F.when(F.col("size") > 0, F.floor(rate)).otherwise(0).cast("long"))
    joined = joined.withColumn("p", F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(0.0))
    open_ = (F.col("p") > 0) & (F.col("p") < 1)
    columns = ["id", "source", "size", "source_size", "target", "whole", "p"]
    out = joined.where(~open_).select(columns)

    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)).cast("long")
    at = joined.where(open_).withColumn("tie", F.xxhash64(F.lit(seed), F.col("id").cast("string"))).withColumn("blocks", blocks)
    at = at.withColumn("block", F.pmod("tie", "blocks"))
    for level in range(depth(totals.agg(F.max("n")).first()[0] or 0)):
        at = common.written(_rounded(at, level, seed), f"mix-level-{level}")
        out = out.unionByName(at.where(~open_).select(columns))
        up = F.greatest(F.lit(1), F.ceil(F.col("blocks") / BLOCK)).cast("long")
        at = at.where(open_).withColumn("block", F.floor(F.col("block") / BLOCK)).withColumn("blocks", up)
    copies = F.col("whole") + F.round("p").cast("long")
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", copies.alias("copies"))


def op7(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents: words taken of each."""
    out = mix(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
