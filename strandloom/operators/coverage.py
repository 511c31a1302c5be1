"""Coverage along scaffolds, sliding Jaccard windows and clip points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.alignments import has
from strandloom.operators.lineage import cut

STRETCH = 64_000  # places of a scaffold whose sums one task runs


def depth(intervals: DataFrame) -> DataFrame:
    """(scaff, pos, cov) of every covered place (A11, A12, A40), from runs of equal depth, so a place is made once and not by each interval over it. Places outgrow what Spark expects of
    intervals, so joins are told to shuffle them."""
    return depth_runs(intervals.where("lend <= rend")).select("scaff", F.explode(F.sequence("lend", "rend")).alias("pos"), "cov").hint("merge")


def depth_runs(intervals: DataFrame) -> DataFrame:
    """(scaff, lend, rend, cov): the same as runs of equal depth, from sums of +1 and -1 at interval ends; cost follows the number of intervals, not their length. Sums run
    within stretches of a scaffold; a row a stretch carries them on from one to the next."""
    ends = intervals.select("scaff", F.col("lend").alias("at"), F.lit(1).alias("d")).unionByName(intervals.select("scaff", (F.col("rend") + 1).alias("at"), F.lit(-1).alias("d")))
    steps = ends.groupBy("scaff", "at").agg(F.sum("d").alias("d")).where("d != 0")
    steps = steps.withColumn("_bin", F.floor(F.col("at") / STRETCH))
    along = Window.partitionBy("scaff").orderBy("_bin")
    bins = steps.groupBy("scaff", "_bin").agg(F.sum("d").alias("_sum"), F.min("at").alias("_first"))
    bins = bins.select("scaff", "_bin", (F.sum("_sum").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_sum")).alias("_before"), F.lead("_first").over(along).alias("_next"))
    order = Window.partitionBy("scaff", "_bin").orderBy("at")
    rows = steps.withColumn("_here", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_to", F.lead("at").over(order)).join(bins, ["scaff", "_bin"])
    return rows.select("scaff", F.col("at").alias("lend"), (F.coalesce("_to", "_next") - 1).alias("rend"), (F.col("_here") + F.col("_before")).alias("cov")).where("cov > 0")


def read_spans(aligns: DataFrame, most: int = 500) -> DataFrame:
    """(scaff, lend, rend) (A13): a proper pair whose mate starts downstream spans to the mate, others their own blocks; spans of ``most`` or more are dropped."""
    pair = has(F.col("flag"), "paired") & has(F.col("flag"), "proper_pair") & (F.col("mpos") > F.col("pos")) & (F.col("mpos") - F.col("pos") <= most)
    rows = aligns.select("scaff", F.col("pos").alias("lend"), F.when(pair, F.greatest("rend", F.col("mpos") - 1)).otherwise(F.col("rend")).alias("rend"))
    return rows.where(F.col("rend") - F.col("lend") + 1 < most)


def sliding_jaccard(frags: DataFrame, length: int = 100, pseudo: int = 1) -> DataFrame:
    """(scaff, pos, jaccard) (W08): for windows [p, p + length], (both + 1) / (single + both + 1), where both is the fragments over
    both ends and single those over exactly one. From depths at the two ends and the number of fragments over
    both, each a sum of steps; so no fragment meets a window."""
    over = depth(frags)
    wide = frags.where(F.col("rend") - F.col("lend") >= length).select("scaff", "lend", (F.col("rend") - length).alias("rend"))
    both = depth(wide).withColumnRenamed("cov", "both")
    here = over.select("scaff", "pos", F.col("cov").alias("l"))
    there = over.select("scaff", (F.col("pos") - length).alias("pos"), F.col("cov").alias("r"))
    rows = here.join(there, ["scaff", "pos"], "full").join(both, ["scaff", "pos"], "left").na.fill(0, ["l", "r", "both"]).where("pos >= 1")
    single = F.col("l") + F.col("r") - 2 * F.col("both")
    return rows.select("scaff", F.floor((F.col("pos") + F.col("pos") + length) / 2).alias("pos"), F.round((F.col("both") + pseudo) / (single + F.col("both") + pseudo), 4).alias("jaccard"))


def troughs(track: DataFrame, most: float = 0.05, hill: float = 0.35, reach: int = 100, apart: int = 200) -> DataFrame:
    """(scaff, pos, jaccard, avg_delta) clip points (W09): places at most ``most`` with hills of at least ``hill`` more at ``reach`` on both sides;
    of troughs within ``apart`` of each other the deepest stays, then the one with the largest mean rise, then the first."""
    track = track.transform(cut)  # it is read three times
    low = track.where(F.col("jaccard") <= most)
    side = lambda shift, name: track.select("scaff", (F.col("pos") + shift).alias("pos"), F.col("jaccard").alias(name)).hint("merge")
    rows = low.join(side(reach, "before"), ["scaff", "pos"]).join(side(-reach, "after"), ["scaff", "pos"])
    rows = rows.where((F.col("before") >= F.col("jaccard") + hill) & (F.col("after") >= F.col("jaccard") + hill))
    rows = rows.withColumn("avg_delta", (F.col("before") + F.col("after")) / 2 - F.col("jaccard"))
    order = Window.partitionBy("scaff").orderBy("pos")
    new = F.when(F.col("pos") - F.lag("pos").over(order) <= apart, 0).otherwise(1)
    groups = rows.withColumn("_new", new).withColumn("_g", F.sum("_new").over(order))
    best = Window.partitionBy("scaff", "_g").orderBy("jaccard", F.desc("avg_delta"), "pos")
    return groups.withColumn("_k", F.row_number().over(best)).where("_k = 1").select("scaff", "pos", "jaccard", F.round("avg_delta", 6).alias("avg_delta"))


def clip(contigs: DataFrame, points: DataFrame) -> DataFrame:
    """(acc, lend, rend, seq): contigs cut after their clip points (W10). contigs: acc, seq; points: acc, pos."""
    ends = contigs.select("acc", F.length("seq").alias("pos")).unionByName(points.join(contigs, "acc").where("pos >= 1 AND pos < length(seq)").select("acc", F.col("pos").cast("int").alias("pos"))).distinct()
    before = F.lag("pos").over(Window.partitionBy("acc").orderBy("pos"))
    pieces = ends.select("acc", (F.coalesce(before, F.lit(0)) + 1).alias("lend"), F.col("pos").alias("rend"))
    return pieces.join(contigs, "acc").select("acc", "lend", "rend", F.expr("substring(seq, lend, rend - lend + 1)").alias("seq"))


def join_tracks(tracks: dict[str, DataFrame]) -> DataFrame:
    """(scaff, pos, one column a track), 0 where a track has nothing."""
    out = None
    for name, t in tracks.items():
        one = t.select("scaff", "pos", F.col("cov").alias(name))
        out = one if out is None else out.join(one, ["scaff", "pos"], "full")
    return out.na.fill(0, list(tracks))
