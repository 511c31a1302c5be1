"""Alignment operators on SAM-like rows: flags, strands, pairs, best hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Flag bits of alignments.
FLAGS = {"paired": 0x1, "proper_pair": 0x2, "unmapped": 0x4, "mate_unmapped": 0x8, "reverse": 0x10, "mate_reverse": 0x20, "first": 0x40, "second": 0x80, "secondary": 0x100, "qc_fail": 0x200, "duplicate": 0x400}


def has(flag: Column, name: str) -> Column:
    """Whether a flag bit is set."""
    return flag.bitwiseAND(FLAGS[name]) != 0


def with_bit(flag: Column, name: str, on: bool) -> Column:
    """A flag with one bit set or cleared."""
    return flag.bitwiseOR(FLAGS[name]) if on else flag.bitwiseAND(~FLAGS[name] & 0xFFFF)


def mapped(aligns: DataFrame) -> DataFrame:
    return aligns.where(~has(F.col("flag"), "unmapped"))


def proper_pairs(aligns: DataFrame) -> DataFrame:
    return aligns.where(has(F.col("flag"), "proper_pair"))


def consistent_pairs(aligns: DataFrame) -> DataFrame:
    """Proper pairs whose mate is there at the place that the row names."""
    a = proper_pairs(aligns)
    mate = a.select("qname", "rname", F.col("pos").alias("mpos"), F.col("mpos").alias("pos"), has(F.col("flag"), "second").alias("first")).distinct()
    return a.withColumn("first", has(F.col("flag"), "first")).join(mate, ["qname", "rname", "pos", "mpos", "first"], "left_semi").drop("first")


def describe_flag(flag: Column) -> Column:
    """The names of a flag's bits joined by ``_``; strands of read and mate as + or -."""
    strand = lambda bit, label: F.concat(F.lit(label), F.when(has(flag, bit), "-").otherwise("+"))
    return F.concat_ws(
        "_",
        F.when(has(flag, "paired"), "paired").otherwise("single"),
        F.when(has(flag, "proper_pair"), "proper"),
        F.when(has(flag, "unmapped"), "unmapped").otherwise(strand("reverse", "read")),
        F.when(has(flag, "paired"), F.when(has(flag, "mate_unmapped"), "mateunmapped").otherwise(strand("mate_reverse", "mate"))),
        F.when(has(flag, "first"), "first"),
        F.when(has(flag, "second"), "second"),
    )


def transcribed_strand(flag: Column, library: str) -> Column:
    """The strand that was transcribed, for the library types F, R (single), FR, RF (pairs) (F16).
    Null where the type doesn't fit the row's pairing."""
    plus = F.when(has(flag, "reverse"), "-").otherwise("+")
    minus = F.when(has(flag, "reverse"), "+").otherwise("-")
    if library in ("F", "R"):
        return F.when(~has(flag, "paired"), plus if library == "F" else minus)
    same, other = ("first", "second") if library == "FR" else ("second", "first")
    return F.when(has(flag, "paired"), F.when(has(flag, same), plus).when(has(flag, other), minus))


def split_strands(aligns: DataFrame, library: str) -> DataFrame:
    """Mapped rows with their transcribed strand, to be written by strand."""
    return mapped(aligns).withColumn("strand", transcribed_strand(F.col("flag"), library)).where("strand IS NOT NULL")


def mate_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left and right mates by (core, rname), full outer (J08): the side that is alone keeps its best mapq; flags follow."""
    best = lambda df, side: df.groupBy("core", "rname").agg(F.max("mapq").alias(f"mapq_{side}"), F.count(F.lit(1)).alias(f"n_{side}"))
    both = best(left, "left").join(best(right, "right"), ["core", "rname"], "full")
    paired = F.col("n_left").isNotNull() & F.col("n_right").isNotNull()
    out = both.withColumn("mate_unmapped", (~paired).cast("int"))
    return out.select("core", "rname", F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"), F.greatest("mapq_left", "mapq_right").alias("mapq"), "mate_unmapped")


def fragment_pairs(aligns: DataFrame, least: int = 100, most: int = 500) -> DataFrame:
    """(scaff, frag, lend, rend) (J11): reads with exactly two ends on a scaffold become one fragment if its length is within bounds,
    all other ends are fragments of their own."""
    by = Window.partitionBy("scaff", "read")
    rows = aligns.select("scaff", "read", "lend", "rend", F.count(F.lit(1)).over(by).alias("_n"), F.min("lend").over(by).alias("_l"), F.max("rend").over(by).alias("_r"), F.row_number().over(by.orderBy("lend", "rend")).alias("_k"))
    size = F.col("_r") - F.col("_l") + 1
    joined = (F.col("_n") == 2) & size.between(least, most)
    rows = rows.where(~joined | (F.col("_k") == 1))
    return rows.select("scaff", F.col("read").alias("frag"), F.when(joined, F.col("_l")).otherwise(F.col("lend")).alias("lend"), F.when(joined, F.col("_r")).otherwise(F.col("rend")).alias("rend"))


def pair_links(aligns: DataFrame) -> DataFrame:
    """(a, b, links): reads of which either mate hits exactly one contig, and the two differ."""
    one = aligns.groupBy("core", "mate").agg(F.count_distinct("contig").alias("_n"), F.min("contig").alias("contig")).where("_n = 1")
    left, right = (one.where(F.col("mate") == m).select("core", F.col("contig").alias(c)) for m, c in ((1, "x"), (2, "y")))
    pairs = left.join(right, "core").where("x != y")
    return pairs.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("links"))


def mate_pairs(left: DataFrame, right: DataFrame, most_apart: int = 2000, most: int = 1) -> DataFrame:
    """Pairs of mates (J09): same read and scaffold, opposite strands, near, left upstream of right on its strand; at most ``most`` a read and
    scaffold, by summed score, ties by position. Rows: core, rname, strand, pos, score."""
    a = left.select("core", "rname", F.col("strand").alias("strand_l"), F.col("pos").alias("pos_l"), F.col("score").alias("score_l"))
    b = right.select("core", "rname", F.col("strand").alias("strand_r"), F.col("pos").alias("pos_r"), F.col("score").alias("score_r"))
    upstream = ((F.col("strand_l") == "+") & (F.col("pos_l") <= F.col("pos_r"))) | ((F.col("strand_l") == "-") & (F.col("pos_l") >= F.col("pos_r")))
    met = a.join(b, ["core", "rname"]).where((F.col("strand_l") != F.col("strand_r")) & (F.abs(F.col("pos_l") - F.col("pos_r")) <= most_apart) & upstream)
    best = Window.partitionBy("core", "rname").orderBy(F.desc(F.col("score_l") + F.col("score_r")), "pos_l", "pos_r")
    return met.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= most).select("core", "rname", "pos_l", "pos_r", (F.col("score_l") + F.col("score_r")).alias("score"))


def category_counts(aligns: DataFrame) -> DataFrame:
    """(category, n, pct) over (read, contig) (A14): proper pairs and improper pairs count 2, single mates 1."""
    f = F.col("flag")
    per = aligns.groupBy("core", "contig").agg(F.max(has(f, "first").cast("int")).alias("l"), F.max(has(f, "second").cast("int")).alias("r"), F.max(has(f, "proper_pair").cast("int")).alias("p"))
    both = (F.col("l") == 1) & (F.col("r") == 1)
    kind = F.when(both & (F.col("p") == 1), "proper_pairs").when(both, "improper_pairs").when(F.col("l") == 1, "left_only").otherwise("right_only")
    n = per.select(kind.alias("category"), F.when(both, 2).otherwise(1).alias("w")).groupBy("category").agg(F.sum("w").alias("n"))
    return n.select("category", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))) * 100, 2).alias("pct"))


def cap_by_position(aligns: DataFrame, most: int) -> DataFrame:
    """At most so many rows a (rname, pos), by (ord, num), then by what else they hold, so that reruns agree."""
    rest = [c for c in aligns.columns if c not in ("rname", "pos", "ord", "num")]
    k = F.row_number().over(Window.partitionBy("rname", "pos").orderBy("ord", "num", *rest))
    return aligns.withColumn("_k", k).where(F.col("_k") <= most).drop("_k")


def top_hits(hits: DataFrame, key: str, score: str, most: int) -> DataFrame:
    """The best hits of a read, ties with the last one kept."""
    k = F.rank().over(Window.partitionBy(key).orderBy(F.desc(score)))
    return hits.withColumn("_k", k).where(F.col("_k") <= most).drop("_k")


def best_hit(hits: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The best hit of a key; a tie goes to the smallest ``tie``."""
    k = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), tie))
    return hits.withColumn("_k", k).where("_k = 1").drop("_k")


def insert_size(pos: Column, mpos: Column, length: Column) -> Column:
    """Outer distance of a pair."""
    return F.abs(mpos - pos) + length


def route(aligns: DataFrame, contig_to_group: DataFrame) -> DataFrame:
    """Rows with the group of their contig, to be written by group."""
    return aligns.join(contig_to_group, "rname")


