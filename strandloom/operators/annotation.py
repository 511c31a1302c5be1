"""Annotation joins and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(transcripts: DataFrame, *tables: DataFrame) -> DataFrame:
    """Left joins of annotation tables by transcript (J06); several rows a transcript become sorted arrays first, so rows don't multiply."""
    out = transcripts
    for t in tables:
        value = [c for c in t.columns if c != "transcript"][0]
        packed = t.groupBy("transcript").agg(F.concat_ws(",", F.array_sort(F.collect_set(F.col(value).cast("string")))).alias(value))
        out = out.join(packed, "transcript", "left")
    return out


def pathway_assignment(hits: DataFrame, terms: DataFrame, names: DataFrame) -> DataFrame:
    """(gene, ko, description) through comma lists of terms (J20). hits: gene, model; terms: model, kos; names: ko, description."""
    listed = terms.select("model", F.explode(F.split("kos", ",")).alias("ko"))
    return hits.join(listed, "model").join(names, "ko", "left").select("gene", "ko", "description")


def full_length_summary(mappings: DataFrame) -> DataFrame:
    """(genes, isoforms, merged, single) from (transcript, targets) with comma lists of gene;isoform (A28): merged transcripts have several genes."""
    rows = mappings.select("transcript", F.explode(F.split("targets", ",")).alias("t"))
    parts = rows.select("transcript", F.split("t", ";")[0].alias("gene"), F.split("t", ";")[1].alias("isoform"))
    per = parts.groupBy("transcript").agg(F.count_distinct("gene").alias("n"))
    counts = per.agg(F.sum((F.col("n") > 1).cast("int")).alias("merged"), F.sum((F.col("n") == 1).cast("int")).alias("single"), F.lit(1).alias("one"))
    return parts.agg(F.count_distinct("gene").alias("genes"), F.count_distinct("isoform").alias("isoforms"), F.lit(1).alias("one")).join(counts, "one").drop("one")


def identity_filter(hits: DataFrame, least_identity: float, most_gap_pct: float) -> DataFrame:
    """Alignments by percent identity and gap share (F20). hits: matches, mismatches, gaps."""
    total = F.col("matches") + F.col("mismatches")
    return hits.where((F.col("matches") / total * 100 >= least_identity) & (F.col("gaps") / (total + F.col("gaps")) * 100 <= most_gap_pct))


def unsampled(reads: DataFrame, *taken: DataFrame) -> DataFrame:
    """Reads that none of the tables names."""
    out = reads
    for t in taken:
        out = out.join(t.select("read_id").distinct(), "read_id", "left_anti")
    return out
