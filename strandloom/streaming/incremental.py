"""Structured Streaming forms of the incremental parts: k-mer counts, coverage in time, sessions, catalogue merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators import kmers as K


def kmer_counts(stream: DataFrame, k: int) -> DataFrame:
    """Running k-mer counts of a stream of sequences, for complete or update mode."""
    return K.count_in(stream, k)


def windowed_coverage(events: DataFrame, size: str = "1 hour", slide: str | None = None, late: str = "10 minutes", by: str = "event_type") -> DataFrame:
    """(start, key, n, total) of tumbling or sliding windows with late rows up to a watermark."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    out = events.withWatermark("ts", late).groupBy(w.alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), by, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour", by: str = "user_id") -> DataFrame:
    """(user, start, end, n): islands of events with gaps below ``gap``."""
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def merge_into(path: str):
    """A foreachBatch function that adds a batch's k-mer counts to a catalogue, one folder a batch (T04). A batch that runs again replaces its own
    folder, so counts are added once."""

    def merge(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return merge


def catalogue(spark, path: str) -> DataFrame:
    """The counts of all batches so far."""
    return spark.read.parquet(path).groupBy("kmer").agg(F.sum("cnt").alias("cnt"))
