"""Deterministic generators of sequences and reads: letters follow from hashes of seed and place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sequences(spark: SparkSession, n: int, length: int, seed: int = 0) -> DataFrame:
    """(id, seq): n random sequences."""
    block = lambda j: F.translate(F.md5(F.concat_ws(":", F.lit(f"s{seed}"), F.col("id").cast("string"), j.cast("string"))), "0123456789abcdef", "ACGTACGTACGTACGT")
    blocks = F.transform(F.sequence(F.lit(0), F.lit(-(-length // 32))), block)
    return spark.range(n).select("id", F.substring(F.array_join(blocks, ""), 1, length).alias("seq"))


def paired_reads(transcripts: DataFrame, n: int, length: int, fragment: int, key: str = "id", seed: int = 0) -> DataFrame:
    """(id, frag, mate, seq): n uniform fragments a transcript, the second mate from the other strand."""
    from strandloom.functions import seq as S

    spots = transcripts.where(F.length("seq") >= fragment).select(key, "seq", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("frag"))
    number = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"f{seed}"), F.col(key).cast("string"), F.col("frag").cast("string"))), 1, 8), 16, 10).cast("long")
    start = (number % (F.length("seq") - fragment + 1)).cast("int") + 1
    f = spots.select(key, "frag", F.substring("seq", start, F.lit(fragment)).alias("f"))
    mates = F.explode(F.array(F.struct(F.lit(1).alias("mate"), F.substring("f", 1, length).alias("seq")), F.struct(F.lit(2).alias("mate"), F.substring(S.revcomp(F.col("f")), 1, length).alias("seq"))))
    return f.select(key, "frag", mates.alias("m")).select(key, "frag", "m.mate", "m.seq")
