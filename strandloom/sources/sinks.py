"""Writers: rows to lines of text formats, and partitioned output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions import seq as S

WRAP = 60


def fasta_record(header: Column, seq: Column, wrap: int = WRAP) -> Column:
    """A record with lines of ``wrap`` letters."""
    body = F.rtrim(F.regexp_replace(seq, f"(.{{{wrap}}})", "$1\n"), F.lit("\n"))
    return F.concat(F.lit(">"), header, F.lit("\n"), body)


def fastq_record(name: Column, seq: Column, qual: Column) -> Column:
    """A four-line record."""
    return F.concat(F.lit("@"), name, F.lit("\n"), seq, F.lit("\n+\n"), qual)


def write_lines(df: DataFrame, line: Column, path: str, by: list[str] | None = None) -> None:
    """One line column as text files, in folders by key columns if asked (S15 to S19). Groups are put together for few files, but a large one is several tasks' and files."""
    out = df.select(*(by or []), line.alias("value"))
    writer = out.hint("rebalance", *by).write if by else out.write
    (writer.partitionBy(*by) if by else writer).text(path)


def sam_line(df: DataFrame) -> Column:
    cols = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
    return F.concat_ws("\t", *[F.col(c).cast("string") for c in cols], F.array_join("tags", "\t") if "tags" in df.columns else F.lit(None).cast("string"))


def bed_line(scaff: Column, lend: Column, rend: Column, name: Column) -> Column:
    """0-based start, exclusive end."""
    return F.concat_ws("\t", scaff, (lend - 1).cast("string"), rend.cast("string"), name.cast("string"))


def gff_line(scaff: Column, source: str, kind: str, lend: Column, rend: Column, strand: Column, attributes: Column) -> Column:
    return F.concat_ws("\t", scaff, F.lit(source), F.lit(kind), lend.cast("string"), rend.cast("string"), F.lit("."), strand, F.lit("."), attributes)


def wig_lines(track: DataFrame, stretch: int = 1_000_000) -> DataFrame:
    """(scaff, stretch, at, line): a scaffold's positions, each stretch of it behind a header of its own, whose place is before all of them (S17). Readers take repeated headers as one
    track, so a scaffold needs no single task."""
    part = F.floor(F.col("pos") / stretch)
    heads = track.select("scaff", part.alias("stretch")).distinct().select("scaff", "stretch", F.lit(-1).cast("long").alias("at"), F.concat(F.lit("variableStep chrom="), "scaff").alias("line"))
    return heads.unionByName(track.select("scaff", part.alias("stretch"), F.col("pos").cast("long").alias("at"), F.format_string("%d %s", F.col("pos").cast("long"), F.col("cov").cast("string")).alias("line")))


def write_wig(track: DataFrame, path: str, stretch: int = 1_000_000) -> None:
    """A WIG track (scaff, pos, cov) as text files, each stretch in one of them and in order."""
    wig_lines(track, stretch).repartition("scaff", "stretch").sortWithinPartitions("scaff", "stretch", "at").select("line").write.text(path)


def sam_fastq_record(df: DataFrame) -> Column:
    """An alignment's read as it was sequenced (S16): reads on the reverse strand are turned back."""
    reverse = F.col("flag").bitwiseAND(16) != 0
    mate = F.when(F.col("flag").bitwiseAND(64) != 0, "/1").when(F.col("flag").bitwiseAND(128) != 0, "/2").otherwise("")
    return fastq_record(F.concat("qname", mate), F.when(reverse, S.revcomp(F.col("seq"))).otherwise(F.col("seq")), F.when(reverse, F.reverse("qual")).otherwise(F.col("qual")))


def store(df: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """A keyed store (S20): Parquet in buckets of the key's hash, so that a look-up reads one folder."""
    df.withColumn("bucket", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets))).repartition("bucket").sortWithinPartitions(key).write.partitionBy("bucket").parquet(path)


def fetch(spark, path: str, key: str, value, buckets: int = 64) -> DataFrame:
    """Rows of one key of a store (S20): partition pruning leaves its bucket, and the sorted files' statistics most of the rest."""
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(value).cast("string")), F.lit(buckets))).first()[0]
    return spark.read.parquet(path).where((F.col("bucket") == bucket) & (F.col(key) == value)).drop("bucket")
