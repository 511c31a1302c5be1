"""Readers of sequence, alignment, coverage and annotation files, all on Spark's own text and CSV sources.

Record readers set the line separator to what parts records, so files are split and read in parallel like any text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions import seq as S

SAM = "qname STRING, flag INT, rname STRING, pos INT, mapq INT, cigar STRING, rnext STRING, pnext INT, tlen INT, seq STRING, qual STRING"
PSL = "matches INT, mismatches INT, rep_matches INT, n_count INT, q_gaps INT, q_gap_bases INT, t_gaps INT, t_gap_bases INT, strand STRING, q_name STRING, q_size INT, q_start INT, q_end INT, t_name STRING, t_size INT, t_start INT, t_end INT, blocks INT, block_sizes STRING, q_starts STRING, t_starts STRING"
GFF = "seqid STRING, source STRING, type STRING, lend INT, rend INT, score STRING, strand STRING, phase STRING, attributes STRING"
VCF = "chrom STRING, pos INT, id STRING, ref STRING, alt STRING, qual STRING, filter STRING, info STRING"


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(acc, header, seq): the accession is the header's first token (S01). Sequences may span lines."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", r"^>", "").alias("r")).where("trim(r) != ''")
    header = F.regexp_extract("r", r"^([^\n]*)", 1)
    return records.select(F.regexp_extract(header, r"^\s*(\S*)", 1).alias("acc"), F.trim(header).alias("header"), F.regexp_replace(F.regexp_replace("r", r"^[^\n]*", ""), r"\s", "").alias("seq"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, at) of text lines: at grows along a file. A line's place in its file is that of its split, then that in the split, so files are read in parallel."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))


def _after_heads(lines: DataFrame, head: Column) -> DataFrame:
    """Lines with the last head at or before each (null before the first). Within a split that is a window over the split; what a split begins with comes from the last
    head of the splits before, of which there is a row each."""
    rows = lines.withColumn("_h", head)
    inside = Window.partitionBy("file", "start").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy("file", "start").agg(F.max_by("_h", F.when(F.col("_h").isNotNull(), F.col("at"))).alias("_last"))
    carried = splits.select("file", "start", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    out = rows.withColumn("_in", F.last("_h", ignorenulls=True).over(inside)).join(carried, ["file", "start"])
    return out.withColumn("head", F.coalesce("_in", "_carried")).drop("_h", "_in", "_carried")


def fastq(spark: SparkSession, path: str, reverse: bool = False, append: int | None = None, ignore_dirty: bool = True) -> DataFrame:
    """(name, mate, seq, qual) of four-line records (S02): ``/1``, ``/2`` or the mate digit after a space tell the mate. A record's lines are four neighbours; which line of
    four a line is follows from its number in its file: its number in its split and the lines of the splits before. reverse gives reverse complements, append names the mate. Dirty
    records (other marks, sequence and qualities of different lengths) are left out, or an error if ignore_dirty is false."""
    lines = _lines(spark, path).withColumn("value", F.regexp_replace("value", "\r$", ""))
    sizes = lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("_n"), F.min("at").alias("_first"))
    order = Window.partitionBy("file").orderBy("start")
    before = sizes.select("file", "start", "_first", (F.sum("_n").over(order) - F.col("_n")).alias("_before"))
    rows = lines.join(before, ["file", "start"]).withColumn("_n", F.col("_before") + F.col("at") - F.col("_first"))
    line = lambda k: F.max(F.when(F.col("_n") % 4 == k, F.col("value")))
    record = rows.groupBy("file", F.floor(F.col("_n") / 4).alias("_r")).agg(*[line(k).alias(c) for k, c in enumerate(("h", "seq", "plus", "qual"))])
    clean = F.col("h").startswith("@") & F.coalesce(F.col("plus").startswith("+"), F.lit(False)) & (F.length("seq") > 0) & F.coalesce(F.length("seq") == F.length("qual"), F.lit(False)) & F.col("qual").rlike(r"\S")
    clean = F.coalesce(clean, F.lit(False))
    record = record.where(clean) if ignore_dirty else record.where(F.when(clean, True).otherwise(F.raise_error(F.concat(F.lit("dirty record: "), F.coalesce("h", F.lit(""))))))
    name = F.regexp_extract("h", r"^@(\S+)", 1)
    mate = F.coalesce(F.nullif(F.regexp_extract(name, r"/([12])$", 1), F.lit("")), F.nullif(F.regexp_extract("h", r"^\S+\s+([12]):", 1), F.lit("")))
    seq, qual = (S.revcomp(F.col("seq")), F.reverse("qual")) if reverse else (F.col("seq"), F.col("qual"))
    return record.select(F.regexp_replace(name, r"/[12]$", "").alias("name"), (mate.cast("int") if append is None else F.lit(append)).alias("mate"), seq.alias("seq"), qual.alias("qual"))


def fastq_to_fasta(records: DataFrame) -> DataFrame:
    """(header, seq): names with their mate, ``/1`` or ``/2``."""
    return records.select(F.concat("name", F.coalesce(F.concat(F.lit("/"), F.col("mate").cast("string")), F.lit(""))).alias("header"), "seq")


def valid_fastq(records: DataFrame) -> Column:
    """Whether a record is whole: sequence and qualities of one length, no other letters."""
    return F.col("seq").isNotNull() & F.col("qual").isNotNull() & (F.length("seq") == F.length("qual")) & F.col("seq").rlike("^[ACGTNacgtn.]+$")


def colour_space(records: DataFrame) -> DataFrame:
    """Colour reads without primer and first colour, digits as letters."""
    return records.withColumn("seq", F.translate(F.expr("substring(seq, 3)"), "0123.", "ACGTN"))


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment rows without header lines, with tags as an array."""
    lines = spark.read.text(path).where(~F.col("value").startswith("@"))
    f = F.split("value", "\t")
    cols = [c.strip().split(" ") for c in SAM.split(",")]
    return lines.select(*[f[i].cast(kind).alias(name) for i, (name, kind) in enumerate(cols)], F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0))).alias("tags"))


def tag(name: str) -> Column:
    """The value of an alignment tag, null if it isn't there."""
    found = F.filter("tags", lambda t: t.startswith(name + ":"))
    return F.regexp_extract(F.get(found, F.lit(0)), r"^[^:]*:[^:]*:(.*)$", 1)


def tabular(spark: SparkSession, path: str, schema: str, comment: str = "#") -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").option("comment", comment).option("quote", "").csv(path)


def psl(spark: SparkSession, path: str) -> DataFrame:
    """PSL rows with percent identity (S09, N21); header lines are skipped as they don't start with a number."""
    rows = tabular(spark, path, PSL).where("matches IS NOT NULL")
    return rows.withColumn("pct_identity", F.round(F.col("matches") / (F.col("matches") + F.col("mismatches")) * 100, 2))


def psl_blocks(rows: DataFrame) -> DataFrame:
    """(q_name, t_name, strand, q_lend, q_rend, t_lend, t_rend) of each block, 1-based; on the minus strand query places are mirrored."""
    ints = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("int"))
    b = rows.select("q_name", "t_name", "strand", "q_size", F.explode(F.arrays_zip(ints("block_sizes").alias("n"), ints("q_starts").alias("q"), ints("t_starts").alias("t"))).alias("b"))
    minus, n, q, t = F.col("strand") == "-", F.col("b.n"), F.col("b.q"), F.col("b.t")
    return b.select("q_name", "t_name", "strand", F.when(minus, F.col("q_size") - q - n + 1).otherwise(q + 1).alias("q_lend"), F.when(minus, F.col("q_size") - q).otherwise(q + n).alias("q_rend"), (t + 1).alias("t_lend"), (t + n).alias("t_rend"))


def wig(spark: SparkSession, path: str) -> DataFrame:
    """(scaff, pos, value) of variableStep tracks (S10). A scaffold's lines follow its header."""
    head = F.nullif(F.regexp_extract("value", r"^variableStep\s+chrom=(\S+)", 1), F.lit(""))
    rows = _after_heads(_lines(spark, path), head).where(F.col("value").rlike(r"^\d"))
    f = F.split("value", r"\s+")
    return rows.select(F.col("head").alias("scaff"), f[0].cast("int").alias("pos"), f[1].cast("double").alias("value"))


def gff(spark: SparkSession, path: str) -> DataFrame:
    """GFF3 or GTF rows with attributes as a map."""
    rows = tabular(spark, path, GFF)
    pairs = F.filter(F.transform(F.split("attributes", ";"), lambda x: F.trim(x)), lambda x: x != "")
    entry = lambda x: F.struct(F.regexp_extract(x, r"^([^=\s]+)", 1).alias("key"), F.regexp_extract(x, r'^[^=\s]+[=\s]+"?([^"]*)"?$', 1).alias("value"))
    return rows.withColumn("attr", F.map_from_entries(F.array_distinct(F.transform(pairs, entry)))).drop("attributes")


def gene_models(features: DataFrame, parent: str = "Parent") -> DataFrame:
    """(transcript, seqid, strand, exons) with exons sorted."""
    exons = features.where("type = 'exon'").select(F.element_at("attr", parent).alias("transcript"), "seqid", "strand", F.struct("lend", "rend").alias("e"))
    return exons.groupBy("transcript", "seqid", "strand").agg(F.array_sort(F.collect_list("e")).alias("exons"))


def introns(models: DataFrame) -> DataFrame:
    """(transcript, lend, rend) between neighbouring exons."""
    pairs = models.where("size(exons) > 1").select("transcript", F.explode(F.zip_with(F.slice("exons", 1, F.size("exons") - 1), F.slice("exons", 2, F.size("exons") - 1), lambda a, b: F.struct((a["rend"] + 1).alias("lend"), (b["lend"] - 1).alias("rend")))).alias("i"))
    return pairs.select("transcript", "i.lend", "i.rend")


def vcf(spark: SparkSession, path: str) -> DataFrame:
    """VCF rows with INFO as a map."""
    entry = lambda x: F.struct(F.split(x, "=")[0].alias("key"), F.get(F.split(x, "="), F.lit(1)).alias("value"))
    return tabular(spark, path, VCF).withColumn("tags", F.map_from_entries(F.transform(F.split("info", ";"), entry)))


def edge_list(spark: SparkSession, path: str) -> DataFrame:
    """(component, node, prev, support, kmer) of graph files with ``Component N`` lines."""
    head = F.nullif(F.regexp_extract("value", r"^Component\s+(\d+)", 1), F.lit(""))
    rows = _after_heads(_lines(spark, path), head).where(~F.col("value").startswith("Component"))
    f = F.split("value", r"\s+")
    return rows.select(F.col("head").cast("long").alias("component"), f[0].cast("int").alias("node"), f[1].cast("int").alias("prev"), f[2].cast("long").alias("support"), f[3].alias("kmer"))


def hmmer_table(spark: SparkSession, path: str) -> DataFrame:
    """(target, query, e_value, score, description) of HMMER tables: 18 columns, then free text."""
    f = F.split(F.trim("value"), r"\s+", 19)
    return spark.read.text(path).where(~F.col("value").startswith("#")).select(f[0].alias("target"), f[2].alias("query"), f[4].cast("double").alias("e_value"), f[5].cast("double").alias("score"), f[18].alias("description"))


BLAST = "`Iteration_query-def` STRING, Iteration_hits STRUCT<Hit: ARRAY<STRUCT<Hit_def: STRING, Hit_hsps: STRUCT<Hsp: ARRAY<STRUCT<Hsp_evalue: DOUBLE>>>>>>"


def blast_xml(spark: SparkSession, path: str, most_e: float = 1e-5) -> DataFrame:
    """(query, hit, e_value) of BLAST XML reports below an E value, which is that of a hit's first alignment."""
    rows = spark.read.format("xml").option("rowTag", "Iteration").schema(BLAST).load(path)
    hits = rows.select(F.col("`Iteration_query-def`").alias("query"), F.explode(F.col("Iteration_hits.Hit")).alias("h"))
    return hits.select("query", F.col("h.Hit_def").alias("hit"), F.get(F.col("h.Hit_hsps.Hsp"), F.lit(0))["Hsp_evalue"].alias("e_value")).where(F.col("e_value") <= most_e)


def kegg(spark: SparkSession, path: str) -> DataFrame:
    """(query, ko) of assignment lists: a name, then identifiers parted by commas; names without one are kept with null."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where("trim(value) != ''").select(f[0].alias("query"), F.get(f, F.lit(1)).alias("kos"))
    return rows.select("query", F.explode_outer(F.split("kos", ",")).alias("ko"))


def kegg_terms(spark: SparkSession, path: str) -> DataFrame:
    """(ko, description): the first token and the rest of each line."""
    return spark.read.text(path).where("trim(value) != ''").select(F.regexp_extract("value", r"^\s*(\S+)", 1).alias("ko"), F.regexp_replace(F.trim(F.regexp_extract("value", r"^\s*\S+(.*)$", 1)), r"\s+", " ").alias("description"))


def signalp(spark: SparkSession, path: str) -> DataFrame:
    """(query, secreted): the first and tenth column of short signalP tables; comments and shorter lines don't count."""
    f = F.split(F.trim("value"), r"\s+")
    return spark.read.text(path).where(~F.col("value").startswith("#")).where(F.size(f) > 9).select(f[0].alias("query"), f[9].alias("secreted"))


def tmhmm(spark: SparkSession, path: str) -> DataFrame:
    """(query, len, exp_aa, first60, helices, topology) of short TMHMM tables; values may be written as name=value."""
    f = F.split(F.trim("value"), r"\s+")
    value = lambda k: F.regexp_replace(f[k], r"^[^=]*=", "")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).where(F.size(f) > 5)
    return rows.select(f[0].alias("query"), value(1).cast("int").alias("len"), value(2).cast("double").alias("exp_aa"), value(3).cast("double").alias("first60"), value(4).cast("int").alias("helices"), value(5).alias("topology"))


def spliced(models: DataFrame, sequences: DataFrame) -> DataFrame:
    """(transcript, seq): exons joined, reverse-complemented on the minus strand (N23). sequences: (seqid, seq)."""
    rows = models.join(sequences.select("seqid", F.col("seq").alias("_s")), "seqid")
    cdna = F.array_join(F.transform("exons", lambda e: F.substring(F.col("_s"), e["lend"], e["rend"] - e["lend"] + 1)), "")
    return rows.select("transcript", F.when(F.col("strand") == "-", S.revcomp(cdna)).otherwise(cdna).alias("seq"))


def splice_sites(models: DataFrame, sequences: DataFrame) -> DataFrame:
    """(transcript, lend, rend, donor, acceptor, valid) of each intron (N23): its first and last two letters in the direction of transcription; GT-AG, GC-AG and AT-AC are valid."""
    rows = introns(models).join(models.select("transcript", "seqid", "strand"), "transcript").join(sequences.select("seqid", F.col("seq").alias("_s")), "seqid")
    two = lambda at: F.substring(F.col("_s"), at, F.lit(2))
    minus = F.col("strand") == "-"
    donor = F.when(minus, S.revcomp(two(F.col("rend") - 1))).otherwise(two(F.col("lend")))
    acceptor = F.when(minus, S.revcomp(two(F.col("lend")))).otherwise(two(F.col("rend") - 1))
    out = rows.select("transcript", "lend", "rend", donor.alias("donor"), acceptor.alias("acceptor"))
    return out.withColumn("valid", F.concat("donor", F.lit("-"), "acceptor").isin("GT-AG", "GC-AG", "AT-AC"))


def coding_parts(models: DataFrame) -> DataFrame:
    """(transcript, kind, lend, rend, phase) of models with a coding span cds_lend to cds_rend (N23): each exon's part inside it is CDS, with the phase, how many of its first
    letters end the codon before (a dot elsewhere); what is left is 5' or 3' UTR, by strand."""
    e = models.where("cds_lend IS NOT NULL").select("transcript", "strand", "cds_lend", "cds_rend", F.explode("exons").alias("e")).select("transcript", "strand", "cds_lend", "cds_rend", "e.lend", "e.rend")
    minus = F.col("strand") == "-"
    part = lambda kind, l, r: F.struct(kind.alias("kind"), l.cast("int").alias("lend"), r.cast("int").alias("rend"))
    low = part(F.when(minus, "3prime_UTR").otherwise("5prime_UTR"), F.col("lend"), F.least("rend", F.col("cds_lend") - 1))
    mid = part(F.lit("CDS"), F.greatest("lend", "cds_lend"), F.least("rend", "cds_rend"))
    high = part(F.when(minus, "5prime_UTR").otherwise("3prime_UTR"), F.greatest("lend", F.col("cds_rend") + 1), F.col("rend"))
    parts = e.select("transcript", "strand", F.explode(F.array(low, mid, high)).alias("p")).select("transcript", "strand", "p.*").where("lend <= rend")
    along = Window.partitionBy("transcript", "kind").orderBy(F.when(minus, -F.col("lend")).otherwise(F.col("lend"))).rowsBetween(Window.unboundedPreceding, 0)
    size = F.col("rend") - F.col("lend") + 1
    return parts.withColumn("_before", F.sum(size).over(along) - size).select("transcript", "kind", "lend", "rend", F.when(F.col("kind") == "CDS", F.pmod(-F.col("_before"), F.lit(3)).cast("string")).otherwise(".").alias("phase"))
