"""Queries over readers, writers and streams: inputs are written by the sinks and read back. name -> (DataFrame plan, SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import seq as S
from strandloom.operators import kmers as K
from strandloom.operators.lineage import scratch
from strandloom.plans.expr_queries import counts, transcripts
from strandloom.plans.kmer_queries import QUAL, kmer_sql, reads, with_quality
from strandloom.plans.views import rc, view, with_views
from strandloom.sources import formats, sinks
from strandloom.sources.fastq import fastq
from strandloom.streaming import incremental

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = with_views(sql, *views) if views else sql
        return f

    return keep


def written(s, df, line, tag: str) -> str:
    """The path of lines as text files."""
    path = scratch(s, tag)
    sinks.write_lines(df, line, path)
    return path


@query("s01_fasta_reader", "SELECT 't' || tid AS acc, 't' || tid || ' gene ' || gene AS header, seq FROM transcripts", "transcripts")
def _(s, d):
    header = F.format_string("t%d gene %d", "tid", "gene")
    t = transcripts(s, d)
    return formats.fasta(s, written(s, t, sinks.fasta_record(header, F.col("seq")), "fasta"))


def fastq_path(s, d) -> str:
    rows = with_quality(s, d)
    name = F.format_string("r%d/%d", "read_id", F.col("read_id") % 2 + 1)
    return written(s, rows, sinks.fastq_record(name, F.col("seq"), F.col("qual")), "fastq")


@query("s02_fastq_reader", f"WITH qr AS ({QUAL}) SELECT 'r' || read_id AS name, (read_id % 2 + 1)::INTEGER AS mate, seq, qual FROM qr", "reads")
def _(s, d):
    return formats.fastq(s, fastq_path(s, d))


@query("s02_fastq_source", f"WITH qr AS ({QUAL}) SELECT 'r' || read_id AS name, (read_id % 2 + 1)::INTEGER AS mate, seq, qual FROM qr", "reads")
def _(s, d):
    return fastq(s, fastq_path(s, d))


@query("s02_fastq_to_fasta", f"SELECT 'r' || read_id || '/2' AS header, {rc('seq')} AS seq FROM reads", "reads")
def _(s, d):
    return formats.fastq_to_fasta(formats.fastq(s, fastq_path(s, d), reverse=True, append=2))


def sam_rows(s, d):
    a = view(s, d, "aligns")
    base = F.concat("qname", F.lit(":"), F.col("num").cast("string"))
    seq = F.concat(F.translate(F.md5(base), "0123456789abcdef", "ACGTACGTACGTACGT"), F.lit("ACGT"))
    return a.select("qname", "flag", "rname", "pos", "mapq", "cigar", F.lit("=").alias("rnext"), F.col("mpos").alias("pnext"), (F.col("mpos") - F.col("pos")).alias("tlen"), seq.alias("seq"), F.repeat(F.lit("I"), 36).alias("qual"), F.array(F.concat(F.lit("NM:i:"), F.col("num").cast("string")), F.lit("XS:A:+")).alias("tags"))


def sam_back(s, d):
    rows = sam_rows(s, d)
    return formats.sam(s, written(s, rows, sinks.sam_line(rows), "sam"))


SAM_SEQ = "translate(md5(qname || ':' || num), '0123456789abcdef', 'ACGTACGTACGTACGT') || 'ACGT'"


@query("s08_sam_reader", "SELECT qname, flag::INTEGER AS flag, rname, pos::INTEGER AS pos, mapq::INTEGER AS mapq, cigar, mpos::INTEGER AS pnext, (mpos - pos)::INTEGER AS tlen, num::VARCHAR AS nm FROM aligns", "aligns")
def _(s, d):
    return sam_back(s, d).select("qname", "flag", "rname", "pos", "mapq", "cigar", "pnext", "tlen", formats.tag("NM").alias("nm"))


@query("s16_sam_to_fastq", f"WITH x AS (SELECT *, {SAM_SEQ} AS seq FROM aligns) SELECT '@' || qname || CASE WHEN flag & 64 != 0 THEN '/1' WHEN flag & 128 != 0 THEN '/2' ELSE '' END || chr(10) || CASE WHEN flag & 16 != 0 THEN {rc('seq')} ELSE seq END || chr(10) || '+' || chr(10) || repeat('I', 36) AS record FROM x", "aligns")
def _(s, d):
    rows = sam_back(s, d)
    return rows.select(sinks.sam_fastq_record(rows).alias("record"))


PSL_SQL = "SELECT feature, rend - lend + 1 AS n, feature % 5 AS mm, CASE WHEN feature % 2 = 0 THEN '+' ELSE '-' END AS strand, scaff, lend, rend FROM features"


def psl_back(s, d):
    f = view(s, d, "features")
    n, half = F.col("rend") - F.col("lend") + 1, F.floor((F.col("rend") - F.col("lend") + 1) / 2)
    text = lambda *parts: F.concat(*[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts])
    cols = [n - F.col("feature") % 5, F.col("feature") % 5, *[F.lit(0)] * 6, F.when(F.col("feature") % 2 == 0, "+").otherwise("-"), text("q", F.col("feature")), n, F.lit(0), n, F.col("scaff"), F.lit(30000), F.col("lend") - 1, F.col("rend"), F.lit(2), text(half, ",", n - half, ","), text("0,", half, ","), text(F.col("lend") - 1, ",", F.col("lend") - 1 + half, ",")]
    line = F.concat_ws("\t", *[c.cast("string") for c in cols])
    return formats.psl(s, written(s, f, line, "psl"))


@query("s09_psl_reader", f"SELECT 'q' || feature AS q_name, scaff AS t_name, (n - mm)::INTEGER AS matches, mm::INTEGER AS mismatches, round((n - mm) / n * 100, 2) AS pct_identity FROM ({PSL_SQL}) x", "features")
def _(s, d):
    return psl_back(s, d).select("q_name", "t_name", "matches", "mismatches", "pct_identity")


@query("s09_psl_blocks", f"""WITH p AS ({PSL_SQL}), h AS (SELECT *, n // 2 AS half FROM p), b AS (SELECT *, half AS size, 0 AS q FROM h UNION ALL SELECT *, n - half, half FROM h)
 SELECT 'q' || feature AS q_name, scaff AS t_name, (CASE WHEN strand = '-' THEN n - q - size + 1 ELSE q + 1 END)::INTEGER AS q_lend, (CASE WHEN strand = '-' THEN n - q ELSE q + size END)::INTEGER AS q_rend, (lend + q)::INTEGER AS t_lend, (lend + q + size - 1)::INTEGER AS t_rend FROM b""", "features")
def _(s, d):
    return formats.psl_blocks(psl_back(s, d)).select("q_name", "t_name", "q_lend", "q_rend", "t_lend", "t_rend")


@query("s10_wig_reader", "SELECT scaff, pos::INTEGER AS pos, count(*)::DOUBLE AS value FROM (SELECT scaff, unnest(range(lend, rend + 1)) AS pos FROM frags) x GROUP BY scaff, pos", "frags")
def _(s, d):
    from strandloom.operators import coverage

    path = scratch(s, "wig")
    sinks.write_wig(coverage.depth(view(s, d, "frags")), path, 5000)
    return formats.wig(s, path)


@query("s11_gff_reader", "SELECT scaff AS seqid, 'exon' AS type, lend::INTEGER AS lend, rend::INTEGER AS rend, CASE WHEN feature % 2 = 0 THEN '+' ELSE '-' END AS strand, 'e' || feature AS id, 't' || (feature // 4) AS parent FROM features", "features")
def _(s, d):
    rows = gff_back(s, d)
    return rows.select("seqid", "type", "lend", "rend", "strand", F.element_at("attr", "ID").alias("id"), F.element_at("attr", "Parent").alias("parent"))


def gff_back(s, d):
    f = view(s, d, "features")
    strand = F.when(F.col("feature") % 2 == 0, "+").otherwise("-")
    line = sinks.gff_line(F.col("scaff"), "strandloom", "exon", F.col("lend"), F.col("rend"), strand, F.format_string("ID=e%d;Parent=t%d", "feature", F.floor(F.col("feature") / 4).cast("long")))
    return formats.gff(s, written(s, f, line, "gff"))


MODELS = "e AS (SELECT 't' || gene AS transcript, CASE WHEN gene % 2 = 0 THEN '+' ELSE '-' END AS strand, tid % 4 * 100 + 1 + gene % 7 AS lend, tid % 4 * 100 + 60 + gene % 7 AS rend, gene FROM transcripts), c AS (SELECT transcript, strand, min(lend) + 10 AS cl, max(rend) - 15 AS cr FROM e GROUP BY ALL)"


def models(s, d):
    t = transcripts(s, d)
    at = F.col("tid") % 4 * 100 + F.col("gene") % 7
    exons = t.select(F.concat(F.lit("t"), F.col("gene").cast("string")).alias("transcript"), F.concat(F.lit("g"), F.col("gene").cast("string")).alias("seqid"), F.when(F.col("gene") % 2 == 0, "+").otherwise("-").alias("strand"), F.struct((at + 1).cast("int").alias("lend"), (at + 60).cast("int").alias("rend")).alias("e"))
    return exons.groupBy("transcript", "seqid", "strand").agg(F.array_sort(F.collect_list("e")).alias("exons"))


@query("n23_introns", f"WITH {MODELS} SELECT transcript, (p + 1)::INTEGER AS lend, (lend - 1)::INTEGER AS rend FROM (SELECT *, lag(rend) OVER (PARTITION BY transcript ORDER BY lend) AS p FROM e) x WHERE p IS NOT NULL", "transcripts")
def _(s, d):
    return formats.introns(models(s, d))


def scaffolds(s, d):
    return transcripts(s, d).groupBy(F.concat(F.lit("g"), F.col("gene").cast("string")).alias("seqid")).agg(F.repeat(F.min("seq"), 5).alias("seq"))


SCAFFOLDS = "g AS (SELECT 't' || gene AS transcript, repeat(min(seq), 5) AS seq FROM transcripts GROUP BY gene)"


@query("n23_spliced", f"WITH {MODELS}, {SCAFFOLDS}, j AS (SELECT transcript, strand, string_agg(substr(seq, lend::INTEGER, 60), '' ORDER BY lend) AS x FROM e JOIN g USING (transcript) GROUP BY ALL) SELECT transcript, CASE WHEN strand = '-' THEN {rc('x')} ELSE x END AS seq FROM j", "transcripts")
def _(s, d):
    return formats.spliced(models(s, d), scaffolds(s, d))


@query("n23_splice_sites", f"WITH {MODELS}, {SCAFFOLDS}, i AS (SELECT transcript, strand, p + 1 AS l, lend - 1 AS r FROM (SELECT *, lag(rend) OVER (PARTITION BY transcript ORDER BY lend) AS p FROM e) x WHERE p IS NOT NULL), v AS (SELECT transcript, l, r, CASE WHEN strand = '-' THEN {rc('substr(seq, (r - 1)::INTEGER, 2)')} ELSE substr(seq, l::INTEGER, 2) END AS donor, CASE WHEN strand = '-' THEN {rc('substr(seq, l::INTEGER, 2)')} ELSE substr(seq, (r - 1)::INTEGER, 2) END AS acceptor FROM i JOIN g USING (transcript)) SELECT transcript, l::INTEGER AS lend, r::INTEGER AS rend, donor, acceptor, donor || '-' || acceptor IN ('GT-AG', 'GC-AG', 'AT-AC') AS valid FROM v", "transcripts")
def _(s, d):
    return formats.splice_sites(models(s, d), scaffolds(s, d))


@query("n23_coding_parts", f"""WITH {MODELS}, x AS (SELECT e.transcript, e.strand, lend, rend, cl, cr FROM e JOIN c USING (transcript)), p AS (SELECT transcript, strand, CASE WHEN strand = '-' THEN '3prime_UTR' ELSE '5prime_UTR' END AS kind, lend AS l, least(rend, cl - 1) AS r FROM x UNION ALL SELECT transcript, strand, 'CDS', greatest(lend, cl), least(rend, cr) FROM x UNION ALL SELECT transcript, strand, CASE WHEN strand = '-' THEN '5prime_UTR' ELSE '3prime_UTR' END, greatest(lend, cr + 1), rend FROM x),
 q AS (SELECT *, sum(r - l + 1) OVER (PARTITION BY transcript, kind ORDER BY CASE WHEN strand = '-' THEN -l ELSE l END) - (r - l + 1) AS b FROM p WHERE l <= r) SELECT transcript, kind, l::INTEGER AS lend, r::INTEGER AS rend, CASE WHEN kind = 'CDS' THEN ((3 - b % 3) % 3)::INTEGER::VARCHAR ELSE '.' END AS phase FROM q""", "transcripts")
def _(s, d):
    m = models(s, d)
    lend, rend = F.array_min(F.transform("exons", lambda e: e["lend"])), F.array_max(F.transform("exons", lambda e: e["rend"]))
    return formats.coding_parts(m.withColumn("cds_lend", lend + 10).withColumn("cds_rend", rend - 15))


@query("s12_vcf_reader", "SELECT scaff AS chrom, lend::INTEGER AS pos, 'A' AS ref, 'G' AS alt, (feature % 50)::VARCHAR AS dp, 'x' || feature AS id FROM features", "features")
def _(s, d):
    f = view(s, d, "features")
    line = F.concat_ws("\t", "scaff", F.col("lend").cast("string"), F.format_string("x%d", "feature"), F.lit("A"), F.lit("G"), F.lit("9"), F.lit("PASS"), F.format_string("DP=%d;AF=0.5", F.col("feature") % 50))
    return formats.vcf(s, written(s, f, line, "vcf")).select("chrom", "pos", "ref", "alt", F.element_at("tags", "DP").alias("dp"), "id")


@query("s13_edge_list_reader", "SELECT gene AS component, (tid % 4)::INTEGER AS node, (tid % 4 - 1)::INTEGER AS prev, tid AS support, seq AS kmer FROM transcripts", "transcripts")
def _(s, d):
    t = transcripts(s, d)
    line = F.concat(F.format_string("Component %d\n", "gene"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("tid").alias("tid"), F.col("seq").alias("seq")))), lambda x: F.concat_ws(" ", (x["tid"] % 4).cast("string"), (x["tid"] % 4 - 1).cast("string"), x["tid"].cast("string"), x["seq"], F.lit("1"))), "\n"))
    lines = t.groupBy("gene").agg(line.alias("line"))
    return formats.edge_list(s, written(s, lines, F.col("line"), "edges"))


@query("s14_hmmer_reader", "SELECT 'd' || feature % 90 AS target, 'q' || feature || '_' || sample AS query, cnt / 1000 AS e_value, cnt::DOUBLE AS score, 'some domain ' || feature AS description FROM counts", "counts")
def _(s, d):
    c = counts(s, d)
    line = F.concat_ws("   ", F.format_string("d%d", F.col("feature") % 90), F.lit("PF1"), F.format_string("q%d_%s", "feature", "sample"), F.lit("-"), (F.col("cnt") / 1000).cast("string"), F.col("cnt").cast("string"), *[F.lit("0.0")] * 12, F.format_string("some domain %d", "feature"))
    return formats.hmmer_table(s, written(s, c.unionByName(c.limit(0)), line, "hmmer"))


@query("s14_blast_xml_reader", "SELECT 'q' || feature || '_' || sample AS query, 'hit ' || feature % 77 AS hit, 1 / (1e6 + cnt) AS e_value FROM counts WHERE feature % 2 = 0", "counts")
def _(s, d):
    c = counts(s, d)
    e = F.when(F.col("feature") % 2 == 0, 1 / (1e6 + F.col("cnt"))).otherwise(F.lit(0.5))
    line = F.concat(F.format_string("<Iteration><Iteration_query-def>q%d_%s</Iteration_query-def><Iteration_hits><Hit><Hit_def>hit %d</Hit_def><Hit_hsps><Hsp><Hsp_evalue>", "feature", "sample", F.col("feature") % 77), e.cast("string"), F.lit("</Hsp_evalue></Hsp></Hit_hsps></Hit></Iteration_hits></Iteration>"))
    reports = -(-c.count() // 500) or 1  # a report a file, of some hundred queries
    rows = c.select(F.pmod(F.xxhash64("feature", "sample"), F.lit(reports)).alias("report"), line.alias("line")).groupBy("report").agg(F.concat(F.lit("<BlastOutput>\n"), F.array_join(F.collect_list("line"), "\n"), F.lit("\n</BlastOutput>")).alias("line"))
    path = scratch(s, "blast")
    sinks.write_lines(rows, F.col("line"), path, ["report"])
    return formats.blast_xml(s, path)


@query("s14_kegg_reader", "SELECT 't' || tid AS query, unnest(CASE tid % 3 WHEN 0 THEN [NULL] WHEN 1 THEN ['K' || gene] ELSE ['K' || gene, 'K' || gene + 1] END) AS ko FROM transcripts", "transcripts")
def _(s, d):
    t = transcripts(s, d)
    ids = F.when(F.col("tid") % 3 == 0, "").when(F.col("tid") % 3 == 1, F.format_string("K%d", "gene")).otherwise(F.format_string("K%d,K%d", "gene", F.col("gene") + 1))
    return formats.kegg(s, written(s, t, F.concat(F.format_string("t%d ", "tid"), ids), "kegg"))


@query("s14_kegg_terms", "SELECT 'K' || s_suppkey AS ko, 'pathway of ' || s_name AS description FROM supplier")
def _(s, d):
    return formats.kegg_terms(s, written(s, s.read.parquet(f"{d}/supplier.parquet"), F.format_string("K%d  pathway of   %s", "s_suppkey", "s_name"), "kegg-terms"))


@query("s14_signalp_reader", "SELECT 't' || tid AS query, CASE WHEN tid % 2 = 0 THEN 'Y' ELSE 'N' END AS secreted FROM transcripts", "transcripts")
def _(s, d):
    t = transcripts(s, d)
    line = F.concat_ws("  ", F.format_string("t%d", "tid"), *[F.lit("0.1")] * 8, F.when(F.col("tid") % 2 == 0, "Y").otherwise("N"), F.lit("0.45"))
    return formats.signalp(s, written(s, t, line, "signalp"))


@query("s14_tmhmm_reader", "SELECT 't' || tid AS query, length(seq)::INTEGER AS len, (tid % 50 / 10.0)::DOUBLE AS exp_aa, 0.5::DOUBLE AS first60, (tid % 4)::INTEGER AS helices, 'o' || tid || '-' || (tid + 20) || 'i' AS topology FROM transcripts", "transcripts")
def _(s, d):
    t = transcripts(s, d)
    line = F.concat_ws("\t", F.format_string("t%d", "tid"), F.format_string("len=%d", F.length("seq")), F.concat(F.lit("ExpAA="), (F.col("tid") % 50 / 10.0).cast("string")), F.lit("First60=0.5"), F.format_string("PredHel=%d", F.col("tid") % 4), F.format_string("Topology=o%d-%di", "tid", F.col("tid") + 20))
    return formats.tmhmm(s, written(s, t, line, "tmhmm"))


@query("s19_group_files", "SELECT db, count(*) AS n, sum(length(seq))::BIGINT AS letters FROM reads GROUP BY db", "reads")
def _(s, d):
    path = scratch(s, "groups")
    sinks.write_lines(reads(s, d).select("db", "seq"), F.col("seq"), path, ["db"])
    return s.read.text(path).groupBy("db").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("letters"))


@query("s20_keyed_store", "SELECT feature, sample, cnt FROM counts WHERE feature = 42", "counts")
def _(s, d):
    path = scratch(s, "store")
    sinks.store(counts(s, d), path, "feature", 8)
    return sinks.fetch(s, path, "feature", 42, 8).select("feature", "sample", "cnt")


# Streams: what was written is read as a stream, to its end.

def streamed(s, df, tag: str):
    path = scratch(s, f"{tag}-in")
    df.write.parquet(path)
    return s.readStream.schema(df.schema).option("maxFilesPerTrigger", 4).parquet(path)


def ended(s, stream, tag: str, merge=None, mode: str = "complete"):
    """Runs a stream over all that is there; gives its last result."""
    out, state = scratch(s, f"{tag}-out"), scratch(s, f"{tag}-state")
    save = merge(out) if merge else (lambda batch, n: batch.write.mode("overwrite").parquet(out))
    stream.writeStream.outputMode(mode).option("checkpointLocation", state).foreachBatch(save).trigger(availableNow=True).start().awaitTermination()
    return out


@query("t01_streamed_kmer_counts", f"SELECT kmer, count(*) AS cnt FROM {kmer_sql(11, 'transcripts', 'tid')} x GROUP BY kmer", "transcripts")
def _(s, d):
    stream = streamed(s, transcripts(s, d).select("seq"), "t01")
    return s.read.parquet(ended(s, incremental.kmer_counts(stream, 11), "t01"))


def events(s, d):
    return s.read.parquet(f"{d}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", F.col("value").cast("double").alias("value"))


@query("t02_streamed_windows", "SELECT epoch(time_bucket(INTERVAL 1 HOUR, ts::TIMESTAMP))::BIGINT AS start_s, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def _(s, d):
    out = s.read.parquet(ended(s, incremental.windowed_coverage(streamed(s, events(s, d), "t02")), "t02"))
    return out.select(F.unix_timestamp("start").alias("start_s"), "event_type", "n", F.round("total", 4).alias("total"))


@query("t03_streamed_sessions", "WITH o AS (SELECT user_id, ts::TIMESTAMP AS ts, CASE WHEN ts::TIMESTAMP - lag(ts::TIMESTAMP) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o) SELECT user_id, floor(epoch(min(ts)))::BIGINT AS start_s, floor(epoch(max(ts)))::BIGINT + 1800 AS end_s, count(*) AS n FROM g GROUP BY user_id, k")
def _(s, d):
    out = s.read.parquet(ended(s, incremental.sessions(streamed(s, events(s, d), "t03")), "t03"))
    return out.select("user_id", F.unix_timestamp("start").alias("start_s"), F.unix_timestamp("end").alias("end_s"), "n")


@query("t04_catalogue", f"SELECT kmer, count(*) AS cnt FROM {kmer_sql(11, 'transcripts', 'tid')} x GROUP BY kmer", "transcripts")
def _(s, d):
    stream = streamed(s, transcripts(s, d).select("seq"), "t04")

    def merge(out):
        add = incremental.merge_into(out)
        return lambda batch, n: add(K.count_in(batch, 11), n)

    return incremental.catalogue(s, ended(s, stream, "t04", merge, "append"))


@query("u06_sql_functions", f"SELECT tid, {rc('seq')} AS rc, least(seq, {rc('seq')}) AS canon FROM transcripts", "transcripts")
def _(s, d):
    S.register(s)
    transcripts(s, d).createOrReplaceTempView("transcripts")
    return s.sql("SELECT tid, revcomp(seq) AS rc, canonical_kmer(seq) AS canon FROM transcripts")


@query("k32_table_estimate", "SELECT sum(greatest(length(seq) - 25 + 1, 0))::BIGINT AS n_mers, 16::BIGINT AS entry_bytes, sum(greatest(length(seq) - 25 + 1, 0))::BIGINT * 16 AS table_bytes, greatest(ceil(sum(greatest(length(seq) - 25 + 1, 0)) * 16 / 65536), 1)::BIGINT AS partitions FROM reads", "reads")
def _(s, d):
    return K.table_estimate(reads(s, d), 25, 65536)
