"""Queries over the smaller operators: name -> (DataFrame plan, SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import seq as S
from strandloom.operators import contigs as CT
from strandloom.operators import kmers as K
from strandloom.operators import more as M
from strandloom.operators import sampletree as ST
from strandloom.plans.expr_queries import TOY2, counts, hits, toy, transcripts
from strandloom.plans.kmer_queries import kmer_sql, read_counts, reads
from strandloom.plans.views import view, with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = with_views(sql, *views) if views else sql
        return f

    return keep


@query("w01_top_paths", "SELECT feature AS node, sample AS path, cnt AS support FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY cnt DESC, sample) AS k FROM counts) x WHERE k <= 3", "counts")
def _(s, d):
    return M.top_paths(counts(s, d).select(F.col("feature").alias("node"), F.col("sample").alias("path"), F.col("cnt").alias("support")), 2)


@query("j10_attach_sequences", "WITH r AS (SELECT DISTINCT 'r' || tid AS qname, seq FROM transcripts) SELECT a.qname, a.pos, a.num, r.seq FROM aligns a LEFT JOIN r USING (qname)", "aligns", "transcripts")
def _(s, d):
    names = transcripts(s, d).select(F.concat(F.lit("r"), F.col("tid").cast("string")).alias("name"), "seq").distinct()
    return M.attach_sequences(view(s, d, "aligns").select("qname", "pos", "num"), names)


@query("j16_exon_compatible", "SELECT feature, CASE WHEN feature % 3 = 0 THEN true WHEN feature % 3 = 1 THEN false ELSE rend - lend >= 241 END AS ok FROM features", "features")
def _(s, d):
    span = lambda l, r: F.struct(l.cast("long").alias("lend"), r.cast("long").alias("rend"))
    l, r = F.col("lend"), F.col("rend")
    a = F.array(span(l, l + 20), span(l + 40, r), span(r + 30, r + 90))
    same = F.array(span(l + 5, l + 20), span(l + 40, r), span(r + 30, r + 60))
    moved = F.array(span(l + 5, l + 21), span(l + 40, r))
    single = F.array(span(l + 41, l + 241))
    b = F.when(F.col("feature") % 3 == 0, same).when(F.col("feature") % 3 == 1, moved).otherwise(single)
    ok = M.exon_compatible(F.col("a"), F.col("b"))
    return view(s, d, "features").select("feature", a.alias("a"), b.alias("b")).select("feature", ok.alias("ok"))


@query("a23_weighted_em")
def _(s, d):
    return M.weighted_em(hits(s, d).withColumn("prob", 1 / (1 + F.col("feature") % 5)))


@query("n13_trim_short_ends", "SELECT qname, num, CASE WHEN cigar = '10M100N26M' THEN 1 WHEN cigar = '20M2I14M' THEN 2 WHEN cigar = '12M3D24M' THEN 2 ELSE 1 END AS blocks FROM aligns", "aligns")
def _(s, d):
    blocks = S.cigar_blocks(F.col("pos"), F.col("cigar"))
    return view(s, d, "aligns").select("qname", "num", F.size(M.trim_short_ends(blocks, 12)).alias("blocks"))


@query("p25_without_dangling", f"WITH {TOY2} SELECT * FROM se x WHERE NOT ((SELECT count(*) FROM se i WHERE i.component = x.component AND i.dst = x.dst) = 1 AND x.w < 2 AND NOT EXISTS (SELECT 1 FROM se o WHERE o.component = x.component AND o.src = x.dst))")
def _(s, d):
    return M.without_dangling(toy(s, d), 2)


@query("p04_walk_flanks", f"WITH c AS (SELECT kmer FROM {kmer_sql(25)} x GROUP BY kmer HAVING count(*) >= 5), st AS (SELECT DISTINCT substr(seq, 1, 25) AS kmer FROM transcripts) SELECT st.kmer AS start, st.kmer || substr(a.kmer, 25) || substr(b.kmer, 25) AS seq FROM st JOIN c a ON substr(a.kmer, 1, 24) = substr(st.kmer, 2) JOIN c b ON substr(b.kmer, 1, 24) = substr(a.kmer, 2)", "reads", "transcripts")
def _(s, d):
    starts = transcripts(s, d).select(F.substring("seq", 1, 25).alias("kmer")).distinct()
    return M.walk_flanks(K.at_least(read_counts(s, d), 5), starts, 2)


@query("p27_agglomerate")
def _(s, d):
    wide = counts(s, d).groupBy("feature").pivot("sample", ["AF", "NF", "NO", "RF"]).agg(F.sum("cnt")).na.fill(0)
    return M.agglomerate(wide.select("feature", F.array(*[F.log2(F.col(c) + 1) for c in ("AF", "NF", "NO", "RF")]).alias("value")), 5)


@query("p27_sample_correlations", "WITH g AS (SELECT f.feature, x.sample, log2(coalesce(c.cnt, 0) + 1) AS v FROM (SELECT DISTINCT feature FROM counts) f CROSS JOIN (SELECT DISTINCT sample FROM counts) x LEFT JOIN counts c ON c.feature = f.feature AND c.sample = x.sample), m AS (SELECT feature, sample, round(v - avg(v) OVER (PARTITION BY feature), 9) AS v FROM g), r AS (SELECT feature, sample, rank() OVER (PARTITION BY sample ORDER BY v) + (count(*) OVER (PARTITION BY sample, v) - 1) / 2 AS r FROM m) SELECT a.sample AS a, b.sample AS b, round(corr(a.r, b.r), 6) AS rho FROM r a JOIN r b ON a.feature = b.feature AND a.sample < b.sample GROUP BY 1, 2", "counts")
def _(s, d):
    return ST.correlations(counts(s, d).withColumnRenamed("cnt", "value")).select("a", "b", F.round("rho", 6).alias("rho"))


@query("p27_sample_clusters")
def _(s, d):
    return ST.clusters(counts(s, d).withColumnRenamed("cnt", "value"), 2)


@query("g07_reachable_kmers", f"WITH RECURSIVE c AS (SELECT kmer FROM {kmer_sql(25)} x GROUP BY kmer HAVING count(*) >= 5), st AS (SELECT DISTINCT substr(seq, 1, 25) AS start FROM transcripts), r AS (SELECT start, kmer FROM st JOIN c ON kmer = start UNION SELECT r.start, c.kmer FROM r JOIN c ON substr(c.kmer, 1, 24) = substr(r.kmer, 2)) SELECT start, kmer FROM r", "reads", "transcripts")
def _(s, d):
    kept = K.at_least(read_counts(s, d), 5)
    return CT.reachable_kmers(kept, transcripts(s, d).select(F.substring("seq", 1, 25).alias("kmer")))


@query("s07_kmer_files", f"SELECT kmer, count(*) AS cnt FROM {kmer_sql(25)} x GROUP BY kmer", "reads")
def _(s, d):
    parts = [K.count_in(reads(s, d).where(F.col("mate") == m), 25) for m in (1, 2)]
    return K.merge(parts)
