"""Queries over alignments, intervals and coverage: name -> (DataFrame plan, SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import seq as S
from strandloom.operators import alignments as A
from strandloom.operators import coverage as C
from strandloom.operators import intervals as I
from strandloom.plans.views import view, with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = with_views(sql, *views)
        return f

    return keep


def aligns(spark, d):
    return view(spark, d, "aligns")


def frags(spark, d):
    return view(spark, d, "frags")


def features(spark, d):
    return view(spark, d, "features")


def dense(spark, d):
    return view(spark, d, "dense_frags"), view(spark, d, "dense_features")


ROW = "qname, flag, rname, pos"


@query("f12_flag_predicates", "SELECT " + ", ".join(f"sum(CASE WHEN flag & {bit} != 0 THEN 1 ELSE 0 END)::BIGINT AS {name}" for name, bit in A.FLAGS.items()) + " FROM aligns", "aligns")
def _(spark, d):
    return aligns(spark, d).agg(*[F.sum(A.has(F.col("flag"), n).cast("int")).alias(n) for n in A.FLAGS])


@query("f13_drop_unmapped", f"SELECT {ROW} FROM aligns WHERE flag & 4 = 0", "aligns")
def _(spark, d):
    return A.mapped(aligns(spark, d)).select("qname", "flag", "rname", "pos")


@query("f14_proper_pairs", f"SELECT {ROW} FROM aligns WHERE flag & 2 != 0", "aligns")
def _(spark, d):
    return A.proper_pairs(aligns(spark, d)).select("qname", "flag", "rname", "pos")


@query("f14_consistent_pairs", "SELECT qname, flag, rname, pos, mpos FROM aligns a WHERE flag & 2 != 0 AND EXISTS (SELECT 1 FROM aligns b WHERE b.flag & 2 != 0 AND b.qname = a.qname AND b.rname = a.rname AND b.pos = a.mpos AND b.mpos = a.pos AND (b.flag & 128 != 0) = (a.flag & 64 != 0))", "aligns")
def _(spark, d):
    return A.consistent_pairs(aligns(spark, d)).select("qname", "flag", "rname", "pos", "mpos")


@query("f15_flag_description", """SELECT flag, count(*) AS n, concat_ws('_', CASE WHEN flag & 1 != 0 THEN 'paired' ELSE 'single' END, CASE WHEN flag & 2 != 0 THEN 'proper' END,
 CASE WHEN flag & 4 != 0 THEN 'unmapped' ELSE 'read' || CASE WHEN flag & 16 != 0 THEN '-' ELSE '+' END END, CASE WHEN flag & 1 != 0 THEN CASE WHEN flag & 8 != 0 THEN 'mateunmapped' ELSE 'mate' || CASE WHEN flag & 32 != 0 THEN '-' ELSE '+' END END END,
 CASE WHEN flag & 64 != 0 THEN 'first' END, CASE WHEN flag & 128 != 0 THEN 'second' END) AS words FROM aligns GROUP BY flag""", "aligns")
def _(spark, d):
    return aligns(spark, d).groupBy("flag").agg(F.count(F.lit(1)).alias("n")).withColumn("words", A.describe_flag(F.col("flag")))


STRAND = "CASE WHEN flag & 64 != 0 THEN CASE WHEN flag & 16 != 0 THEN '{m}' ELSE '{p}' END ELSE CASE WHEN flag & 16 != 0 THEN '{p}' ELSE '{m}' END END"


@query("f16_transcribed_strand", f"SELECT qname, num, {STRAND.format(p='+', m='-')} AS fr, {STRAND.format(p='-', m='+')} AS rf FROM aligns", "aligns")
def _(spark, d):
    return aligns(spark, d).select("qname", "num", A.transcribed_strand(F.col("flag"), "FR").alias("fr"), A.transcribed_strand(F.col("flag"), "RF").alias("rf"))


@query("f17_strand_split", f"SELECT strand, count(*) AS n FROM (SELECT {STRAND.format(p='+', m='-')} AS strand FROM aligns WHERE flag & 4 = 0) x GROUP BY strand", "aligns")
def _(spark, d):
    return A.split_strands(aligns(spark, d), "FR").groupBy("strand").agg(F.count(F.lit(1)).alias("n"))


@query("o01_coordinate_sort", "SELECT qname, rname, pos, row_number() OVER (PARTITION BY rname ORDER BY pos, qname, num)::INTEGER AS place FROM aligns", "aligns")
def _(spark, d):
    from pyspark.sql import Window

    return aligns(spark, d).select("qname", "rname", "pos", F.row_number().over(Window.partitionBy("rname").orderBy("pos", "qname", "num")).alias("place"))


SIDES = "l AS (SELECT qname AS core, rname, max(mapq) AS mq, count(*) AS n FROM aligns WHERE flag & 64 != 0 GROUP BY qname, rname), r AS (SELECT qname AS core, rname, max(mapq) AS mq, count(*) AS n FROM aligns WHERE flag & 128 != 0 GROUP BY qname, rname)"


@query("j08_mate_merge", f"WITH {SIDES} SELECT core, rname, coalesce(l.n, 0) AS n_left, coalesce(r.n, 0) AS n_right, greatest(l.mq, r.mq) AS mapq, CASE WHEN l.n IS NULL OR r.n IS NULL THEN 1 ELSE 0 END AS mate_unmapped FROM l FULL JOIN r USING (core, rname)", "aligns")
def _(spark, d):
    rows = aligns(spark, d).withColumnRenamed("qname", "core")
    return A.mate_join(rows.where(A.has(F.col("flag"), "first")), rows.where(A.has(F.col("flag"), "second")))


@query("j09_mate_pairing", """WITH s AS (SELECT qname AS core, rname, CASE WHEN flag & 16 != 0 THEN '-' ELSE '+' END AS strand, pos, mapq AS score, flag, num FROM aligns), m AS (SELECT a.core, a.rname, a.pos AS pos_l, b.pos AS pos_r, a.score + b.score AS score FROM s a JOIN s b USING (core, rname)
 WHERE a.flag & 64 != 0 AND b.flag & 128 != 0 AND a.strand != b.strand AND abs(a.pos - b.pos) <= 2000 AND ((a.strand = '+' AND a.pos <= b.pos) OR (a.strand = '-' AND a.pos >= b.pos)))
 SELECT core, rname, pos_l, pos_r, score FROM (SELECT *, row_number() OVER (PARTITION BY core, rname ORDER BY score DESC, pos_l, pos_r) AS k FROM m) x WHERE k <= 1""", "aligns")
def _(spark, d):
    rows = aligns(spark, d).select(F.col("qname").alias("core"), "rname", F.when(A.has(F.col("flag"), "reverse"), "-").otherwise("+").alias("strand"), "pos", F.col("mapq").alias("score"), "flag")
    return A.mate_pairs(rows.where(A.has(F.col("flag"), "first")), rows.where(A.has(F.col("flag"), "second")))


ENDS = "SELECT rname AS scaff, qname AS read, pos AS lend, pos + 35 AS rend FROM aligns"


@query("j11_fragment_pairs", f"""WITH e AS ({ENDS}), g AS (SELECT *, count(*) OVER w AS n, min(lend) OVER w AS l, max(rend) OVER w AS r, row_number() OVER (PARTITION BY scaff, read ORDER BY lend, rend) AS k FROM e WINDOW w AS (PARTITION BY scaff, read)), j AS (SELECT *, n = 2 AND r - l + 1 BETWEEN 100 AND 500 AS ok FROM g)
 SELECT scaff, read AS frag, CASE WHEN ok THEN l ELSE lend END AS lend, CASE WHEN ok THEN r ELSE rend END AS rend FROM j WHERE NOT ok OR k = 1""", "aligns")
def _(spark, d):
    ends = aligns(spark, d).select(F.col("rname").alias("scaff"), F.col("qname").alias("read"), F.col("pos").alias("lend"), (F.col("pos") + 35).alias("rend"))
    return A.fragment_pairs(ends)


@query("j12_pair_links", """WITH one AS (SELECT qname, CASE WHEN flag & 64 != 0 THEN 1 ELSE 2 END AS mate, count(DISTINCT rname) AS n, min(rname) AS contig FROM aligns GROUP BY 1, 2 HAVING count(DISTINCT rname) = 1)
 SELECT least(x.contig, y.contig) AS a, greatest(x.contig, y.contig) AS b, count(*) AS links FROM one x JOIN one y USING (qname) WHERE x.mate = 1 AND y.mate = 2 AND x.contig != y.contig GROUP BY 1, 2""", "aligns")
def _(spark, d):
    rows = aligns(spark, d).select(F.col("qname").alias("core"), F.when(A.has(F.col("flag"), "first"), 1).otherwise(2).alias("mate"), F.col("rname").alias("contig"))
    return A.pair_links(rows)


@query("a14_category_counts", """WITH p AS (SELECT qname, rname, max(CASE WHEN flag & 64 != 0 THEN 1 ELSE 0 END) AS l, max(CASE WHEN flag & 128 != 0 THEN 1 ELSE 0 END) AS r, max(CASE WHEN flag & 2 != 0 THEN 1 ELSE 0 END) AS p FROM aligns GROUP BY 1, 2),
 c AS (SELECT CASE WHEN l = 1 AND r = 1 AND p = 1 THEN 'proper_pairs' WHEN l = 1 AND r = 1 THEN 'improper_pairs' WHEN l = 1 THEN 'left_only' ELSE 'right_only' END AS category, sum(CASE WHEN l = 1 AND r = 1 THEN 2 ELSE 1 END)::BIGINT AS n FROM p GROUP BY 1)
 SELECT category, n, round(n / sum(n) OVER () * 100, 2) AS pct FROM c""", "aligns")
def _(spark, d):
    return A.category_counts(aligns(spark, d).select(F.col("qname").alias("core"), F.col("rname").alias("contig"), "flag"))


@query("w02_cap_by_position", f"SELECT {ROW}, num FROM (SELECT *, row_number() OVER (PARTITION BY rname, pos ORDER BY ord, num) AS k FROM aligns) x WHERE k <= 2", "aligns")
def _(spark, d):
    return A.cap_by_position(aligns(spark, d), 2).select("qname", "flag", "rname", "pos", "num")


@query("w03_top_hits", f"SELECT {ROW}, mapq FROM (SELECT *, rank() OVER (PARTITION BY qname ORDER BY mapq DESC) AS k FROM aligns) x WHERE k <= 2", "aligns")
def _(spark, d):
    return A.top_hits(aligns(spark, d), "qname", "mapq", 2).select("qname", "flag", "rname", "pos", "mapq")


@query("a29_best_hit", "SELECT qname, num, mapq FROM (SELECT *, row_number() OVER (PARTITION BY qname ORDER BY mapq DESC, num) AS k FROM aligns) x WHERE k = 1", "aligns")
def _(spark, d):
    return A.best_hit(aligns(spark, d), "qname", "mapq", "num").select("qname", "num", "mapq")


@query("j18_route", "SELECT r.qname, r.num, g.grp FROM aligns r JOIN (SELECT DISTINCT rname, 'part' || (ascii(substr(rname, 2)) % 3) AS grp FROM aligns) g USING (rname)", "aligns")
def _(spark, d):
    rows = aligns(spark, d)
    groups = rows.select("rname").distinct().withColumn("grp", F.concat(F.lit("part"), (F.ascii(F.expr("substring(rname, 2)")) % 3).cast("string")))
    return A.route(rows, groups).select("qname", "num", "grp")


@query("n15_core_name", "SELECT DISTINCT regexp_replace(qname || '/' || (1 + num % 2), '[/:][12]$', '') AS core FROM aligns", "aligns")
def _(spark, d):
    return aligns(spark, d).select(S.core_name(F.concat("qname", F.lit("/"), (1 + F.col("num") % 2).cast("string"))).alias("core")).distinct()


@query("n24_insert_size", "SELECT abs(mpos - pos) + 36 AS size, count(*) AS n FROM aligns GROUP BY 1", "aligns")
def _(spark, d):
    return aligns(spark, d).groupBy(A.insert_size(F.col("pos"), F.col("mpos"), F.lit(36)).alias("size")).agg(F.count(F.lit(1)).alias("n"))


BLOCKS = """b AS (SELECT qname, num, rname, unnest(CASE cigar WHEN '36M' THEN [[pos, pos + 35]] WHEN '10M100N26M' THEN [[pos, pos + 9], [pos + 110, pos + 135]] WHEN '5S31M' THEN [[pos, pos + 30]] WHEN '20M2I14M' THEN [[pos, pos + 19], [pos + 20, pos + 33]] ELSE [[pos, pos + 11], [pos + 15, pos + 38]] END) AS x FROM aligns)"""


def blocks(spark, d):
    return aligns(spark, d).select("qname", "num", "rname", F.explode(S.cigar_blocks(F.col("pos"), F.col("cigar"))).alias("b")).select("qname", "num", "rname", "b.lend", "b.rend")


@query("n12_cigar_blocks", f"WITH {BLOCKS} SELECT qname, num, x[1]::INTEGER AS lend, x[2]::INTEGER AS rend FROM b", "aligns")
def _(spark, d):
    return blocks(spark, d).select("qname", "num", "lend", "rend")


@query("n14_genome_span", "SELECT qname, num, pos::INTEGER AS lend, (CASE cigar WHEN '36M' THEN pos + 35 WHEN '10M100N26M' THEN pos + 135 WHEN '5S31M' THEN pos + 30 WHEN '20M2I14M' THEN pos + 33 ELSE pos + 38 END)::INTEGER AS rend FROM aligns", "aligns")
def _(spark, d):
    lend, rend = S.genome_span(S.cigar_blocks(F.col("pos"), F.col("cigar")))
    return aligns(spark, d).select("qname", "num", lend.alias("lend"), rend.alias("rend"))


@query("n17_merge_short_gaps", """SELECT qname, num, CASE cigar WHEN '10M100N26M' THEN 2 ELSE 1 END AS blocks, (CASE cigar WHEN '36M' THEN pos + 35 WHEN '10M100N26M' THEN pos + 135 WHEN '5S31M' THEN pos + 30 WHEN '20M2I14M' THEN pos + 33 ELSE pos + 38 END)::INTEGER AS last FROM aligns""", "aligns")
def _(spark, d):
    merged = S.merge_short_gaps(S.cigar_blocks(F.col("pos"), F.col("cigar")))
    return aligns(spark, d).select("qname", "num", F.size(merged).alias("blocks"), F.element_at(merged, -1)["rend"].alias("last"))


@query("n16_interval_functions", "SELECT scaff, frag, lend <= 9000 AND rend >= 8000 AS over, lend >= 8000 AND rend <= 9000 AS inside, greatest(0, least(rend, 9000) - greatest(lend, 8000) + 1) AS len FROM frags", "frags")
def _(spark, d):
    l, r, a, b = F.col("lend"), F.col("rend"), F.lit(8000), F.lit(9000)
    return frags(spark, d).select("scaff", "frag", S.overlaps(l, r, a, b).alias("over"), S.contains(a, b, l, r).alias("inside"), S.overlap_length(l, r, a, b).cast("long").alias("len"))


@query("j13_overlap_join", "SELECT frag, feature, greatest(f.lend, g.lend) AS l, least(f.rend, g.rend) AS r FROM frags f JOIN features g ON f.scaff = g.scaff AND f.lend <= g.rend AND f.rend >= g.lend", "dense_frags", "dense_features")
def overlap_pairs(spark, d):
    met = I.overlap_join(*dense(spark, d))
    return met.select("frag", "feature", F.greatest("lend", "b_lend").alias("l"), F.least("rend", "b_rend").alias("r"))


@query("j14_point_join", "SELECT frag, feature FROM frags f JOIN features g ON f.scaff = g.scaff AND f.lend BETWEEN g.lend AND g.rend", "dense_frags", "dense_features")
def _(spark, d):
    found, parts = dense(spark, d)
    return I.point_join(found.select("scaff", "frag", F.col("lend").alias("pos")), parts).select("frag", "feature")


@query("j15_split_at_points", """WITH pts AS (SELECT DISTINCT scaff, lend + 30 AS pos FROM frags), e AS (SELECT g.scaff, feature, g.lend, g.rend, pos AS cut FROM features g JOIN pts p ON p.scaff = g.scaff AND pos BETWEEN g.lend AND g.rend - 1 UNION ALL SELECT scaff, feature, lend, rend, rend FROM features),
 x AS (SELECT scaff, feature, coalesce(lag(cut) OVER (PARTITION BY scaff, feature ORDER BY cut) + 1, lend) AS l, cut AS r, cut = rend AS last FROM e) SELECT scaff, feature AS part, l AS lend, r AS rend FROM x WHERE r - l + 1 >= 50 OR last""", "dense_frags", "dense_features")
def _(spark, d):
    found, parts = dense(spark, d)
    return I.split_at_points(parts.withColumnRenamed("feature", "part"), found.select("scaff", (F.col("lend") + 30).alias("pos")))


@query("a11_depth", "SELECT scaff, pos, count(*) AS cov FROM (SELECT scaff, unnest(range(lend, rend + 1)) AS pos FROM frags) x GROUP BY scaff, pos", "frags")
def depth(spark, d):
    return C.depth(frags(spark, d))


@query("a12_depth_runs", """WITH e AS (SELECT scaff, lend AS edge, 1 AS d FROM frags UNION ALL SELECT scaff, rend + 1, -1 FROM frags), s AS (SELECT scaff, edge, sum(d)::BIGINT AS d FROM e GROUP BY 1, 2 HAVING sum(d) != 0)
 SELECT * FROM (SELECT scaff, edge AS lend, lead(edge) OVER (PARTITION BY scaff ORDER BY edge) - 1 AS rend, sum(d) OVER (PARTITION BY scaff ORDER BY edge)::BIGINT AS cov FROM s) x WHERE cov > 0""", "frags")
def _(spark, d):
    return C.depth_runs(frags(spark, d))


@query("a13_read_spans", """SELECT scaff, lend, rend FROM (SELECT rname AS scaff, pos AS lend, CASE WHEN flag & 1 != 0 AND flag & 2 != 0 AND mpos > pos AND mpos - pos <= 500 THEN greatest(pos + 35, mpos - 1) ELSE pos + 35 END AS rend FROM aligns) x WHERE rend - lend + 1 < 500""", "aligns")
def _(spark, d):
    return C.read_spans(aligns(spark, d).select(F.col("rname").alias("scaff"), "flag", "pos", "mpos", (F.col("pos") + 35).alias("rend")))


DEPTH_SQL = "(SELECT scaff, pos, count(*) AS cov FROM (SELECT scaff, unnest(range(lend, rend + 1)) AS pos FROM {src}) x GROUP BY scaff, pos)"


@query("w04_islands", f"WITH p AS (SELECT scaff, pos FROM {DEPTH_SQL.format(src='frags')} c WHERE cov >= 5) SELECT scaff, min(pos) AS lend, max(pos) AS rend FROM (SELECT *, pos - row_number() OVER (PARTITION BY scaff ORDER BY pos) AS g FROM p) x GROUP BY scaff, g", "frags")
def _(spark, d):
    return I.islands(depth(spark, d).where("cov >= 5"))


PILE = "SELECT scaff, min(lend) AS lend, max(rend) AS rend, count(*) AS members FROM (SELECT *, sum(new) OVER (PARTITION BY scaff ORDER BY lend, rend ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN b IS NULL OR lend - b - 1 > {gap} THEN 1 ELSE 0 END AS new FROM (SELECT *, max(rend) OVER (PARTITION BY scaff ORDER BY lend, rend ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM {src}) u) v) w GROUP BY scaff, g"
SPARSE = "(SELECT scaff, lend, rend FROM features WHERE rend - lend < 250)"


def sparse(spark, d):
    return features(spark, d).where("rend - lend < 250").select("scaff", "lend", "rend")


@query("w05_merge_near", PILE.format(gap=100, src=SPARSE), "features")
def _(spark, d):
    return I.merge_near(sparse(spark, d), 100)


@query("w06_pile_up", PILE.format(gap=-1, src="features"), "features")
def _(spark, d):
    return I.pile_up(features(spark, d))


@query("w07_gaps", f"SELECT scaff, b + 1 AS lend, lend - 1 AS rend FROM (SELECT *, lag(rend) OVER (PARTITION BY scaff ORDER BY lend) AS b FROM ({PILE.format(gap=-1, src=SPARSE)}) p) x WHERE lend - b - 1 >= 10", "features")
def _(spark, d):
    return I.gaps_between(sparse(spark, d), 10)


JACCARD = f"""c AS {DEPTH_SQL.format(src='frags')}, wide AS (SELECT scaff, lend, rend - 100 AS rend FROM frags WHERE rend - lend >= 100), w AS {DEPTH_SQL.format(src='wide')},
 l AS (SELECT scaff, pos, cov AS l FROM c), r AS (SELECT scaff, pos - 100 AS pos, cov AS r FROM c), j AS (SELECT scaff, pos, coalesce(l, 0) AS l, coalesce(r, 0) AS r FROM l FULL JOIN r USING (scaff, pos)),
 track AS (SELECT scaff, CAST(floor((pos + pos + 100) / 2) AS BIGINT) AS pos, round((coalesce(cov, 0) + 1) / (l + r - 2 * coalesce(cov, 0) + coalesce(cov, 0) + 1), 4) AS jaccard FROM j LEFT JOIN w USING (scaff, pos) WHERE pos >= 1)"""


@query("w08_sliding_jaccard", f"WITH {JACCARD} SELECT scaff, pos, jaccard FROM track", "frags")
def jaccard_track(spark, d):
    return C.sliding_jaccard(frags(spark, d))


@query("w09_troughs", f"""WITH {JACCARD}, t AS (SELECT a.scaff, a.pos, a.jaccard, b.jaccard AS x, c2.jaccard AS y FROM track a JOIN track b ON b.scaff = a.scaff AND b.pos = a.pos - 100 JOIN track c2 ON c2.scaff = a.scaff AND c2.pos = a.pos + 100 WHERE a.jaccard <= 0.2 AND b.jaccard >= a.jaccard + 0.01 AND c2.jaccard >= a.jaccard + 0.01),
 g AS (SELECT *, (x + y) / 2 - jaccard AS av, sum(new) OVER (PARTITION BY scaff ORDER BY pos) AS g FROM (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY scaff ORDER BY pos) <= 200 THEN 0 ELSE 1 END AS new FROM t) u)
 SELECT scaff, pos, jaccard, round(av, 6) AS avg_delta FROM (SELECT *, row_number() OVER (PARTITION BY scaff, g ORDER BY jaccard, av DESC, pos) AS k FROM g) v WHERE k = 1""", "frags")
def _(spark, d):
    return C.troughs(jaccard_track(spark, d), most=0.2, hill=0.01)


@query("w10_clip_contigs", """WITH e AS (SELECT tid, length(seq) AS pos FROM transcripts UNION SELECT tid, 30 + tid % 40 FROM transcripts UNION SELECT tid, 60 FROM transcripts WHERE tid % 3 = 0), x AS (SELECT tid, coalesce(lag(pos) OVER (PARTITION BY tid ORDER BY pos), 0) + 1 AS lend, pos AS rend FROM e)
 SELECT tid AS acc, lend::INTEGER AS lend, rend::INTEGER AS rend, substr(seq, lend, rend - lend + 1) AS seq FROM x JOIN transcripts USING (tid)""", "transcripts")
def _(spark, d):
    contigs = view(spark, d, "transcripts").select(F.col("tid").alias("acc"), "seq")
    points = contigs.select("acc", (30 + F.col("acc") % 40).alias("pos")).unionByName(contigs.where("acc % 3 = 0").select("acc", F.lit(60).cast("long").alias("pos")))
    return C.clip(contigs, points)


@query("w16_join_tracks", f"WITH a AS {DEPTH_SQL.format(src='frags')}, b AS {DEPTH_SQL.format(src='features')} SELECT scaff, pos, coalesce(a.cov, 0) AS frag_cov, coalesce(b.cov, 0) AS feature_cov FROM a FULL JOIN b USING (scaff, pos)", "frags", "features")
def _(spark, d):
    return C.join_tracks({"frag_cov": depth(spark, d), "feature_cov": C.depth(features(spark, d))})


EXONS = "(SELECT scaff, feature % 300 AS transcript, CASE WHEN feature % 2 = 0 THEN '+' ELSE '-' END AS strand, lend, rend FROM features)"


def exons_of(parts):
    return parts.select("scaff", (F.col("feature") % 300).alias("transcript"), F.when(F.col("feature") % 2 == 0, "+").otherwise("-").alias("strand"), "lend", "rend")


OFFSETS = f"o AS (SELECT *, sum(rend - lend + 1) OVER (PARTITION BY transcript ORDER BY lend)::BIGINT - (rend - lend + 1) AS off, sum(rend - lend + 1) OVER (PARTITION BY transcript)::BIGINT AS total FROM {EXONS} e)"


@query("w13_running_offset", f"WITH {OFFSETS} SELECT transcript, lend, rend, off AS \"offset\" FROM o", "features")
def _(spark, d):
    from strandloom.operators import coding

    return coding.running_offsets(exons_of(features(spark, d)))


@query("j21_to_transcript", f"""WITH {OFFSETS}, m AS (SELECT frag, transcript, strand, total, greatest(f.lend, o.lend) - o.lend + off + 1 AS l, least(f.rend, o.rend) - o.lend + off + 1 AS r FROM frags f JOIN o ON f.scaff = o.scaff AND f.lend <= o.rend AND f.rend >= o.lend)
 SELECT frag, transcript, CASE WHEN strand = '-' THEN total - r + 1 ELSE l END AS t_lend, CASE WHEN strand = '-' THEN total - l + 1 ELSE r END AS t_rend FROM m""", "dense_frags", "dense_features")
def _(spark, d):
    found, parts = dense(spark, d)
    return I.to_transcript(found, exons_of(parts))
