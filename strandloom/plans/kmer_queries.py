"""Queries over k-mer operators: name -> (DataFrame plan, SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.functions import seq as S
from strandloom.operators import kmers as K
from strandloom.operators import packed
from strandloom.operators import setmath as M
from strandloom.plans.views import rc, view, with_views

QUERIES: dict = {}
SQL: dict[str, str] = {}
K_READS = 25  # the usual k of assemblies
RATIO, ENTROPY = 0.05, 1.5


def query(name: str, sql: str | None = None, *views: str):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = with_views(sql, *views) if views else sql
        return f

    return keep


def kmer_sql(k: int, source: str = "reads", key: str = "read_id", extra: str = "") -> str:
    return f"(SELECT {key}, {extra} i AS pos, substr(seq, i + 1, {k}) AS kmer FROM (SELECT *, unnest(range(0, length(seq) - {k} + 1)) AS i FROM {source}) w)"


def canon(x: str) -> str:
    return f"least({x}, {rc(x)})"


KM = kmer_sql(K_READS)
COUNTS = f"(SELECT kmer, count(*) AS cnt FROM {KM} x GROUP BY kmer)"
SMALL_K = 11
SMALL = f"(SELECT kmer, count(*) AS cnt FROM {kmer_sql(SMALL_K)} x GROUP BY kmer)"
ENT = " + ".join(f"CASE WHEN length(kmer) > length(replace(kmer, '{b}', '')) THEN -((length(kmer) - length(replace(kmer, '{b}', ''))) / length(kmer)) * log2((length(kmer) - length(replace(kmer, '{b}', ''))) / length(kmer)) ELSE 0 END" for b in "GATC")


def reads(spark, d):
    return view(spark, d, "reads")


def read_kmers(spark, d, k=K_READS, keep=(), position=False):
    return K.explode_kmers(reads(spark, d), k, keep=keep, position=position)


def read_counts(spark, d, k=K_READS):
    return K.count_in(reads(spark, d), k)


def packed_counts(spark, d, k):
    return K.count_in(reads(spark, d), k, decode=False)


@query("k01_kmer_explode", f"SELECT read_id, kmer FROM {KM} x", "reads")
def _(spark, d):
    return read_kmers(spark, d, keep=("read_id",))


@query("k02_kmer_count", f"SELECT kmer, cnt FROM {COUNTS} c", "reads")
def _(spark, d):
    return read_counts(spark, d)


@query("k02_text_kmer_count", f"SELECT kmer, count(*) AS cnt FROM {kmer_sql(8, 'text_reads', 'doc_id')} x WHERE regexp_matches(kmer, '^[ACGTacgt]+$') GROUP BY kmer", "text_reads")
def _(spark, d):
    return K.count_in(view(spark, d, "text_reads"), 8, plain_only=True)


@query("k03_canonical_kmer_count", f"SELECT {canon('kmer')} AS kmer, count(*) AS cnt FROM {KM} x GROUP BY {canon('kmer')}", "reads")
def canonical_counts(spark, d):
    return K.count_in(reads(spark, d), K_READS, canonical=True)


@query("k03_both_strands", f"SELECT kmer, count(*) AS cnt FROM (SELECT kmer FROM {kmer_sql(SMALL_K)} x UNION ALL SELECT {rc('kmer')} FROM {kmer_sql(SMALL_K)} y) z GROUP BY kmer", "reads")
def _(spark, d):
    return K.both_strands(read_counts(spark, d, SMALL_K))


@query("k04_weighted_count", f"SELECT kmer, sum(CAST(floor(q * 25 / 25 + 0.5) AS BIGINT))::BIGINT AS cnt FROM {kmer_sql(K_READS, extra='q,')} x GROUP BY kmer", "reads")
def _(spark, d):
    return K.count_in(reads(spark, d).withColumn("w", K.reassembly_weight(F.col("q"), K_READS)), K_READS, weight="w")


QUAL = "SELECT read_id, seq, translate(md5(CAST(read_id AS STRING)) || 'abcd', '0123456789abcdef', '#&0:?DIIIIIIIIII') AS qual FROM reads"


def with_quality(spark, d):
    reads(spark, d).createOrReplaceTempView("reads")
    return spark.sql(QUAL)


@query("k05_quality_masked_count", f"""WITH qr AS ({QUAL}), m AS (SELECT read_id, list_aggregate(list_transform(range(1, length(seq) + 1), lambda i: CASE WHEN ascii(substr(qual, i, 1)) - 33 < 10 THEN 'N' ELSE substr(seq, i, 1) END), 'string_agg', '') AS seq FROM qr)
 SELECT kmer, count(*) AS cnt FROM {kmer_sql(SMALL_K, 'm')} x WHERE NOT contains(kmer, 'N') GROUP BY kmer""", "reads")
def _(spark, d):
    masked = with_quality(spark, d).withColumn("seq", K.mask_low_quality(F.col("seq"), F.col("qual"), 10))
    return K.count_in(masked, SMALL_K, plain_only=True)


@query("k06_quality_weighted_count", f"""WITH qr AS ({QUAL}), p AS (SELECT seq, list_transform(range(1, length(qual) + 1), lambda i: 1 - pow(10.0, -(ascii(substr(qual, i, 1)) - 33) / 10)) AS ps FROM qr)
 SELECT kmer, round(sum(w), 6) AS cnt FROM (SELECT substr(seq, i + 1, {SMALL_K}) AS kmer, list_reduce(ps[i + 1 : i + {SMALL_K}], lambda a, b: a * b) AS w FROM (SELECT seq, ps, unnest(range(0, length(seq) - {SMALL_K} + 1)) AS i FROM p) u) v GROUP BY kmer""", "reads")
def _(spark, d):
    out = K.quality_weighted(with_quality(spark, d), SMALL_K)
    return out.select("kmer", F.round("cnt", 6).alias("cnt"))


@query("k07_count_histogram", f"SELECT cnt, count(*) AS n FROM {COUNTS} c GROUP BY cnt", "reads")
def _(spark, d):
    return K.histogram(read_counts(spark, d))


@query("k08_kmer_histogram", f"""SELECT CAST(1 + CASE WHEN cnt < 1 THEN 0 WHEN cnt > 105 THEN (105 + 5 - 1) // 5 - 1 ELSE (cnt - 1) // 5 END * 5 AS BIGINT) AS bucket, count(*) AS n
 FROM (SELECT count(*) AS cnt FROM {KM} x GROUP BY {canon('kmer')} HAVING count(*) >= 2) c GROUP BY 1""", "reads")
def flagship(spark, d):
    return K.bucketed_histogram(K.at_least(canonical_counts(spark, d), 2), low=1, high=100, step=5)


@query("k08_cumulative_histogram", f"""WITH h AS (SELECT cnt, count(*) AS n FROM {COUNTS} c GROUP BY cnt)
 SELECT cnt, n, round(sum(n) OVER (ORDER BY cnt) / sum(n) OVER (), 8) AS distinct_part, round(sum(cnt * n) OVER (ORDER BY cnt) / sum(cnt * n) OVER (), 8) AS total_part FROM h""", "reads")
def _(spark, d):
    return K.cumulative_histogram(read_counts(spark, d), 8)


@query("k09_stats", f"SELECT sum(CASE WHEN cnt = 1 THEN 1 ELSE 0 END)::BIGINT AS uniq, count(*) AS n_distinct, sum(cnt)::BIGINT AS total, max(cnt) AS most FROM {COUNTS} c", "reads")
def _(spark, d):
    return K.stats(read_counts(spark, d))


WANTED = f"(SELECT DISTINCT substr(seq, 1, {K_READS}) AS kmer FROM transcripts)"


def wanted(spark, d):
    return view(spark, d, "transcripts").select(F.substring("seq", 1, K_READS).alias("kmer")).distinct()


@query("k10_point_query", f"SELECT w.kmer, coalesce(cnt, 0) AS cnt FROM {WANTED} w LEFT JOIN {COUNTS} c USING (kmer)", "reads", "transcripts")
def _(spark, d):
    return K.query(read_counts(spark, d), wanted(spark, d))


@query("k10_point_query_both_strands", f"""WITH c AS (SELECT {canon('kmer')} AS k, count(*) AS cnt FROM {KM} x GROUP BY 1)
 SELECT w.kmer, coalesce(cnt, 0) AS cnt FROM {WANTED} w LEFT JOIN c ON {canon('w.kmer')} = c.k""", "reads", "transcripts")
def _(spark, d):
    return K.query(canonical_counts(spark, d), wanted(spark, d), canonical=True)


@query("k11_merge_databases", f"SELECT kmer, count(*) AS cnt FROM {kmer_sql(SMALL_K)} x GROUP BY kmer", "reads")
def _(spark, d):
    return K.merge([letters(read_counts_of(spark, d, db)) for db in DBS])


DBS = ("A", "N", "R")
DB_SQL = f"(SELECT db, kmer, count(*) AS cnt FROM {kmer_sql(SMALL_K, extra='db,')} x GROUP BY db, kmer)"


def read_counts_of(spark, d, db):
    return K.count_in(reads(spark, d).where(F.col("db") == db), SMALL_K, decode=False)


def letters(df):
    """A packed result's k-mers."""
    return packed.decoded(df, SMALL_K)


def dbs(spark, d):
    return K.count_in(reads(spark, d), SMALL_K, by=("db",), decode=False)


def _set_query(name, plan, value, having=""):
    query(name, f"SELECT kmer, {value} AS cnt FROM {DB_SQL} x GROUP BY kmer {having}", "reads")(lambda s, d: letters(plan(s, d)))


_set_query("k12_set_min", lambda s, d: M.minimum(dbs(s, d), 3), "min(cnt)", "HAVING count(*) = 3")
_set_query("k13_set_minexist", lambda s, d: M.minimum_any(dbs(s, d)), "min(cnt)")
_set_query("k14_set_max", lambda s, d: M.maximum(dbs(s, d), 3), "max(cnt)", "HAVING count(*) = 3")
_set_query("k15_set_maxexist", lambda s, d: M.maximum_any(dbs(s, d)), "max(cnt)")
_set_query("k16_set_add", lambda s, d: M.add(dbs(s, d)), "sum(cnt)::BIGINT")
_set_query("k17_set_and", lambda s, d: M.presence(dbs(s, d), "and", 3), "1::BIGINT", "HAVING count(*) = 3")
_set_query("k17_set_nand", lambda s, d: M.presence(dbs(s, d), "nand", 3), "1::BIGINT", "HAVING count(*) < 3")
_set_query("k17_set_or", lambda s, d: M.presence(dbs(s, d), "or", 3), "1::BIGINT")
_set_query("k17_set_xor", lambda s, d: M.presence(dbs(s, d), "xor", 3), "1::BIGINT", "HAVING count(*) % 2 = 1")
A_B = f"WITH x AS {DB_SQL}, a AS (SELECT kmer, cnt FROM x WHERE db = 'A'), b AS (SELECT kmer, cnt AS b FROM x WHERE db = 'N')"


@query("k18_set_sub", f"{A_B} SELECT kmer, greatest(cnt - coalesce(b, 0), 0) AS cnt FROM a LEFT JOIN b USING (kmer) WHERE cnt > coalesce(b, 0)", "reads")
def _(spark, d):
    return letters(M.subtract(read_counts_of(spark, d, "A"), read_counts_of(spark, d, "N")))


@query("k19_set_abs", f"{A_B} SELECT kmer, abs(coalesce(cnt, 0) - coalesce(b, 0)) AS cnt FROM a FULL JOIN b USING (kmer) WHERE coalesce(cnt, 0) != coalesce(b, 0)", "reads")
def _(spark, d):
    return letters(M.absolute(read_counts_of(spark, d, "A"), read_counts_of(spark, d, "N")))


@query("k20_set_divide", f"{A_B} SELECT kmer, least(cnt * 1000 // b, 4294967295)::BIGINT AS cnt FROM a JOIN b USING (kmer)", "reads")
def _(spark, d):
    return letters(M.divide(read_counts_of(spark, d, "A"), read_counts_of(spark, d, "N")))


for _how, _op in (("lessthan", "<"), ("lessthanorequal", "<="), ("greaterthan", ">"), ("greaterthanorequal", ">="), ("equal", "=")):
    query(f"k21_{_how}", f"SELECT kmer, cnt FROM {SMALL} c WHERE cnt {_op} 6", "reads")(lambda s, d, how=_how: M.threshold(read_counts(s, d, SMALL_K), how, 6))


@query("k22_positions", f"SELECT kmer, tid, pos::INTEGER AS pos FROM (SELECT *, count(*) OVER (PARTITION BY kmer) AS n FROM {kmer_sql(K_READS, 'transcripts', 'tid')} x) y WHERE n > 1", "transcripts")
def _(spark, d):
    return K.positions(K.explode_kmers(view(spark, d, "transcripts"), K_READS, keep=("tid",), position=True), "tid")


@query("k22_gap_histogram", f"SELECT gap::INTEGER AS gap, count(*) AS n FROM (SELECT pos - lag(pos) OVER (PARTITION BY tid, kmer ORDER BY pos) AS gap FROM {kmer_sql(4, 'transcripts', 'tid')} x) y WHERE gap IS NOT NULL GROUP BY gap", "transcripts")
def _(spark, d):
    return K.gap_histogram(K.explode_kmers(view(spark, d, "transcripts"), 4, keep=("tid",), position=True), "tid")


@query("k23_within_one_mismatch", f"""WITH c AS {SMALL}, w AS (SELECT DISTINCT substr(seq, 1, {SMALL_K}) AS kmer FROM transcripts)
 SELECT w.kmer, c.kmer AS hit, c.cnt FROM w JOIN c ON hamming(w.kmer, c.kmer) <= 1""", "reads", "transcripts")
def _(spark, d):
    first = view(spark, d, "transcripts").select(F.substring("seq", 1, SMALL_K).alias("kmer")).distinct()
    return K.within_one_mismatch(read_counts(spark, d, SMALL_K), first, SMALL_K)


@query("k23_within_three_mismatches", f"""WITH c AS {SMALL}, w AS (SELECT DISTINCT substr(seq, 1, {SMALL_K}) AS kmer FROM transcripts)
 SELECT w.kmer, c.kmer AS hit, c.cnt, hamming(w.kmer, c.kmer)::INTEGER AS mismatches FROM w JOIN c ON hamming(w.kmer, c.kmer) <= 3""", "reads", "transcripts")
def _(spark, d):
    first = view(spark, d, "transcripts").select(F.substring("seq", 1, SMALL_K).alias("kmer"))
    return K.within_mismatches(read_counts(spark, d, SMALL_K), first, SMALL_K, 3)


FREQUENT = f"(SELECT kmer FROM {COUNTS} f WHERE cnt >= 20)"


@query("k24_covered", f"""WITH h AS (SELECT tid, pos FROM {kmer_sql(K_READS, 'transcripts', 'tid')} x WHERE kmer IN {FREQUENT}), c AS (SELECT tid, count(DISTINCT p) AS covered FROM (SELECT tid, unnest(range(pos, pos + {K_READS})) AS p FROM h) u GROUP BY tid)
 SELECT tid, length(seq)::INTEGER AS len, coalesce(covered, 0) AS covered, round(coalesce(covered, 0) / length(seq) * 100, 2) AS pct FROM transcripts LEFT JOIN c USING (tid)""", "reads", "transcripts")
def _(spark, d):
    return K.covered(view(spark, d, "transcripts"), K.at_least(read_counts(spark, d), 20), K_READS, "tid")


@query("k24_masked", f"""WITH h AS (SELECT tid, unnest(range(pos, pos + {K_READS})) AS p FROM {kmer_sql(K_READS, 'transcripts', 'tid')} x WHERE kmer IN {FREQUENT}), c AS (SELECT tid, list(DISTINCT p) AS ps FROM h GROUP BY tid)
 SELECT tid, list_aggregate(list_transform(range(0, length(seq)), lambda i: CASE WHEN list_contains(ps, i) THEN 'N' ELSE substr(seq, i + 1, 1) END), 'string_agg', '') AS seq FROM transcripts LEFT JOIN c USING (tid)""", "reads", "transcripts")
def _(spark, d):
    return K.masked(view(spark, d, "transcripts"), K.at_least(read_counts(spark, d), 20), K_READS, "tid")


@query("k25_homopolymer_compression", "SELECT tid, regexp_replace(replace(replace(replace(replace(seq, 'A', '<A>'), 'C', '<C>'), 'G', '<G>'), 'T', '<T>'), '(<A>)+|(<C>)+|(<G>)+|(<T>)+', '\\1\\2\\3\\4', 'g') AS tagged FROM transcripts", "transcripts")
def _(spark, d):
    return view(spark, d, "transcripts").select("tid", F.regexp_replace(S.compress_runs(F.col("seq")), "([ACGT])", "<$1>").alias("tagged"))


SUCC = "SELECT a.kmer, b.kmer AS next, b.cnt AS next_cnt, row_number() OVER (PARTITION BY a.kmer ORDER BY b.cnt DESC, b.kmer)::INTEGER AS rank FROM c a JOIN c b ON substr(a.kmer, 2) = substr(b.kmer, 1, length(b.kmer) - 1)"


@query("k26_successors", f"WITH c AS {SMALL} {SUCC}", "reads")
def _(spark, d):
    return K.successors(packed_counts(spark, d, SMALL_K), SMALL_K)


@query("k26_predecessors", f"WITH c AS {SMALL} SELECT a.kmer, b.kmer AS prev, b.cnt AS prev_cnt, row_number() OVER (PARTITION BY a.kmer ORDER BY b.cnt DESC, b.kmer)::INTEGER AS rank FROM c a JOIN c b ON substr(b.kmer, 2) = substr(a.kmer, 1, length(a.kmer) - 1)", "reads")
def _(spark, d):
    return K.predecessors(packed_counts(spark, d, SMALL_K), SMALL_K)


_AROUND = ", ".join([f"coalesce((SELECT cnt FROM c p WHERE p.kmer = '{b}' || substr(c.kmer, 1, length(c.kmer) - 1)), 0) AS prev_{b}" for b in "GATC"] + [f"coalesce((SELECT cnt FROM c n WHERE n.kmer = substr(c.kmer, 2) || '{b}'), 0) AS next_{b}" for b in "GATC"])


@query("k27_describe", f"WITH c AS {SMALL} SELECT kmer, cnt, {_AROUND} FROM c", "reads")
def _(spark, d):
    return K.describe(read_counts(spark, d, SMALL_K))


THREAD = f"SELECT tid, pos::INTEGER AS pos, kmer, coalesce(cnt, 0) AS cnt FROM {kmer_sql(K_READS, 'transcripts', 'tid')} x LEFT JOIN c USING (kmer)"


@query("k28_thread", f"WITH c AS {COUNTS} {THREAD}", "reads", "transcripts")
def _(spark, d):
    return K.thread(view(spark, d, "transcripts"), packed_counts(spark, d, K_READS), K_READS, "tid")


@query("k29_path_exists", f"""WITH c AS {COUNTS}, t AS ({THREAD}), l AS (SELECT *, lag(cnt) OVER (PARTITION BY tid ORDER BY pos) AS b, {ENT} AS e FROM t)
 SELECT tid, min(CASE WHEN cnt >= 2 AND e >= {ENTROPY} AND (b IS NULL OR (b > 0 AND cnt > 0 AND least(b, cnt) / greatest(b, cnt) >= 0.2)) THEN 1 ELSE 0 END)::INTEGER AS found FROM l GROUP BY tid""", "reads", "transcripts")
def _(spark, d):
    threaded = K.thread(view(spark, d, "transcripts"), read_counts(spark, d), K_READS, "tid")
    return K.path_exists(threaded, "tid", 2, ENTROPY, 0.2)


@query("k30_shared_pairs", f"WITH k AS (SELECT DISTINCT seq AS s, kmer FROM {kmer_sql(K_READS, '(SELECT DISTINCT seq FROM transcripts)', 'seq')} x) SELECT DISTINCT a.s AS a, b.s AS b FROM k a JOIN k b USING (kmer) WHERE a.s < b.s", "transcripts")
def _(spark, d):
    distinct = view(spark, d, "transcripts").select("seq", F.col("seq").alias("s")).distinct()
    return K.shared_pairs(K.explode_kmers(distinct, K_READS, keep=("s",)), "s")


@query("k31_print_kmers", f"SELECT tid, pos::INTEGER AS pos, kmer FROM {kmer_sql(K_READS, 'transcripts', 'tid')} x", "transcripts")
def _(spark, d):
    return K.explode_kmers(view(spark, d, "transcripts"), K_READS, keep=("tid",), position=True).select("tid", "pos", "kmer")


@query("f01_non_base_filter", f"SELECT doc_id, count(*) AS n FROM {kmer_sql(8, 'text_reads', 'doc_id')} x WHERE regexp_matches(kmer, '^[ACGTacgt]+$') GROUP BY doc_id", "text_reads")
def _(spark, d):
    return K.count_in(view(spark, d, "text_reads"), 8, by=("doc_id",), plain_only=True).groupBy("doc_id").agg(F.sum("cnt").alias("n"))


@query("f02_replace_other", "SELECT doc_id, md5(regexp_replace(seq, '[^ACGTacgt]', 'A', 'g')) AS h FROM text_reads", "text_reads")
def _(spark, d):
    return view(spark, d, "text_reads").select("doc_id", F.md5(S.replace_other(F.col("seq"))).alias("h"))


@query("f03_min_count", f"SELECT kmer, cnt FROM {COUNTS} c WHERE cnt >= 10 AND cnt <= 200", "reads")
def _(spark, d):
    return K.at_least(read_counts(spark, d), 10, 200)


@query("f04_min_entropy", f"SELECT kmer, cnt FROM {COUNTS} c WHERE {ENT} >= {ENTROPY}", "reads")
def _(spark, d):
    return K.entropy_at_least(read_counts(spark, d), ENTROPY)


@query("f05_error_pruning", f"SELECT kmer, cnt FROM (SELECT *, max(cnt) OVER (PARTITION BY substr(kmer, 1, length(kmer) - 1)) AS m FROM {SMALL} c) x WHERE cnt / m >= {RATIO}", "reads")
def _(spark, d):
    return letters(K.prune_errors(packed_counts(spark, d, SMALL_K), RATIO))


@query("f11_connectivity", f"WITH c AS {SMALL} SELECT kmer, next FROM (SELECT a.kmer, b.kmer AS next, a.cnt AS x, b.cnt AS y FROM c a JOIN c b ON substr(a.kmer, 2) = substr(b.kmer, 1, length(b.kmer) - 1)) p WHERE least(x, y) / greatest(x, y) >= 0.3", "reads")
def _(spark, d):
    counts = read_counts(spark, d, SMALL_K)
    pairs = K.successors(counts).join(counts, "kmer")
    return pairs.where(K.connected(F.col("cnt"), F.col("next_cnt"), 0.3)).select("kmer", "next")


@query("j03_sharing_reads", f"""WITH t AS (SELECT DISTINCT kmer FROM {kmer_sql(K_READS, 'targets', 'tid')} x)
 SELECT read_id, count(t.kmer) AS hits, count(*) AS n_kmers FROM {KM} r LEFT JOIN t ON r.kmer = t.kmer GROUP BY read_id HAVING count(t.kmer) > 0 AND count(t.kmer) / count(*) * 100 >= 50""", "reads", "targets")
def _(spark, d):
    targets = K.explode_kmers(view(spark, d, "targets"), K_READS)
    return K.sharing_reads(reads(spark, d), targets, K_READS, "read_id", 50)


@query("s21_dump", f"SELECT kmer || ' ' || cnt AS line FROM {COUNTS} c WHERE cnt >= 5", "reads")
def _(spark, d):
    return K.dump_lines(K.at_least(read_counts(spark, d), 5))


@query("s06_kmer_fasta_reader", f"SELECT seq AS kmer, l AS cnt FROM (SELECT substr(seq, 1, 20 + tid % 10) AS seq, tid AS l FROM transcripts) x WHERE length(seq) = {K_READS}", "transcripts")
def _(spark, d):
    lines = view(spark, d, "transcripts").select(F.expr("substring(seq, 1, CAST(20 + tid % 10 AS INT))").alias("seq"), F.col("tid").cast("string").alias("header"))
    return K.read_kmer_table(lines, K_READS)


@query("u03_word_method", f"SELECT kmer, cnt FROM {SMALL} c", "reads")
def _(spark, d):
    return K.count_in(reads(spark, d), SMALL_K, method="words")


@query("u05_either_strand", f"WITH c AS {SMALL}, w AS (SELECT DISTINCT substr(seq, 1, {SMALL_K}) AS kmer FROM transcripts) SELECT w.kmer, c.kmer AS hit, c.cnt FROM w JOIN c ON c.kmer = w.kmer UNION SELECT w.kmer, c.kmer, c.cnt FROM w JOIN c ON c.kmer = {rc('w.kmer')}", "reads", "transcripts")
def _(spark, d):
    first = view(spark, d, "transcripts").select(F.substring("seq", 1, SMALL_K).alias("kmer")).distinct()
    return K.matching(read_counts(spark, d, SMALL_K), first, SMALL_K, "either_strand")
