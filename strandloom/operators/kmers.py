"""K-mer operators: windows of sequences, counts, histograms, point queries, neighbours, paths."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions import seq as S
from strandloom.operators import packed
from strandloom.operators.lineage import cut


def explode_kmers(df: DataFrame, k: int, seq: str = "seq", keep: tuple[str, ...] = (), position: bool = False) -> DataFrame:
    """A row a window of k letters (K01, K31). Sequences shorter than k give none. position is 0-based. Spark takes windows to be as large as their sequences and would broadcast
    them by that, so joins are told to shuffle."""
    starts = F.sequence(F.lit(1), F.length(seq) - k + 1)
    rows = df.where(F.length(seq) >= k).select(*keep, F.col(seq).alias("_seq"), F.explode(starts).alias("_at")).hint("merge")
    out = [*keep, F.substring("_seq", F.col("_at"), F.lit(k)).alias("kmer")]
    return rows.select(*out, (F.col("_at") - 1).alias("pos")) if position else rows.select(*out)


def minimizer(kmer: Column | str, m: int = 10) -> Column:
    """The least hash of the words of m letters in a k-mer. Neighbours mostly have the same one, so rows that are dealt by it lie with their neighbours."""
    kmer = F.col(kmer) if isinstance(kmer, str) else kmer
    return F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.length(kmer) - m + 1, F.lit(1))), lambda i: F.xxhash64(F.substring(kmer, i, F.lit(m)))))


def valid_only(kmers: DataFrame) -> DataFrame:
    """Without k-mers that hold other letters than A, C, G, T."""
    return kmers.where(S.only_bases(F.col("kmer")))


def count(kmers: DataFrame, canonical: bool = False, weight: Column | None = None) -> DataFrame:
    """(kmer, cnt): occurrences (K02), of either strand together (K03), or summed weights (K04, K06). Partial sums come before the shuffle."""
    kmer = S.canonical(F.col("kmer")) if canonical else F.col("kmer")
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return kmers.groupBy(kmer.alias("kmer")).agg(total.alias("cnt"))


def count_in(df: DataFrame, k: int, canonical: bool = False, weight: str | None = None, by: tuple[str, ...] = (), seq: str = "seq", plain_only: bool = False, method: str = "auto", decode: bool = True) -> DataFrame:
    """(*by, kmer, cnt) of the k-mers of sequences: as ``count`` of their windows, packed in numbers where k allows it. weight is a whole-number column; plain_only leaves out k-mers with other letters than A, C, G, T.
    method (U03): packed, words, or auto for packed where it can; all give the same. Without decode (k up to packed.MOST), k-mers stay code and word, for operators that take
    them so; ``packed.decoded`` gives their letters at the end."""
    if method not in ("auto", "packed", "words"):
        raise ValueError(f"no method {method!r}")
    if method == "packed" or method == "auto" and k <= packed.MOST:
        return packed.count(df, k, seq, canonical, weight, by, plain_only=plain_only, decode=decode)
    if not decode:
        raise ValueError(f"k-mers of {k} letters can't be packed")
    rows = explode_kmers(df, k, seq, keep=(*by, *([weight] if weight else [])))
    rows = rows.where(F.col("kmer").rlike("^[ACGT]+$")) if plain_only else rows
    kmer = S.canonical(F.col("kmer")) if canonical else F.col("kmer")
    return rows.groupBy(*by, kmer.alias("kmer")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("cnt"))


def both_strands(counts: DataFrame) -> DataFrame:
    """Counts of k-mers and of their reverse complements together, each a row of its own."""
    return merge([counts, counts.select(S.revcomp(F.col("kmer")).alias("kmer"), "cnt")])


def reassembly_weight(coverage: Column, k: int) -> Column:
    """The weight of a contig's k-mers when contigs are assembled again."""
    return F.floor(coverage * k / 25 + 0.5).cast("long")


def mask_low_quality(seq: Column, qual: Column, least: int, start: int = 33) -> Column:
    """N wherever the quality is below ``least``."""
    pairs = F.zip_with(F.split(seq, ""), F.split(qual, ""), lambda b, q: F.when(F.ascii(q) - start < least, "N").otherwise(b))
    return F.array_join(pairs, "")


def correctness(qual: Column, start: int = 33) -> Column:
    """Probability that each base is right."""
    return F.transform(F.split(qual, ""), lambda q: 1 - F.pow(F.lit(10.0), -(F.ascii(q) - start) / 10))


def quality_weighted(df: DataFrame, k: int, seq: str = "seq", qual: str = "qual", start: int = 33) -> DataFrame:
    """(kmer, cnt): each occurrence counts as the product of its bases' probabilities."""
    rows = df.withColumn("_p", correctness(F.col(qual), start))
    windows = explode_kmers(rows, k, seq, keep=("_p",), position=True)
    weight = F.aggregate(F.slice("_p", F.col("pos") + 1, k), F.lit(1.0), lambda acc, p: acc * p)
    return valid_only(windows.select("kmer", weight.alias("w"))).groupBy("kmer").agg(F.sum("w").alias("cnt"))


def histogram(counts: DataFrame) -> DataFrame:
    """(cnt, n): how many k-mers have each count."""
    return counts.groupBy("cnt").agg(F.count(F.lit(1)).alias("n"))


def table_estimate(df: DataFrame, k: int, partition_bytes: int = 64 << 20, seq: str = "seq") -> DataFrame:
    """(n_mers, entry_bytes, table_bytes, partitions) of a table of all windows (K32): an upper bound of its size, and in how many partitions of so many bytes it fits. Packed k-mers take
    eight bytes, longer ones a byte a letter, and counts eight more."""
    entry = (8 if k <= packed.MOST else k) + 8
    rows = df.agg(F.coalesce(F.sum(F.greatest(F.length(seq) - k + 1, F.lit(0)).cast("long")), F.lit(0)).alias("n_mers"))
    size = F.col("n_mers") * entry
    return rows.select("n_mers", F.lit(entry).cast("long").alias("entry_bytes"), size.alias("table_bytes"), F.greatest(F.ceil(size / partition_bytes), F.lit(1)).alias("partitions"))


def bucketed_histogram(counts: DataFrame, low: int = 1, high: int = 10_000, step: int = 1) -> DataFrame:
    """(bucket, n) with everything below low in the first and above high in the last bucket."""
    least, most = max(1, low - step), high + step
    inside = F.least(F.greatest(F.col("cnt"), F.lit(least)), F.lit(most))  # what is outside counts with the nearest bound
    return counts.groupBy((inside - (inside - least) % step).cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def cumulative_histogram(counts: DataFrame, places: int = 4) -> DataFrame:
    """(cnt, n, distinct_part, total_part): running fractions of distinct and of all k-mers (K08). The window sees one row a count."""
    h = histogram(counts)
    upto, every = Window.orderBy("cnt"), Window.partitionBy(F.lit(0))
    mers = F.col("cnt") * F.col("n")
    return h.select("cnt", "n", F.round(F.sum("n").over(upto) / F.sum("n").over(every), places).alias("distinct_part"), F.round(F.sum(mers).over(upto) / F.sum(mers).over(every), places).alias("total_part"))


def stats(counts: DataFrame, low: int = 0, high: int | None = None) -> DataFrame:
    """(uniq, n_distinct, total, most) of k-mers with counts in the bounds."""
    rows = counts.where((F.col("cnt") >= low) & (F.lit(True) if high is None else F.col("cnt") <= high))
    return rows.agg(F.coalesce(F.sum((F.col("cnt") == 1).cast("long")), F.lit(0)).alias("uniq"), F.count(F.lit(1)).alias("n_distinct"), F.coalesce(F.sum("cnt"), F.lit(0)).alias("total"), F.coalesce(F.max("cnt"), F.lit(0)).alias("most"))


def at_least(counts: DataFrame, least: int, most: int | None = None) -> DataFrame:
    """Counts within bounds."""
    return counts.where((F.col("cnt") >= least) & (F.lit(True) if most is None else F.col("cnt") <= most))


def entropy_at_least(counts: DataFrame, least: float) -> DataFrame:
    """Without k-mers of low entropy."""
    return counts.where(S.entropy(F.col("kmer")) >= least)


def prune_errors(counts: DataFrame, ratio: float = 0.05) -> DataFrame:
    """Without k-mers that are rare beside the most frequent one with the same first k-1 letters (F05). Every k-mer
    is compared with the dominant one as counted, so the result has no order to depend on. counts may be packed."""
    key = [F.expr("substring(kmer, 1, length(kmer) - 1)")] if "kmer" in counts.columns else packed.without_last(0)
    dominant = F.max("cnt").over(Window.partitionBy(*key))
    return counts.withColumn("_d", dominant).where(F.col("cnt") / F.col("_d") >= ratio).drop("_d")


def query(counts: DataFrame, wanted: DataFrame, canonical: bool = False) -> DataFrame:
    """(kmer, cnt) of each wanted k-mer, 0 where it is missing."""
    ask = wanted.select(F.col("kmer").alias("kmer"), (S.canonical(F.col("kmer")) if canonical else F.col("kmer")).alias("_k"))
    return ask.join(counts.select(F.col("kmer").alias("_k"), "cnt"), "_k", "left").select("kmer", F.coalesce("cnt", F.lit(0)).alias("cnt"))


def successors(counts: DataFrame, k: int = 0) -> DataFrame:
    """(kmer, next, next_cnt, rank): the counted k-mers that follow by one letter, most frequent first, ties by letters (K26). All k-mers that share their last k - 1 letters have the
    same ones, so those are ranked before the join, where they lie. counts may be packed, of k letters."""
    return _beside(counts, k, "next")


def predecessors(counts: DataFrame, k: int = 0) -> DataFrame:
    """(kmer, prev, prev_cnt, rank), as successors."""
    return _beside(counts, k, "prev")


def _beside(counts: DataFrame, k: int, name: str) -> DataFrame:
    plain, on = "kmer" in counts.columns, ["_j", "_w"]
    if plain:
        head, tail = ([F.expr(f"substring(kmer, {x}")] for x in ("1, length(kmer) - 1)", "2)"))
        own, other, letter = ["kmer"], [F.col("kmer").alias(name)], F.col("kmer")
        on = on[:1]
    else:
        head, tail = packed.without_last(k), packed.without_first(k)
        own, other = ["code", "word"], [F.col("code").alias("_code"), F.col("word").alias("_word")]
        letter = packed.last_letter() if name == "next" else packed.first_letter(k)
    mine, theirs = (tail, head) if name == "next" else (head, tail)
    key = lambda cols: [c.alias(x) for c, x in zip(cols, on, strict=True)]
    b = counts.where("cnt > 0").select(*key(theirs), *other, F.col("cnt").alias(f"{name}_cnt"), letter.alias("_l"))
    b = b.withColumn("rank", F.row_number().over(Window.partitionBy(*on).orderBy(F.desc(f"{name}_cnt"), "_l"))).drop("_l").hint("merge")  # k-mers outgrow what Spark expects of their sequences
    out = counts.select(*own, *key(mine)).join(b, on).drop(*on)
    return out if plain else packed.decoded(packed.decoded(out, k), k, "_code", "_word", name)


def describe(counts: DataFrame) -> DataFrame:
    """A row a k-mer: its count, and those of its four predecessors and successors by letter."""
    after = successors(counts).groupBy("kmer").agg(*[F.sum(F.when(F.expr("substring(next, -1, 1)") == b, F.col("next_cnt"))).alias(f"next_{b}") for b in S.PACKED])
    before = predecessors(counts).groupBy("kmer").agg(*[F.sum(F.when(F.expr("substring(prev, 1, 1)") == b, F.col("prev_cnt"))).alias(f"prev_{b}") for b in S.PACKED])
    rows = counts.select("kmer", "cnt").join(before, "kmer", "left").join(after, "kmer", "left")
    return rows.na.fill(0, [f"{side}_{b}" for side in ("prev", "next") for b in S.PACKED])


def thread(df: DataFrame, counts: DataFrame, k: int, key: str, seq: str = "seq") -> DataFrame:
    """(key, pos, kmer, cnt) along each sequence, 0 for k-mers that aren't counted (K28). counts may be packed."""
    if "kmer" in counts.columns:
        return explode_kmers(df, k, seq, keep=(key,), position=True).join(counts, "kmer", "left").select(key, "pos", "kmer", F.coalesce("cnt", F.lit(0)).alias("cnt"))
    rows = packed.windows(df, k, key, seq).join(counts, ["code", "word"], "left")
    return packed.decoded(rows.select(key, "pos", "code", "word", F.coalesce("cnt", F.lit(0)).alias("cnt")), k)


def connected(a: Column, b: Column, ratio: float) -> Column:
    """Whether two counts are above 0 and at least ``ratio`` of each other."""
    return (a > 0) & (b > 0) & (F.least(a, b) / F.greatest(a, b) >= ratio)


def path_exists(threaded: DataFrame, key: str, least: int = 1, least_entropy: float = 0.0, ratio: float = 0.0) -> DataFrame:
    """(key, found): all k-mers of a sequence are there with counts, entropy and neighbours' ratios as asked."""
    along = Window.partitionBy(key).orderBy("pos")
    before = F.lag("cnt").over(along)
    ok = (F.col("cnt") >= least) & (S.entropy(F.col("kmer")) >= least_entropy) & (before.isNull() | connected(before, F.col("cnt"), ratio))
    return threaded.withColumn("_ok", ok).groupBy(key).agg(F.min(F.col("_ok").cast("int")).alias("found"))


def shared_pairs(kmers: DataFrame, key: str) -> DataFrame:
    """(a, b): pairs of keys with a k-mer in common."""
    one = kmers.select(key, "kmer").distinct()
    a, b = one.select(F.col(key).alias("a"), "kmer"), one.select(F.col(key).alias("b"), "kmer")
    return a.join(b, "kmer").where("a < b").select("a", "b").distinct()


def positions(kmers: DataFrame, key: str) -> DataFrame:
    """(kmer, key, pos) of k-mers that stand more than once (K22). They are counted first, with partial sums, so a repeated one is no single task."""
    repeated = kmers.groupBy("kmer").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("kmer")
    return kmers.join(repeated, "kmer").select("kmer", key, "pos")


def gap_histogram(kmers: DataFrame, key: str) -> DataFrame:
    """(gap, n) of distances between neighbouring places of a k-mer in one sequence."""
    before = F.lag("pos").over(Window.partitionBy(key, "kmer").orderBy("pos"))
    return kmers.withColumn("gap", F.col("pos") - before).where("gap IS NOT NULL").groupBy("gap").agg(F.count(F.lit(1)).alias("n"))


def neighbours(wanted: DataFrame, k: int) -> DataFrame:
    """(kmer, hit): each k-mer and all that differ from it in one letter, 3k + 1 a k-mer."""
    at = F.explode(F.sequence(F.lit(1), F.lit(k)))
    spots = wanted.select("kmer").distinct().select("kmer", at.alias("_i")).hint("merge").select("kmer", "_i", F.explode(F.array(*map(F.lit, S.BASES))).alias("_b"))
    changed = spots.where(F.expr("substring(kmer, _i, 1) != _b")).select("kmer", F.expr(f"concat(substring(kmer, 1, _i - 1), _b, substring(kmer, _i + 1, {k}))").alias("hit"))
    return changed.unionByName(wanted.select("kmer", F.col("kmer").alias("hit")).distinct())


def within_one_mismatch(counts: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(kmer, hit, cnt): counted k-mers at no more than one mismatch (K23). Neighbours are met by equality."""
    return matching(counts, wanted, k, "one_mismatch")


def mismatches(a: Column, b: Column) -> Column:
    """In how many places two words of one length differ."""
    return F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda d: d))


def within_mismatches(counts: DataFrame, wanted: DataFrame, k: int, most: int) -> DataFrame:
    """(kmer, hit, cnt, mismatches): counted k-mers at no more than ``most`` mismatches (K23). K-mers that can be packed and have up to MASKS neighbours are met by equality with those:
    a neighbour's number is that of the k-mer with some letters' bits turned over. Others are met by equal stretches."""
    if not 0 <= most < k:
        raise ValueError(f"at least 0 and fewer than {k} mismatches")
    ask = wanted.where(F.length("kmer") == k).select("kmer").distinct()
    have = counts.where(F.length("kmer") == k).select(F.col("kmer").alias("hit"), "cnt")
    if k > packed.MOST or sum(math.comb(k, m) * 3**m for m in range(most + 1)) > MASKS:
        return _by_stretches(ask, have, k, most)
    ask, have = ask.transform(cut), have.transform(cut)
    plain = lambda c: F.col(c).rlike("^[ACGT]+$")
    rare = _by_stretches(ask.where(~plain("kmer")), have, k, most).unionByName(_by_stretches(ask.where(plain("kmer")), have.where(~plain("hit")), k, most))
    turned = [(sum(x << 2 * i for i, x in zip(at, bits, strict=True)), m) for m in range(most + 1) for at in itertools.combinations(range(k), m) for bits in itertools.product((1, 2, 3), repeat=m)]
    masks = F.broadcast(ask.sparkSession.createDataFrame(turned, "_mask long, mismatches int"))
    parts = -(-ask.count() * len(turned) // (1 << 23)) or 1  # a k-mer is few bytes and many neighbours
    near = ask.where(plain("kmer")).select(packed.code("kmer").alias("_own")).repartition(parts).crossJoin(masks).withColumn("_code", F.expr("_own ^ _mask"))
    met = near.join(have.where(plain("hit")).withColumn("_code", packed.code("hit")).hint("shuffle_hash"), "_code")
    return met.select(packed.letters(F.col("_own"), k).alias("kmer"), "hit", "cnt", "mismatches").unionByName(rare)


MASKS = 1 << 13


def _by_stretches(ask: DataFrame, have: DataFrame, k: int, most: int) -> DataFrame:
    """Of most + 1 stretches of two k-mers within ``most`` mismatches one at least is equal, so candidates are an equi-join on a stretch's place and letters; each pair is kept at its
    first equal stretch, then counted out. Where few stretches are frequent, their joins are skewed, which Spark splits."""
    cuts = [i * k // (most + 1) for i in range(most + 2)]
    stretch = lambda c, i: F.substring(c, cuts[i] + 1, cuts[i + 1] - cuts[i])
    parts = lambda c: F.posexplode(F.array(*[stretch(c, i) for i in range(most + 1)])).alias("_i", "_s")
    met = ask.select("kmer", parts("kmer")).join(have.select("hit", "cnt", parts("hit")), ["_i", "_s"])
    earlier = F.lit(False)
    for i in range(most):
        earlier = earlier | ((F.col("_i") > i) & (stretch("kmer", i) == stretch("hit", i)))
    return met.where(~earlier).select("kmer", "hit", "cnt", mismatches(F.col("kmer"), F.col("hit")).alias("mismatches")).where(F.col("mismatches") <= most)


#: Ways for k-mers to match (U05): each gives, from (kmer), the rows (kmer, hit) of what would count as its match.
COMPARATORS = {
    "exact": lambda wanted, k: wanted.select("kmer", F.col("kmer").alias("hit")).distinct(),
    "either_strand": lambda wanted, k: wanted.select("kmer", F.explode(F.array_distinct(F.array("kmer", S.revcomp(F.col("kmer"))))).alias("hit")).distinct(),
    "one_mismatch": lambda wanted, k: neighbours(wanted, k),
}


def matching(counts: DataFrame, wanted: DataFrame, k: int, how="exact") -> DataFrame:
    """(kmer, hit, cnt): counted k-mers that match wanted ones by a comparator (U05): a name of COMPARATORS, or a function like those."""
    near = (COMPARATORS[how] if isinstance(how, str) else how)(wanted, k)
    near = near.hint("merge")  # a union forgets what its parts were told
    return near.join(counts.select(F.col("kmer").alias("hit"), "cnt"), "hit").select("kmer", "hit", "cnt")


def covered(df: DataFrame, counts: DataFrame, k: int, key: str, seq: str = "seq") -> DataFrame:
    """(key, len, covered, pct): letters of each sequence inside any counted k-mer."""
    hits = explode_kmers(df, k, seq, keep=(key,), position=True).join(counts.select("kmer"), "kmer", "left_semi")
    after = F.lead("pos").over(Window.partitionBy(key).orderBy("pos"))
    own = F.least(F.lit(k), F.coalesce(after - F.col("pos"), F.lit(k)))
    sums = hits.withColumn("_own", own).groupBy(key).agg(F.sum("_own").alias("_c"))
    rows = df.select(key, F.length(seq).alias("len")).join(sums, key, "left")
    return rows.select(key, "len", F.coalesce("_c", F.lit(0)).alias("covered"), F.round(F.coalesce("_c", F.lit(0)) / F.col("len") * 100, 2).alias("pct"))


def masked(df: DataFrame, counts: DataFrame, k: int, key: str, seq: str = "seq") -> DataFrame:
    """(key, seq) with N for every letter inside a counted k-mer."""
    hits = explode_kmers(df, k, seq, keep=(key,), position=True).join(counts.select("kmer"), "kmer", "left_semi")
    places = hits.groupBy(key).agg(F.array_sort(F.collect_set("pos")).alias("_hits"))
    rows = df.select(key, seq).join(places, key, "left").withColumn("_hits", F.coalesce("_hits", F.array().cast("array<int>")))
    inside = F.expr(f"transform(split({seq}, ''), (b, i) -> if(exists(_hits, h -> i >= h AND i < h + {k}), 'N', b))")
    return rows.select(key, F.array_join(inside, "").alias("seq"))


def sharing_reads(df: DataFrame, targets: DataFrame, k: int, key: str, least_pct: float = 0.0, seq: str = "seq") -> DataFrame:
    """(key, hits, n_kmers): sequences that share k-mers with the targets, at least so many percent of their own."""
    rows = explode_kmers(df, k, seq, keep=(key,)).join(targets.select("kmer").distinct().withColumn("_t", F.lit(1)), "kmer", "left")
    sums = rows.groupBy(key).agg(F.count("_t").alias("hits"), F.count(F.lit(1)).alias("n_kmers"))
    return sums.where((F.col("hits") > 0) & (F.col("hits") / F.col("n_kmers") * 100 >= least_pct))


def dump_lines(counts: DataFrame, fasta: bool = False) -> DataFrame:
    """(line): a k-mer table as text, ``kmer count`` or FASTA with the count as header."""
    return counts.select((F.format_string(">%d\n%s", "cnt", "kmer") if fasta else F.format_string("%s %d", "kmer", "cnt")).alias("line"))


def merge(tables: list[DataFrame]) -> DataFrame:
    """Counts of several tables added up."""
    out = tables[0].select("kmer", "cnt")
    for t in tables[1:]:
        out = out.unionByName(t.select("kmer", "cnt"))
    return out.groupBy("kmer").agg(F.sum("cnt").alias("cnt"))


def read_kmer_table(lines: DataFrame, k: int) -> DataFrame:
    """(kmer, cnt) from (header, seq) of a k-mer FASTA: the header is the count; entries of another length are skipped."""
    return lines.where(F.length("seq") == k).select(F.col("seq").alias("kmer"), F.col("header").cast("long").alias("cnt"))
