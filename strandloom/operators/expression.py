"""Abundance and expression: fractional counts, FPKM, EM, normalisation, differential expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.abundance import settled
from strandloom.operators.lineage import beside, cut, numbered


def with_total(rows: DataFrame, column: str, name: str = "total", by: tuple[str, ...] = ()) -> DataFrame:
    """rows with the sum of a column over all of them, or over those of their sample where ``by`` names it. Sums are aggregates of their own, a row a sample, and no windows that would
    gather a sample's rows."""
    if not by:
        return beside(rows, rows.agg(F.sum(column).alias(name)))
    return rows.join(rows.groupBy(*by).agg(F.sum(column).alias(name)), list(by))


def fractional_counts(hits: DataFrame) -> DataFrame:
    """(feature, cnt): each fragment adds 1 over the number of features that it hits (A15). hits: distinct (frag, feature)."""
    share = 1 / F.count(F.lit(1)).over(Window.partitionBy("frag"))
    return hits.withColumn("_s", share).groupBy("feature").agg(F.sum("_s").alias("cnt"))


def refine_mappings(hits: DataFrame) -> DataFrame:
    """Hits (frag, feature, paired, complete) of the best kind that a fragment has (A16): pairs, then complete single ends, then partial ones."""
    kind = F.when(F.col("paired") == 1, 0).when(F.col("complete") == 1, 1).otherwise(2)
    rows = hits.withColumn("_kind", kind)
    return rows.withColumn("_best", F.min("_kind").over(Window.partitionBy("frag"))).where("_kind = _best").drop("_kind", "_best")


def fpkm(count: Column, length: Column, total: Column) -> Column:
    """Fragments per kilobase and million, two decimals."""
    return F.round(count / (length / 1e3) / (total / 1e6), 2)


def feature_fpkm(counts: DataFrame, lengths: DataFrame) -> DataFrame:
    """(feature, cnt, fpkm) over the features of one sample."""
    rows = counts.join(lengths.select("feature", "len"), "feature")
    return with_total(rows, "cnt").select("feature", "cnt", fpkm(F.col("cnt"), F.col("len"), F.col("total")).alias("fpkm"))


def transcript_fpkm(counts: DataFrame, lengths: DataFrame, fragment: int, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, feature, comp, eff_len, fpkm, comp_pct) of each sample that ``by`` names, or of one (A18, W11): effective length len - fragment + 1, 10 where that is below 1, and the share of the component."""
    eff = F.col("len") - fragment + 1
    rows = counts.join(lengths, "feature").withColumn("eff_len", F.when(eff < 1, 10).otherwise(eff))
    rows = with_total(rows, "cnt", "_t", by).withColumn("fpkm", F.col("cnt") / (F.col("eff_len") / 1e3) / (F.col("_t") / 1e6))
    total = F.sum("fpkm").over(Window.partitionBy(*by, "comp"))
    return rows.select(*by, "feature", "comp", "eff_len", F.round("fpkm", 4).alias("fpkm"), F.round(F.when(total > 0, F.col("fpkm") / total * 100).otherwise(0.0), 4).alias("comp_pct"))


def gene_roll_up(transcripts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, gene, len, cnt, fpkm) from (*by, gene, len, cnt, fpkm) of transcripts (A19): lengths weighed by fpkm, their mean where all are 0."""
    g = transcripts.groupBy(*by, "gene").agg(F.sum(F.col("len") * F.col("fpkm")).alias("_lw"), F.sum("fpkm").alias("_w"), F.avg("len").alias("_mean"), F.sum("cnt").alias("cnt"))
    length = F.when(F.col("_w") > 0, F.col("_lw") / F.col("_w")).otherwise(F.col("_mean"))
    return with_total(g, "cnt", by=by).select(*by, "gene", F.round(length, 4).alias("len"), "cnt", F.round(F.col("cnt") / (length / 1e3) / (F.col("total") / 1e6), 4).alias("fpkm"))


def path_fpkm(support: Column, length: Column, total: Column) -> Column:
    """Support per kilobase and million as 1e9 / (length total)."""
    return support / length * 1e9 / total


def split_support(paths: DataFrame) -> DataFrame:
    """(path, total, split) from (read, path, cnt): all counts, and counts shared out whole among a read's paths."""
    n = F.count(F.lit(1)).over(Window.partitionBy("read"))
    rows = paths.withColumn("_share", F.floor(F.col("cnt") / n).cast("long"))
    return rows.groupBy("path").agg(F.sum("cnt").alias("total"), F.sum("_share").alias("split"))


def full_matrix(counts: DataFrame, samples: list[str], fill: float | None = 0) -> DataFrame:
    """A row a feature, a column a sample (J07, O10, D18); missing ones are ``fill``, or null for None."""
    wide = counts.groupBy("feature").pivot("sample", samples).agg(F.sum("cnt"))
    return wide if fill is None else wide.na.fill(fill)


def em(combos: DataFrame, lengths: DataFrame, rounds: int = 1000, delta: float = 0.01, cut_every: int = 1) -> DataFrame:
    """(feature, theta, expected, converged) by EM (A21, A22): combos (combo, feature, cnt) are sets of features that cnt fragments fit; lengths
    (feature, len). Shares follow theta over length; rounds end when no expected count moves by ``delta``, or else after ``rounds`` with
    converged false. With delta 0 the number of rounds is fixed: each is a join and two aggregates over the combinations, not over fragments,
    lineage is cut by checkpoints, and converged is null."""
    if delta > 0:
        member = F.struct(F.col("feature").cast("long").alias("feature"), (1 / F.col("len").cast("double")).alias("weight"))
        packed = combos.join(lengths, "feature").groupBy("combo").agg(F.sort_array(F.collect_list(member)).alias("members"), F.max("cnt").alias("cnt"))
        return settled(packed, rounds, delta).select("feature", "theta", "expected", "converged")
    members = F.collect_list(F.struct("feature", F.col("len").cast("double").alias("len")))
    sets = combos.join(lengths, "feature").groupBy("combo").agg(members.alias("m"), F.max("cnt").alias("cnt"))
    sets = sets.select(F.monotonically_increasing_id().alias("combo"), "m", "cnt").transform(cut)  # numbers for names, which are long where sets are large
    rows = sets.select("combo", F.explode("m").alias("m"), "cnt").select("combo", "m.feature", "cnt", "m.len")
    now = sets.select(F.explode("m").alias("m"), (F.col("cnt") / F.size("m")).alias("_x")).groupBy("m.feature").agg(F.sum("_x").alias("expected")).transform(cut)
    for k in range(1, rounds + 1):
        shares = rows.join(now, "feature").select("combo", "feature", "cnt", (F.col("expected") / F.col("len")).alias("_w"))
        totals = shares.groupBy("combo").agg(F.sum("_w").alias("_t"))
        new = shares.join(totals, "combo").groupBy("feature").agg(F.sum(F.col("_w") / F.col("_t") * F.col("cnt")).alias("expected"))
        now = new.transform(cut) if k % cut_every == 0 else new
    return with_total(now.transform(cut), "expected").select("feature", (F.col("expected") / F.col("total")).alias("theta"), "expected", F.lit(None).cast("boolean").alias("converged"))


def em_by_read(hits: DataFrame, lengths: DataFrame, rounds: int = 41) -> DataFrame:
    """(feature, expected, theta, efpkm) by a fixed number of EM rounds over (frag, feature, prob), prob the chance of the fragment given the feature (A22): thetas begin with each fragment
    shared out evenly, lengths play no part in the rounds, and efpkm is expected * 1e9 / (fragments * len)."""
    member = F.struct(F.col("feature").cast("long").alias("feature"), F.col("prob").cast("double").alias("weight"))
    sets = hits.groupBy("frag").agg(F.sort_array(F.collect_list(member)).alias("members"))
    found = settled(sets.groupBy("members").agg(F.count(F.lit(1)).alias("cnt")), rounds, 0.0)
    rows = with_total(found.join(lengths.select("feature", "len"), "feature"), "expected")
    return rows.select("feature", "expected", "theta", (F.col("expected") * 1e9 / F.col("total") / F.col("len")).alias("efpkm"))


def tau(thetas: DataFrame, lengths: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(*by, feature, gene, tau, gene_tau): theta over effective length, normalised; sums over a gene's isoforms are gene_tau."""
    rows = thetas.join(lengths, "feature").withColumn("_t", F.col("theta") / F.col("len"))
    rows = with_total(rows, "_t", by=by).withColumn("tau", F.col("_t") / F.col("total"))
    return rows.withColumn("gene_tau", F.sum("tau").over(Window.partitionBy(*by, "comp"))).select(*by, "feature", F.col("comp").alias("gene"), F.round("tau", 8).alias("tau"), F.round("gene_tau", 8).alias("gene_tau"))


def expressed_curve(values: DataFrame, step: float = 0.2, upto: float = 10.0) -> DataFrame:
    """(threshold, n): how many values are at least each threshold (A26). Values are counted by step first, so the running sum sees one row a threshold."""
    n = int(round(upto / step))
    at = F.least(F.floor(F.col("value") / step + 1e-9), F.lit(n)).cast("int")
    steps = values.where("value >= 0").groupBy(at.alias("k")).agg(F.count(F.lit(1)).alias("c"))
    grid = values.sparkSession.range(0, n + 1).select(F.col("id").cast("int").alias("k")).join(F.broadcast(steps), "k", "left")
    total = F.sum(F.coalesce("c", F.lit(0))).over(Window.orderBy(F.desc("k")))
    return grid.select(F.round(F.col("k") * step, 2).alias("threshold"), total.alias("n"))


def length_bins(lengths: DataFrame, size: int = 100) -> DataFrame:
    """(bin, n) (A27)."""
    return lengths.groupBy(F.ceil(F.col("len") / size).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def isoforms_per_component(lengths: DataFrame) -> DataFrame:
    """(isoforms, components)."""
    return lengths.groupBy("comp").agg(F.count(F.lit(1)).alias("isoforms")).groupBy("isoforms").agg(F.count(F.lit(1)).alias("components"))


def most_significant(results: DataFrame) -> DataFrame:
    """(feature, comparison, p): the comparison with the smallest p of each feature; a tie goes to its name."""
    return results.groupBy("feature").agg(F.min(F.struct("p", "comparison")).alias("_m")).select("feature", "_m.comparison", "_m.p")


def significant(results: DataFrame, fold: float = 2, p: float = 1e-3) -> DataFrame:
    """Rows with |log_fold| >= fold and p <= p; nulls are out."""
    return results.where((F.abs("log_fold") >= fold) & (F.col("p") <= p))


def rpkm(counts: DataFrame, lengths: DataFrame) -> DataFrame:
    """(feature, sample, rpkm)."""
    total = F.sum("cnt").over(Window.partitionBy("sample"))
    return counts.join(lengths.select("feature", "len"), "feature").select("feature", "sample", F.round(F.col("cnt") / total * 1e9 / F.col("len"), 6).alias("rpkm"))


def upper_quartile(counts: DataFrame) -> DataFrame:
    """(sample, q3) of counts above 0."""
    return counts.where("cnt > 0").groupBy("sample").agg(F.percentile("cnt", F.lit(0.75)).alias("q3"))


def middle(rows: DataFrame, column: str, trim: float) -> DataFrame:
    """(sample, <column>_low, <column>_high): the values that bound a sample's rows once a share ``trim`` of them is left out at either end: those above low (null: all), up to high. Rows
    are sorted by ranges and only the two places are read, so a sample is no task of its own."""
    sorted_ = numbered(rows.select("sample", "feature", column), "sample", column, "feature", name="_k")
    sizes = sorted_.groupBy("sample").agg(F.min("_k").alias("_first"), F.count(F.lit(1)).alias("_n"))
    place, off = F.col("_k") - F.col("_first") + 1, F.floor(F.col("_n") * trim)
    at = lambda k: F.max(F.when(place == k, F.col(column)))
    return sorted_.join(sizes, "sample").groupBy("sample").agg(at(off).alias(f"{column}_low"), at(F.col("_n") - off).alias(f"{column}_high"))


def tmm(counts: DataFrame, trim_m: float = 0.3, trim_a: float = 0.05, least_sum: int = 5) -> DataFrame:
    """(sample, lib_size, factor, eff_size) by trimmed means of M values (A31), after the published method: the reference sample is the one whose
    upper quartile per library is nearest to the mean; features rare in all are left out; M values are weighed by inverse variance."""
    kept = counts.groupBy("feature").agg(F.sum("cnt").alias("_s")).where(F.col("_s") >= least_sum).select("feature")
    rows = with_total(counts.join(kept, "feature"), "cnt", "lib", ("sample",))
    quart = rows.where("cnt > 0").groupBy("sample").agg(F.percentile(F.col("cnt") / F.col("lib"), F.lit(0.75)).alias("q"))
    off = beside(quart, quart.agg(F.avg("q").alias("_mean"))).withColumn("_off", F.abs(F.col("q") - F.col("_mean")))
    ref = off.agg(F.min(F.struct("_off", "sample"))["sample"].alias("_ref"))
    ref_rows = rows.join(F.broadcast(ref), F.col("sample") == F.col("_ref"), "left_semi").select("feature", F.col("cnt").alias("r"), F.col("lib").alias("rlib"))
    both = rows.join(ref_rows, "feature").where("cnt > 0 AND r > 0")
    p, q = F.col("cnt") / F.col("lib"), F.col("r") / F.col("rlib")
    both = both.select("sample", "feature", F.log2(p / q).alias("m"), ((F.log2(p) + F.log2(q)) / 2).alias("a"), (1 / ((F.col("lib") - F.col("cnt")) / F.col("lib") / F.col("cnt") + (F.col("rlib") - F.col("r")) / F.col("rlib") / F.col("r"))).alias("w"))
    both = both.withColumn("_rm", F.round("m", 9)).withColumn("_ra", F.round("a", 9)).transform(cut)  # rounded, so that equal ratios are ties
    trimmed = both.join(middle(both, "_rm", trim_m), "sample").join(middle(both, "_ra", trim_a), "sample")
    inside = lambda c: (F.col(f"{c}_low").isNull() | (F.col(c) > F.col(f"{c}_low"))) & (F.col(c) <= F.col(f"{c}_high"))
    raw = trimmed.where(inside("_rm") & inside("_ra")).groupBy("sample").agg((F.sum(F.col("m") * F.col("w")) / F.sum("w")).alias("f"))
    libs = rows.groupBy("sample").agg(F.max("lib").alias("lib_size")).join(raw, "sample", "left").withColumn("f", F.pow(F.lit(2.0), F.coalesce("f", F.lit(0.0))))
    factor = F.col("f") / F.exp("_mean")
    return beside(libs, libs.agg(F.avg(F.log("f")).alias("_mean"))).select("sample", "lib_size", F.round(factor, 8).alias("factor"), F.round(F.col("lib_size") * factor, 4).alias("eff_size"))


def normalised_fpkm(counts: DataFrame, lengths: DataFrame, factors: DataFrame) -> DataFrame:
    """(feature, sample, fpkm) with effective library sizes."""
    rows = counts.join(factors.select("sample", "eff_size"), "sample").join(lengths.select("feature", "len"), "feature")
    return rows.select("feature", "sample", F.round(F.col("cnt") / (F.col("len") / 1e3) / (F.col("eff_size") / 1e6), 6).alias("fpkm"))


def median_centred(values: DataFrame) -> DataFrame:
    """(feature, sample, value): log2(x + 1) minus the feature's median, two decimals (W12). values: feature, sample, value."""
    logged = values.select("feature", "sample", F.log2(F.col("value") + 1).alias("v"))
    medians = logged.groupBy("feature").agg(F.median("v").alias("_m"))
    return logged.join(medians, "feature").select("feature", "sample", F.round(F.col("v") - F.col("_m"), 2).alias("value"))


def sample_pairs(samples: DataFrame, reference: str | None = None) -> DataFrame:
    """(a, b): all pairs of samples, or the reference with each other one (O09). Samples are a short list."""
    names = samples.select("sample").distinct()
    listed = names.agg(F.array_sort(F.collect_set("sample")).alias("s"))
    a = listed.select(F.explode("s").alias("a"), "s")
    pairs = a.select("a", F.explode("s").alias("b"))
    return pairs.where(F.col("a") < F.col("b")) if reference is None else pairs.where((F.col("a") == reference) & (F.col("b") != reference))


def adjusted(results: DataFrame, p: str = "p", size: int = 100_000) -> DataFrame:
    """p values adjusted by Benjamini and Hochberg within each comparison (A34). Rows are sorted by ranges; the least value from a rank on is taken in blocks of ``size`` ranks and over
    the blocks' own, so a comparison is spread over tasks."""
    rows = numbered(results, "comparison", p, "feature", name="_k").transform(cut)
    firsts = rows.groupBy("comparison").agg(F.count(F.lit(1)).alias("_n"), F.min("_k").alias("_first"))
    rank = F.col("_k") - F.col("_first") + 1
    rows = rows.join(firsts, "comparison").withColumn("_k", rank).withColumn("_x", F.col(p) * F.col("_n") / F.col("_k")).withColumn("_block", F.floor(F.col("_k") / size))
    later = Window.partitionBy("comparison").orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("comparison", "_block").agg(F.min("_x").alias("_least")).select("comparison", "_block", F.min("_least").over(later).alias("_later"))
    inside = F.min("_x").over(Window.partitionBy("comparison", "_block").orderBy(F.desc("_k")))
    out = rows.withColumn("_inside", inside).join(blocks, ["comparison", "_block"]).withColumn("fdr", F.least(F.lit(1.0), "_inside", "_later"))
    return out.select(*[F.col(f"`{c}`") for c in results.columns], "fdr")


def exact_test(pairs: DataFrame, dispersion: float = 0.1) -> DataFrame:
    """(feature, comparison, log_fold, p) of two counts a and b, scaled to one library size, by the conditional test of two negative binomial
    counts (A34). Features are independent, so they are tested by Arrow batches."""
    import numpy as np
    import pandas as pd

    def test(batches):
        from math import lgamma

        for pdf in batches:
            out = []
            r = 1 / dispersion
            for a, b in zip(pdf["a"], pdf["b"], strict=True):
                a, b = int(round(a)), int(round(b))
                s = a + b
                k = np.arange(s + 1)
                table = np.array([lgamma(i + r) - lgamma(i + 1) for i in range(s + 1)])
                w = table + table[::-1]
                w = np.exp(w - w.max())
                w /= w.sum()
                out.append(min(1.0, float(w[w <= w[a] * (1 + 1e-9)].sum())) if len(k) else 1.0)
            yield pd.DataFrame({"feature": pdf["feature"], "comparison": pdf["comparison"], "log_fold": np.log2((pdf["b"] + 0.5) / (pdf["a"] + 0.5)), "p": out})

    return pairs.select("feature", "comparison", F.col("a").cast("double").alias("a"), F.col("b").cast("double").alias("b")).mapInPandas(test, "feature long, comparison string, log_fold double, p double")


def size_factors(counts: DataFrame) -> DataFrame:
    """(sample, factor): medians of the ratios of counts to their feature's geometric mean, over features that no sample lacks."""
    samples = counts.agg(F.count_distinct("sample").alias("_s"))
    means = beside(counts.where("cnt > 0").groupBy("feature").agg(F.count(F.lit(1)).alias("_n"), F.avg(F.log("cnt")).alias("_m")), samples).where("_n = _s")
    ratios = counts.join(means.select("feature", "_m"), "feature").select("sample", F.exp(F.log("cnt") - F.col("_m")).alias("r"))
    return ratios.groupBy("sample").agg(F.median("r").alias("factor"))


def dispersion_test(counts: DataFrame, groups: DataFrame, least_dispersion: float = 1e-8) -> DataFrame:
    """(feature, mean_a, mean_b, dispersion, log_fold, p) of two groups of samples with replicates (A34), after the published method of size factors and a negative binomial test: means are those
    of scaled counts, a feature's dispersion is the larger of its own, by moments over both groups, and the median of all features' with a tenth of the features of nearest means
    (here: of the same power of two of the mean), and p is that of the groups' sums given their total. groups: (sample, grp), grp a or b."""
    factors = size_factors(counts)
    rows = counts.join(factors, "sample").join(F.broadcast(groups), "sample").withColumn("x", F.col("cnt") / F.col("factor"))
    per = rows.groupBy("feature", "grp").agg(F.avg("x").alias("m"), F.coalesce(F.var_samp("x"), F.lit(0.0)).alias("v"), F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("s"), F.sum("factor").alias("f"))
    side = lambda g: per.where(F.col("grp") == g).select("feature", *[F.col(c).alias(f"{c}_{g}") for c in ("m", "v", "n", "s", "f")])
    both = side("a").join(side("b"), "feature")
    shot = factors.agg(F.avg(1 / F.col("factor")).alias("_z"))
    n = F.col("n_a") + F.col("n_b")
    mean = (F.col("m_a") * F.col("n_a") + F.col("m_b") * F.col("n_b")) / n
    pooled = (F.col("v_a") * (F.col("n_a") - 1) + F.col("v_b") * (F.col("n_b") - 1)) / F.greatest(n - 2, F.lit(1))
    both = beside(both, shot).withColumn("_mean", mean).where("_mean > 0").withColumn("_own", F.greatest((pooled - F.col("_mean") * F.col("_z")) / F.col("_mean") / F.col("_mean"), F.lit(least_dispersion))).withColumn("_level", F.floor(F.log2("_mean")))
    trend = both.groupBy("_level").agg(F.median("_own").alias("_trend"))
    both = both.join(trend, "_level").withColumn("dispersion", F.greatest("_own", "_trend"))

    def test(batches):
        import pandas as pd

        for pdf in batches:
            p = [conditional_p(int(a), int(b), fa * q, fb * q, d, fa, fb) for a, b, fa, fb, q, d in zip(pdf["s_a"], pdf["s_b"], pdf["f_a"], pdf["f_b"], pdf["_mean"], pdf["dispersion"], strict=True)]
            yield pd.DataFrame({"feature": pdf["feature"], "mean_a": pdf["m_a"], "mean_b": pdf["m_b"], "dispersion": pdf["dispersion"], "log_fold": pdf["log_fold"], "p": p})

    fold = F.log2((F.col("m_b") + 0.5) / (F.col("m_a") + 0.5)).alias("log_fold")
    cols = [F.col(c).cast("double").alias(c) for c in ("m_a", "m_b", "s_a", "s_b", "f_a", "f_b", "_mean", "dispersion")]
    return both.select(F.col("feature").cast("long").alias("feature"), *cols, fold).mapInPandas(test, "feature long, mean_a double, mean_b double, dispersion double, log_fold double, p double")


def conditional_p(a: int, b: int, mean_a: float, mean_b: float, dispersion: float, fa: float = 1.0, fb: float = 1.0) -> float:
    """The chance, given a + b, of splits no likelier than a and b, which are negative binomial with these means; sums of scaled replicates have the dispersion over their factors."""
    from math import log

    import numpy as np

    s = a + b
    if not s:
        return 1.0

    def logs(mean: float, size: float) -> np.ndarray:
        k = np.arange(s + 1)
        grow = np.concatenate([[0.0], np.cumsum(np.log((k[:-1] + size) / (k[:-1] + 1)))])
        return size * log(size / (size + mean)) + grow + k * log(mean / (size + mean))

    x = logs(mean_a, max(fa, 1e-9) / dispersion) + logs(mean_b, max(fb, 1e-9) / dispersion)[::-1]
    w = np.exp(x - x.max())
    return min(1.0, float(w[w <= w[a] * (1 + 1e-9)].sum() / w.sum()))


def noise_probability(counts: DataFrame, groups: DataFrame, k: float = 0.5, steps: int = 64) -> DataFrame:
    """(feature, m, d, prob) of two groups of samples with replicates (A34), after the published comparison with noise: m is the log ratio and d the difference of the groups' mean rates (a million
    counts a library, 0 as k), noise is the |m| and d of all pairs of replicates of one group, and prob the share of it that is smaller in both. Noise is counted on a grid of
    ``steps`` cells a doubling, of which there are few however many features there are, so prob is exact to a cell."""
    totals = counts.groupBy("sample").agg(F.sum("cnt").alias("_t"))
    present = beside(counts.select("feature").distinct(), groups.agg(F.collect_list(F.struct("sample", "grp")).alias("_g"))).select("feature", F.explode("_g").alias("g")).select("feature", "g.sample", "g.grp")
    filled = present.join(counts.select("feature", "sample", "cnt"), ["feature", "sample"], "left").join(F.broadcast(totals), "sample")
    rate = filled.select("feature", "sample", "grp", (F.greatest(F.coalesce("cnt", F.lit(0)).cast("double"), F.lit(k)) / F.col("_t") * 1e6).alias("x"))
    cell = lambda c: F.floor(F.log2(c + 1) * steps).cast("int")
    pairs = rate.alias("p").join(rate.alias("q"), ["feature", "grp"]).where("p.sample < q.sample")
    noise = pairs.select(cell(F.abs(F.log2(F.col("p.x") / F.col("q.x")))).alias("i"), cell(F.abs(F.col("p.x") - F.col("q.x"))).alias("j")).groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"))
    at = rate.groupBy("feature").pivot("grp", ["a", "b"]).agg(F.avg("x"))
    seen = at.select("feature", F.log2(F.col("b") / F.col("a")).alias("m"), F.abs(F.col("b") - F.col("a")).alias("d"))
    seen = seen.withColumn("i", cell(F.abs("m"))).withColumn("j", cell(F.col("d")))
    # Running sums over the grid: along i in each j that has noise, at each i that is asked for, then along j in each i.
    before = lambda by, along, n: F.coalesce(F.sum(n).over(Window.partitionBy(by).orderBy(along).rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    asked = seen.select("i", "j").distinct().transform(cut)
    noise = noise.transform(cut)
    places = beside(asked.select("i").distinct(), noise.agg(F.collect_set("j").alias("_j"))).select("i", F.explode("_j").alias("j"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("_asked"))
    along_i = places.unionByName(noise.withColumn("_asked", F.lit(False))).withColumn("n", before("j", "i", "n")).where("_asked")
    along_j = along_i.withColumn("_asked", F.lit(False)).unionByName(asked.select("i", "j", F.lit(0).cast("long").alias("n"), F.lit(True).alias("_asked")))
    below = along_j.withColumn("_below", before("i", "j", "n")).where("_asked").select("i", "j", "_below")
    out = beside(seen.join(below, ["i", "j"]), noise.agg(F.sum("n").alias("_all")))
    return out.select("feature", "m", "d", (F.col("_below") / F.col("_all")).alias("prob"))


def negative_binomial_bands(counts: DataFrame, dispersion: float = 0.1, level: float = 0.95) -> DataFrame:
    """(cnt, low, high): central quantiles of a negative binomial of each distinct count's mean (A35), by summing the distribution."""
    import numpy as np
    import pandas as pd

    def bands(batches):
        r = 1 / dispersion
        for pdf in batches:
            rows = []
            for c in pdf["cnt"]:
                spread = np.sqrt(c + dispersion * c * c)
                k = np.arange(int(c + 20 * spread + 50))
                logs = r * np.log(r / (r + c)) + np.concatenate([[0], np.cumsum(np.log((k[:-1] + r) / (k[:-1] + 1)))]) + k * np.log(max(c, 1e-300) / (r + c))
                cdf = np.cumsum(np.exp(logs))
                rows.append((int(np.searchsorted(cdf, (1 - level) / 2)), int(np.searchsorted(cdf, (1 + level) / 2))))
            yield pd.DataFrame({"cnt": pdf["cnt"], "low": [x[0] for x in rows], "high": [x[1] for x in rows]})

    return counts.select(F.col("cnt").cast("long").alias("cnt")).distinct().mapInPandas(bands, "cnt long, low long, high long")


def poisson_bands(counts: DataFrame, level: float = 0.95) -> DataFrame:
    """(cnt, low, high): central Poisson quantiles of each distinct count (A35), by summing the distribution."""
    import numpy as np
    import pandas as pd

    def bands(batches):
        for pdf in batches:
            rows = []
            for c in pdf["cnt"]:
                k = np.arange(int(c + 12 * np.sqrt(c + 1) + 20))
                logs = -c + k * np.log(max(c, 1e-300)) - np.concatenate([[0], np.cumsum(np.log(np.arange(1, len(k))))])
                cdf = np.cumsum(np.exp(logs))
                rows.append((int(np.searchsorted(cdf, (1 - level) / 2)), int(np.searchsorted(cdf, (1 + level) / 2))))
            yield pd.DataFrame({"cnt": pdf["cnt"], "low": [r[0] for r in rows], "high": [r[1] for r in rows]})

    return counts.select("cnt").distinct().mapInPandas(bands, "cnt long, low long, high long")
