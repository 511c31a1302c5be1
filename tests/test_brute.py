"""Operators without SQL, and those that work in stretches, against plain Python."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandloom.operators import abundance, clustering, coding, coverage, debruijn, expression, intervals
from strandloom.sources import formats, sinks


def parts(r, n, most=400):
    rows = []
    for _ in range(n):
        a = r.randrange(1, most)
        rows.append((r.choice("xyz"), a, a + r.randrange(30)))
    return rows


def brute_merge(rows, gap):
    out = []
    for s in sorted({x[0] for x in rows}):
        now = None
        for _, a, b in sorted(x for x in rows if x[0] == s):
            if now and a - now[2] - 1 <= gap:
                now = (s, now[1], max(now[2], b), now[3] + 1)
            else:
                out += [now] if now else []
                now = (s, a, b, 1)
        out.append(now)
    return sorted(out)


@pytest.mark.parametrize("size", [7, 64, 100_000])
def test_intervals_in_stretches(spark, size):
    r = random.Random(size)
    for n in (1, 12, 60):
        rows = parts(r, n, 2000 if n < 50 else 600)
        df = spark.createDataFrame(rows, "scaff string, lend long, rend long")
        for gap in (-1, 0, 25):
            got = sorted((x.scaff, x.lend, x.rend, x.members) for x in intervals._piled(df, gap, size).collect())
            assert got == brute_merge(rows, gap)
        piles = brute_merge(rows, -1)
        gaps = [(a[0], a[2] + 1, b[1] - 1) for a, b in zip(piles, piles[1:], strict=False) if a[0] == b[0] and b[1] - a[2] - 1 >= 10]
        assert sorted(tuple(x) for x in intervals.gaps_between(df, 10, size).collect()) == gaps
        spots = {(s, p) for s, a, b in rows for p in range(a, b + 1)}
        pos = spark.createDataFrame(sorted(spots), "scaff string, pos long")
        assert sorted(tuple(x) for x in intervals.islands(pos, size).collect()) == [x[:3] for x in brute_merge(rows, 0)]


@pytest.mark.parametrize("stretch", [10, 77, 64_000])
def test_depth_runs_in_stretches(spark, monkeypatch, stretch):
    monkeypatch.setattr(coverage, "STRETCH", stretch)
    rows = parts(random.Random(3), 60)
    got = {(x.scaff, p): x.cov for x in coverage.depth_runs(spark.createDataFrame(rows, "scaff string, lend long, rend long")).collect() for p in range(x.lend, x.rend + 1)}
    want = defaultdict(int)
    for s, a, b in rows:
        for p in range(a, b + 1):
            want[s, p] += 1
    assert got == want


def brute_shadow(a, b, k):
    hits = misses = size = 0
    last = None
    for i in range(min(len(a), len(b))):
        size += 1
        if a[i] != b[i]:
            if last is not None:
                if i > 3 and a[i - 1] != b[i - 1] and a[i - 2] != b[i - 2]:
                    break
                hits, misses = (hits + 1, misses) if i - last == k + 1 else (hits, misses + 1)
            last = i
    return hits > 4 and hits >= int(0.9 * (size // (k + 1) - 1)) and misses < hits // 5


def test_shadows(spark):
    r = random.Random(4)
    rows = []
    for i in range(600):
        n = r.randrange(90)
        a = "".join(r.choice("ACGT") for _ in range(n))
        step = r.choice([4, 4, 4, 5])
        b = "".join("N" if (j % step == 1 and r.random() < 0.97) or r.random() < 0.01 else c for j, c in enumerate(a)) + "A" * r.randrange(5)
        rows.append((i, a, b if r.random() < 0.9 else b[:7] + "NNN" + b[10:]))
    got = {x.i: x.s for x in spark.createDataFrame(rows, "i int, a string, b string").select("i", clustering.is_shadow(F.col("a"), F.col("b"), 3).alias("s")).collect()}
    want = {i: brute_shadow(a, b, 3) for i, a, b in rows}
    assert got == want and 50 < sum(want.values()) < 550


def brute_prune(edges, ratio, flow):
    ins, outs = defaultdict(list), defaultdict(list)
    for a, b, w in edges:
        outs[a].append(w)
        ins[b].append(w)

    def avg(n):
        sides = [sum(x) for x in (ins[n], outs[n]) if x]
        return sum(sides) / len(sides)

    weak = lambda a, b, w: (len(ins[b]) > 1 and w <= ratio * sum(ins[b])) or (len(outs[a]) > 1 and w <= ratio * sum(outs[a])) or w < flow * sum(ins[a]) or w < flow * sum(outs[b]) or w < flow * max(avg(a), avg(b))
    return [e for e in edges if not weak(*e)]


def test_pruning_to_the_end(spark):
    r = random.Random(5)
    edges = sorted({(r.randrange(30), r.randrange(30)) for _ in range(120)})
    edges = [(f"n{a}", f"n{b}", r.choice([1, 2, 30, 300, 1000])) for a, b in edges if a != b]
    df = spark.createDataFrame([(1, *e) for e in edges], "component long, src string, dst string, w long")
    once = brute_prune(edges, 0.05, 0.02)
    assert sorted((x.src, x.dst, x.w) for x in debruijn.prune_once(df).collect()) == sorted(once)
    while len(once) < len(edges):
        edges, once = once, brute_prune(once, 0.05, 0.02)
    assert sorted((x.src, x.dst, x.w) for x in debruijn.prune(df).collect()) == sorted(once)
    nodes = spark.createDataFrame([(1, f"n{i}", 1e9 if i == 3 else 0.0) for i in range(30)], "component long, node string, avg double")
    assert debruijn.prune_once(df, nodes=nodes).where("src = 'n3' OR dst = 'n3'").count() == 0


def test_bounded_groups(spark):
    r = random.Random(6)
    edges = sorted({tuple(sorted(r.sample(range(60), 2))) for _ in range(80)})
    got = {x.node: x.grp for x in clustering.bounded_groups(spark.createDataFrame(edges, "a long, b long"), 5).collect()}
    members = defaultdict(set)
    for n, g in got.items():
        members[g].add(n)
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    assert set(got) == {n for e in edges for n in e} and all(len(m) <= 5 and g == min(m) for g, m in members.items())
    for g, m in members.items():  # each group hangs together, and no two neighbours would still fit in one
        seen, todo = set(), [g]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += near[x] & m
        assert seen == m
        assert all(len(m) + len(members[got[y]]) > 5 for x in m for y in near[x] if got[y] != g)


def test_tiers_and_overlaps(spark):
    r = random.Random(7)
    rows = [(r.randrange(6), i, a := r.randrange(500), a + r.randrange(20, 200), r.randrange(40)) for i in range(120)]
    df = spark.createDataFrame(rows, "gene long, hit long, lend long, rend long, score long").repartition(4)
    got = {(x.gene, x.hit): x.tier for x in coding.tiers(df, 0.3).collect()}
    share = lambda x, y: (min(x[3], y[3]) - max(x[2], y[2]) + 1) / min(x[3] - x[2] + 1, y[3] - y[2] + 1)
    for g in range(6):
        tiers = []
        for x in sorted((x for x in rows if x[0] == g), key=lambda x: (-x[4], x[1])):
            n = next((n for n, t in enumerate(tiers) if all(share(x, y) <= 0.3 for y in t)), len(tiers))
            tiers += [[]] * (n == len(tiers))
            tiers[n] = [*tiers[n], x]
            assert got[g, x[1]] == n + 1
    found = {(x.transcript, x.hit) for x in coding.without_overlaps(df.select(F.col("gene").alias("transcript"), (F.col("hit") % 9).alias("gene"), "hit", "lend", "rend", "score")).collect()}
    for g in range(6):
        kept = []
        for x in sorted((x for x in rows if x[0] == g), key=lambda x: (-x[4], x[1])):
            if all(x[1] % 9 != y[1] % 9 and (x[2] > y[3] or x[3] < y[2]) for y in kept):
                kept.append(x)
        assert {h for t, h in found if t == g} == {x[1] for x in kept}


def test_bands(spark):
    df = spark.createDataFrame([(c,) for c in (0, 1, 3, 10, 75, 400)], "cnt long")
    for x in expression.poisson_bands(df).collect():
        pmf = [math.exp(-x.cnt + k * math.log(x.cnt) - math.lgamma(k + 1)) if x.cnt else float(k == 0) for k in range(700)]
        cdf = np.cumsum(pmf)
        assert (x.low, x.high) == (int(np.argmax(cdf >= 0.025)), int(np.argmax(cdf >= 0.975)))
    for x in expression.negative_binomial_bands(df, 0.1).collect():
        p = 10 / (10 + x.cnt)
        pmf = [math.exp(math.lgamma(k + 10) - math.lgamma(k + 1) - math.lgamma(10) + 10 * math.log(p) + (k * math.log(1 - p) if x.cnt else (0 if k == 0 else -1e9))) for k in range(3000)]
        cdf = np.cumsum(pmf)
        assert (x.low, x.high) == (int(np.argmax(cdf >= 0.025)), int(np.argmax(cdf >= 0.975)))


def test_conditional_p():
    for a, b, ma, mb, d in ((3, 9, 6, 6, 0.2), (0, 5, 2, 3, 0.01), (40, 10, 25, 25, 0.5), (0, 0, 1, 1, 0.1)):
        logs = lambda k, m, size: math.lgamma(k + size) - math.lgamma(k + 1) - math.lgamma(size) + size * math.log(size / (size + m)) + k * math.log(m / (size + m))
        w = [math.exp(logs(k, ma, 1 / d) + logs(a + b - k, mb, 1 / d)) for k in range(a + b + 1)]
        assert expression.conditional_p(a, b, ma, mb, d) == pytest.approx(sum(x for x in w if x <= w[a] * (1 + 1e-9)) / sum(w))


def expressed(seed=8):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(300):
        mean = r.choice([20, 100, 400])
        for s, grp in (("a1", "a"), ("a2", "a"), ("a3", "a"), ("b1", "b"), ("b2", "b")):
            up = 8 if i < 20 and grp == "b" else 1
            n = int(r.negative_binomial(20, 20 / (20 + mean * up * (2 if s == "a2" else 1))))
            if n:
                rows.append((i, s, n))
    groups = [(s, s[0]) for s in ("a1", "a2", "a3", "b1", "b2")]
    return rows, groups


def test_differential_expression(spark):
    rows, groups = expressed()
    counts, g = spark.createDataFrame(rows, "feature long, sample string, cnt long"), spark.createDataFrame(groups, "sample string, grp string")
    factors = {x.sample: x.factor for x in expression.size_factors(counts).collect()}
    assert 1.7 < factors["a2"] / factors["a1"] < 2.3
    got = {x.feature: x for x in expression.dispersion_test(counts, g).collect()}
    assert sum(got[i].p < 1e-3 and got[i].log_fold > 1 for i in range(20)) >= 18
    assert sum(got[i].p < 1e-3 for i in range(20, 300)) <= 5
    probs = {x.feature: (x.m, x.prob) for x in expression.noise_probability(counts, g).collect()}
    assert min(probs[i][1] for i in range(20)) > np.median([probs[i][1] for i in range(20, 300)]) and probs[0][0] > 1
    # prob, recounted without the grid, differs by the noise that shares a cell only
    wide = {f: {s: max(0.5, 0) for s, _ in groups} for f, _, _ in rows}
    for f, s, n in rows:
        wide[f][s] = max(n, 0.5)
    total = {s: sum(n for _, x, n in rows if x == s) for s, _ in groups}
    rate = {f: {s: v / total[s] * 1e6 for s, v in x.items()} for f, x in wide.items()}
    noise = [(abs(math.log2(x[s] / x[t])), abs(x[s] - x[t])) for x in rate.values() for s, t in (("a1", "a2"), ("a1", "a3"), ("a2", "a3"), ("b1", "b2"))]
    for f, x in rate.items():
        a, b = np.mean([x[s] for s in ("a1", "a2", "a3")]), np.mean([x[s] for s in ("b1", "b2")])
        m, d = abs(math.log2(b / a)), abs(b - a)
        assert abs(sum(i < m and j < d for i, j in noise) / len(noise) - probs[f][1]) < 0.06


def test_em_by_read(spark):
    r = random.Random(9)
    hits = [(i, f, r.choice([0.1, 0.5, 1.0])) for i in range(80) for f in r.sample(range(6), r.randrange(1, 4))]
    lengths = spark.createDataFrame([(f, 100 * (f + 1)) for f in range(6)], "feature long, len long")
    got = {x.feature: x for x in expression.em_by_read(spark.createDataFrame(hits, "frag long, feature long, prob double"), lengths).collect()}
    by = defaultdict(list)
    for i, f, p in hits:
        by[i].append((f, p))
    theta = defaultdict(float)
    for fs in by.values():
        for f, _ in fs:
            theta[f] += 1 / len(fs) / len(by)
    for _ in range(41):
        expected = defaultdict(float)
        for fs in by.values():
            t = sum(theta[f] * p for f, p in fs)
            for f, p in fs:
                expected[f] += theta[f] * p / t
        theta = {f: e / len(by) for f, e in expected.items()}
    for f, e in expected.items():
        assert got[f].expected == pytest.approx(e) and got[f].efpkm == pytest.approx(e * 1e9 / len(by) / (100 * (f + 1)))


def test_readers_of_many_splits(spark, tmp_path):
    """Lines are put together again though a file is read in many pieces."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        records = [(f"r{i}", "ACGT"[: i % 4 + 1] * 5, "@" * (i % 4 + 1) * 5) for i in range(100)]
        (tmp_path / "a.fq").write_text("".join(f"@{n}/{1 + i % 2}\n{s}\n+\n{q}\n" for i, (n, s, q) in enumerate(records)))
        got = formats.fastq(spark, str(tmp_path / "a.fq"))
        assert got.rdd.getNumPartitions() >= 1 and sorted((x.name, x.seq, x.qual) for x in got.collect()) == sorted(records)
        lines = [(f"c{i // 40}", i, i % 7) for i in range(200)]
        (tmp_path / "a.wig").write_text("".join((f"variableStep chrom={c}\n" if i % 40 == 0 else "") + f"{i} {v}\n" for c, i, v in lines))
        assert sorted(tuple(x) for x in formats.wig(spark, str(tmp_path / "a.wig")).collect()) == sorted((c, i, float(v)) for c, i, v in lines)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_dirty_fastq(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@r1 1:N:0\nACGN\n+\nIIII\n@r2\nACG\n+\nII\n@r3/2\r\nAAC\r\n+\r\nJKL\r\n")
    path = str(tmp_path / "a.fq")
    assert sorted((x.name, x.mate, x.seq, x.qual) for x in formats.fastq(spark, path, reverse=True).collect()) == [("r1", 1, "NCGT", "IIII"), ("r3", 2, "GTT", "LKJ")]
    assert sorted(x.header for x in formats.fastq_to_fasta(formats.fastq(spark, path, append=1)).collect()) == ["r1/1", "r3/1"]
    with pytest.raises(Exception, match="dirty record"):
        formats.fastq(spark, path, ignore_dirty=False).collect()


def test_sam_with_many_tags(spark, tmp_path):
    tags = [f"X{i}:i:{i}" for i in range(1500)]
    (tmp_path / "a.sam").write_text("r1\t16\tc\t1\t9\t4M\t=\t1\t0\tACGG\tIJKL\t" + "\t".join(tags) + "\nr2\t0\tc\t1\t9\t4M\t=\t1\t0\tACGG\tIJKL\n")
    rows = formats.sam(spark, str(tmp_path / "a.sam"))
    assert {x.qname: len(x.tags) for x in rows.collect()} == {"r1": 1500, "r2": 0}
    assert {x.r for x in rows.select(sinks.sam_fastq_record(rows).alias("r")).collect()} == {"@r1\nCCGT\n+\nLKJI", "@r2\nACGG\n+\nIJKL"}


def brute_contigs(counts, least_length):
    """Greedy contigs over one table of all k-mers, without parting it."""
    left = dict(counts)
    out = []
    comp = str.maketrans("ACGT", "TGCA")

    def entropy(x):
        return -sum(x.count(b) / len(x) * math.log2(x.count(b) / len(x)) for b in set(x))

    def grow(kmer, used, right):
        path = []
        while True:
            steps = [(left.get(n, 0), n) for b in "ACGT" for n in [kmer[1:] + b if right else b + kmer[:-1]] if n not in used]
            best = max((c for c, _ in steps), default=0)
            if not best:
                return path
            kmer = next(n for c, n in steps if c == best)
            used.add(kmer)
            path.append(kmer)

    for seed, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        if not left[seed] or n < 2 or seed == seed.translate(comp)[::-1] or entropy(seed) < 1.5:
            continue
        used = {seed}
        after = grow(seed, used, True)
        path = [*grow(seed, used, False)[::-1], seed, *after]
        total = sum(left[x] for x in path)
        left.update(dict.fromkeys(path, 0))
        seq = path[0] + "".join(x[-1] for x in path[1:])
        if len(seq) >= least_length and int(total / len(path) + 0.5) >= 2:
            out.append((seed, seq, int(total / len(path) + 0.5)))
    return out


def test_greedy_contigs(spark):
    from strandloom.operators import contigs

    r = random.Random(12)
    genomes = ["".join(r.choice("ACGT") for _ in range(150)) for _ in range(6)]
    genomes.append(genomes[0][:70] + genomes[1][60:])
    counts = defaultdict(int)
    for g in genomes:
        for _ in range(r.randrange(3, 40)):
            i = r.randrange(100)
            read = "".join(r.choice("ACGT") if r.random() < 0.01 else c for c in g[i : i + 50])
            for j in range(len(read) - 12):
                counts[read[j : j + 13]] += 1
    table = spark.createDataFrame(sorted(counts.items()), "kmer string, cnt long")
    found = contigs.assemble(table, 13, 20)
    assert sorted((x.seed, x.seq, x.cov) for x in found.collect()) == sorted(brute_contigs(dict(counts), 20))
    names = {x.seq: x.acc for x in contigs.named(found, table, 13).collect()}
    want = sorted(brute_contigs(dict(counts), 20), key=lambda x: (-counts[x[0]], x[0]))
    assert names == {seq: f"a{i + 1};{cov}" for i, (_, seq, cov) in enumerate(want)}


def test_exact_test(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate([(0, 0), (3, 9), (50, 50), (1, 40), (200, 120)])]
    got = {x.feature: x for x in expression.exact_test(spark.createDataFrame([(i, "c", a, b) for i, a, b in rows], "feature long, comparison string, a long, b long"), 0.1).collect()}
    for i, a, b in rows:
        w = [math.exp(math.lgamma(k + 10) - math.lgamma(k + 1) + math.lgamma(a + b - k + 10) - math.lgamma(a + b - k + 1) - 2 * math.lgamma(10)) for k in range(a + b + 1)]
        assert got[i].p == pytest.approx(min(1.0, sum(x for x in w if x <= w[a] * (1 + 1e-9)) / sum(w))) and got[i].log_fold == pytest.approx(math.log2((b + 0.5) / (a + 0.5)))


def test_gibbs_is_near_em(spark):
    combos = spark.createDataFrame([("1", 1, 900), ("2", 2, 100), ("1,2", 1, 1000), ("1,2", 2, 1000)], "combo string, feature long, cnt long")
    lengths = spark.createDataFrame([(1, 100), (2, 100)], "feature long, len long")
    em = {x.feature: x.expected for x in expression.em(combos, lengths, 5000, 1e-6).collect()}
    got = {x.feature: x for x in abundance.gibbs(combos, lengths, 2, 400, 100).collect()}
    assert all(abs(got[f].mean - em[f]) < 40 and got[f].low < em[f] < got[f].high for f in em)
    again = {x.feature: x for x in abundance.gibbs(combos.repartition(3), lengths, 2, 400, 100).collect()}
    assert again == got
