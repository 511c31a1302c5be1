"""Queries without SQL do the whole job: iterations run until they settle, and no rows are left out."""

import numpy as np
from pyspark.sql import functions as F

from strandloom.operators import align as AL
from strandloom.operators import expression as X
from strandloom.operators import more as M
from strandloom.plans import catalog
from strandloom.plans import expr_queries as E

SF = "/root/testdata/sf0.001"


def test_weighted_em_settles(spark):
    got = catalog.queries()["a23_weighted_em"](spark, SF).toPandas().set_index("feature")
    hits = E.hits(spark, SF).toPandas()
    theta, w = got["theta"], 1 / (1 + hits["feature"] % 5)
    fit = hits.assign(w=w * theta.reindex(hits["feature"]).to_numpy())
    every = fit.groupby("frag")["w"].sum() + 1e-7 * theta[-1]
    new = (fit["w"] / every.reindex(fit["frag"]).to_numpy()).groupby(fit["feature"]).sum() / len(every)
    assert got["converged"].all() and set(new.index) == set(theta.index) - {-1}
    new = new[new >= 1e-7]
    assert (np.abs(new - theta.reindex(new.index)) / new).max() < 1e-3
    assert not M.weighted_em(E.hits(spark, SF).withColumn("prob", F.lit(0.5)), rounds=20).toPandas()["converged"].any()


def test_em_settles(spark):
    # Two features and a set of both: the smaller one loses its share slowly, over more than 200 rounds.
    combos = spark.createDataFrame([("1", 1, 1000), ("1,2", 1, 10**6), ("1,2", 2, 10**6)], "combo string, feature long, cnt long")
    lengths = spark.createDataFrame([(1, 100), (2, 100)], "feature long, len long")
    got = X.em(combos, lengths).toPandas().set_index("feature")
    assert not got["converged"].any()  # 1000 rounds are not enough here
    got = X.em(combos, lengths, rounds=100_000).toPandas().set_index("feature")
    assert got["converged"].all() and got["expected"][2] * 1000 / 1_001_000 < 0.011 and abs(got["expected"].sum() - 1_001_000) < 1e-3
    fixed, free = X.em(combos, lengths, rounds=3, delta=0).toPandas().set_index("feature"), X.em(combos, lengths, rounds=3, delta=1e-9).toPandas().set_index("feature")
    assert np.allclose(fixed["theta"].sort_index(), free["theta"].sort_index()) and not free["converged"].any()


def test_em_converged(spark):
    rows = catalog.queries()["a21_em_converged"](spark, "/root/testdata/sf0.01").toPandas()
    assert len(rows) and rows["converged"].all()


def brute_linkage(x, clusters):
    groups = [[i] for i in range(len(x))]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    while len(groups) > clusters:
        a, b = min(((d[np.ix_(groups[i], groups[j])].mean(), i, j) for i in range(len(groups)) for j in range(i + 1, len(groups))))[1:]
        groups[a] += groups.pop(b)
    return sorted(map(tuple, map(sorted, groups)))


def clusters_of(frame):
    return sorted(tuple(sorted(g)) for g in frame.groupby("cluster")["feature"].apply(list))


def test_agglomerate_takes_all_rows(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(60, 3)).round(2)
    x[40:] = x[r.integers(0, 40, 20)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "feature long, value array<double>").repartition(3)
    assert clusters_of(M.agglomerate(df, 5).toPandas()) == brute_linkage(x, 5)
    # More distinct values than fit at once: far groups are still found, and no row is lost.
    centres = np.array([[0, 0], [40, 0], [0, 40]])
    y = centres[np.arange(900) % 3] + r.normal(size=(900, 2))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(y.tolist())], "feature long, value array<double>")
    assert clusters_of(M.agglomerate(df, 3, most=50).toPandas()) == sorted(tuple(range(k, 900, 3)) for k in range(3))
    assert {r.step > 0 for r in M.agglomerate(df, 3, most=50).select("step").distinct().collect()} == {True}
    assert M.agglomerate(df.limit(0), 3).count() == 0


def test_all_features_are_clustered(spark):
    sf = "/root/testdata/sf0.01"
    got = catalog.queries()["p27_agglomerate"](spark, sf).toPandas()
    assert len(got) == E.counts(spark, sf).select("feature").distinct().count() > 200 and got["cluster"].nunique() == 5 and set(got["step"]) == {0.0}


def test_components_of_the_whole_table(spark):
    got = {r.node: r.component for r in catalog.queries()["p05_components_large"](spark, SF).collect()}
    top: dict[int, int] = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for r in spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_partkey").collect():
        a, b = root(r.l_orderkey * 10), root(r.l_partkey * 10 + 1)
        top[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in top}


def test_whole_transcripts_are_aligned(spark):
    got = {(r.tid, r.other): r for r in catalog.queries()["n18_alignments"](spark, SF).collect()}
    seqs = {r.tid: r.seq for r in E.transcripts(spark, SF).collect()}
    first: dict[str, int] = {}
    for t in sorted(seqs):
        first.setdefault(seqs[t], t)
    windows = {q: {q[i : i + 25] for i in range(len(q) - 24)} for q in first}
    want = {(t, o) for t, q in seqs.items() for p, o in first.items() if t != o and windows[q] & windows[p]}
    assert set(got) == want and any(seqs[t] != seqs[o] for t, o in want)
    for t, o in sorted(want)[::40]:
        f = AL.align(seqs[min(first[seqs[t]], o)], seqs[max(first[seqs[t]], o)])
        assert [got[t, o][x] for x in ("score", "matches", "mismatches", "gaps")] == [f[x] for x in ("score", "matches", "mismatches", "gaps")]
        assert 2 * (f["matches"] + f["mismatches"]) + f["gaps"] == 192
    similar = {(r.tid, r.other): r.similar for r in catalog.queries()["f21_similar_transcripts"](spark, SF).collect()}
    assert similar == {x: AL.too_similar(r.gaps, r.mismatches, r.matches) for x, r in got.items()}


def test_align_sharing_odd_inputs(spark):
    df = spark.createDataFrame([(1, "ACGT"), (2, "ACGT"), (3, None), (4, ""), (5, "ACGTACGTACGT")], "id long, seq string")
    assert [(r.id, r.other, r.matches) for r in AL.align_sharing(df, 6).collect()] == [(2, 1, 4)]
