"""Rank correlation of samples and complete linkage against plain Python."""

import random

import numpy as np
import pandas as pd

from strandloom.operators import sampletree


def test_correlations_and_clusters(spark):
    r = random.Random(3)
    base = {g: [r.randrange(0, 60) for _ in range(80)] for g in "abc"}
    rows = [(f, f"{g}{k}", max(0, v + r.randrange(-9, 10))) for g in base for k in range(3) for f, v in enumerate(base[g])]
    rows = [x for x in rows if x[2] > 0 or r.random() < 0.5]  # zeros may be missing
    wide = pd.DataFrame(rows, columns=["f", "s", "v"]).pivot_table(index="f", columns="s", values="v", fill_value=0)
    logged = np.log2(wide + 1)
    want = logged.sub(logged.mean(axis=1), axis=0).round(9).rank().corr()
    df = spark.createDataFrame(rows, "feature long, sample string, value long").repartition(5)
    got = {(x.a, x.b): x.rho for x in sampletree.correlations(df).collect()}
    assert len(got) == 36 and max(abs(want.loc[a, b] - rho) for (a, b), rho in got.items()) < 1e-9
    found = {x["sample"]: x.cluster for x in sampletree.clusters(df, 3).collect()}
    assert found == {f"{g}{k}": "abc".index(g) + 1 for g in "abc" for k in range(3)}
    assert sampletree.clusters(df.limit(0), 3).count() == 0


def brute(d):
    groups, out = [[i] for i in range(len(d))], []
    while len(groups) > 1:
        h, i, j = min((max(d[a, b] for a in groups[i] for b in groups[j]), i, j) for i in range(len(groups)) for j in range(i + 1, len(groups)))
        groups[i] = sorted(groups[i] + groups.pop(j))
        out.append((h, tuple(groups[i])))
    return out


def test_chains_equal_plain_complete_linkage():
    r = np.random.default_rng(1)
    for n in (2, 5, 30):
        d = r.random((n, n))
        d = np.triu(d, 1) + np.triu(d, 1).T
        members, got = {i: [i] for i in range(n)}, []
        for a, b, h in sampletree.linkage(d):
            members[a] = sorted(members[a] + members.pop(b))
            got.append((h, tuple(members[a])))
        assert got == brute(d)
