"""Welds looked up from reads, against all weldmers of pairs of contigs."""

import random
from collections import Counter

import pytest

from strandloom.operators import clustering as CL
from strandloom.operators import welds as WE


def made():
    r = random.Random(5)
    genes = ["".join(r.choices("ACGT", k=60)) for _ in range(6)]
    odd = genes[0][:20] + "N" + genes[0][20:40] + "ü" + genes[0][40:]
    contigs = [(i * 3 - 4, g[a : a + n]) for i, (g, a, n) in enumerate((g, a, n) for g in [*genes, odd] for a, n in ((0, 40), (15, 45), (30, 9), (20, 11), (0, 60)))]
    contigs += [(None, genes[0]), (500, None), (501, ""), (-4, genes[3])]
    pieces = [*genes, odd, genes[1][:30] + genes[2][30:], *[s for _, s in contigs if s]]
    reads = [s[a : a + 25] for _ in range(400) for s in [r.choice(pieces)] for a in [r.randrange(len(s))]] + [None, "", "NNNNNNNNNNNNNNNNNNNN"]
    return contigs, reads


@pytest.mark.parametrize("k,flank", [(8, 3), (6, 0), (12, 6)])
def test_welds_are_those_of_all_weldmers(spark, k, flank):
    contigs, reads = made()
    n = k + 2 * flank
    seen = Counter(s[i : i + n] for s in reads if s for i in range(len(s) - n + 1))
    cut = [(c, s[i : i + k], s[i - flank : i] if i >= flank else None, s[i + k : i + k + flank] if i + k + flank <= len(s) else None) for c, s in contigs if c is not None and s for i in range(len(s) - k + 1)]
    welds = {(a, b, left + core + right) for a, core, left, _ in cut if left is not None for b, other, _, right in cut if right is not None and core == other and a != b}
    df = spark.createDataFrame(contigs, "contig long, seq string").repartition(3)
    rd = spark.createDataFrame([(s,) for s in reads], "seq string").repartition(3)
    theirs = {w: seen[w] for _, _, w in welds if seen[w]}
    found = CL.welded_in(df, rd, k, flank).collect()
    assert {r.weldmer: r.cnt for r in found} == theirs and len(found) == len(theirs) > 0
    most = Counter()
    for a, b, w in welds:
        if seen[w] >= 2:
            most[min(a, b), max(a, b)] = max(most[min(a, b), max(a, b)], seen[w])
    assert {(r.a, r.b): r.cnt for r in WE.pairs(df, rd, k, flank, 2).collect()} == dict(most)


def test_no_weldmers_are_made(spark, monkeypatch):
    """Cores that contigs share by chance make no rows: before, all their weldmers were written before reads were looked at."""
    from strandloom.plans import catalog

    def no(*_a, **_b):
        raise AssertionError("weldmers were made")

    monkeypatch.setattr(CL, "weldmers", no)
    for name in ("a01_weld_support", "a02_weld_decision"):
        assert catalog.queries()[name](spark, "/root/testdata/sf0.001").count() > 0


def test_bounded_groups_go_by_lots(spark):
    """Many components are a task's rows one after the other, not a Python call each."""
    r = random.Random(11)
    edges = [(10 * c + r.randrange(8), 10 * c + r.randrange(8)) for c in range(300) for _ in range(6)]
    edges = [e for e in edges if e[0] != e[1]]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = CL.bounded_groups(spark.createDataFrame(edges, "a long, b long"), 3)
        assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().sparkPlan().toString()
        got = {x.node: x.grp for x in found.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    near: dict = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    group, members, done = {n: n for n in near}, {n: {n} for n in near}, set()
    while left := [g for g in members if g not in done]:
        g = min(left, key=lambda x: (len(members[x]), x))
        fits = [h for h in {group[m] for n in members[g] for m in near[n]} - {g} if len(members[h]) + len(members[g]) <= 3]
        if not fits:
            done.add(g)
            continue
        h = min(fits, key=lambda x: (len(members[x]), x))
        keep, gone = min(g, h), max(g, h)
        group.update(dict.fromkeys(members[gone], keep))
        members[keep] |= members.pop(gone)
        done.discard(keep)
    assert got == group
