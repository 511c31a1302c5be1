"""Bubbles of any number of ways, and heaviest paths, against plain Python."""

import random

from strandloom.operators import debruijn
from strandloom.plans import catalog


def test_bubbles_of_several_ways_collapse(spark):
    edges = [(1, "s", m, w) for m, w in (("a", 5), ("b", 7), ("c", 1), ("long", 9), ("other", 2))] + [(1, m, "t", w) for m, w in (("a", 3), ("b", 1), ("c", 1), ("long", 9), ("other", 2))]
    edges += [(1, "other", "u", 1), (1, "t", "v", 4), (2, "s", "a", 1), (2, "a", "t", 1)]
    letters = [(1, "a", "A"), (1, "b", "G"), (1, "c", "A"), (1, "long", "AC"), (1, "other", "T"), (2, "a", "C")]
    df = spark.createDataFrame(edges, "component long, src string, dst string, w long")
    left, nodes = debruijn.collapse_bubbles(df, spark.createDataFrame(letters, "component long, node string, seq string"))
    gone = {"a", "b", "c"}
    want = [e for e in edges if not (e[0] == 1 and (e[1] in gone or e[2] in gone))] + [(1, "s", "b", 13), (1, "b", "t", 5)]
    assert sorted(map(tuple, left.collect())) == sorted(want)
    assert [tuple(r) for r in nodes.collect()] == [(1, "b", "G", "R", 3)]  # 8 each for a and b: the larger name stays
    assert debruijn.collapse_bubbles(df.limit(0), nodes.limit(0).select("component", "node", "seq"))[0].count() == 0


def test_heaviest_paths(spark):
    r = random.Random(2)
    edges, counts = set(), {}
    for c in range(8):
        n = r.randrange(2, 12)
        counts |= {(c, f"n{v:02}"): r.randrange(1, 30) for v in range(n)}
        edges |= {(c, f"n{a:02}", f"n{b:02}") for a in range(n) for b in range(a + 1, n) if r.random() < 0.4}
    edges |= {(0, "x", "y"), (0, "y", "x")}  # a circle beside
    counts |= {(0, "x"): 1, (0, "y"): 1}
    got = {g.component: g for g in debruijn.heaviest_paths(spark.createDataFrame(sorted(edges), "component long, src string, dst string"), spark.createDataFrame([(*k, v) for k, v in counts.items()], "component long, node string, cnt long")).collect()}
    for c in range(8):
        own = {v: n for (k, v), n in counts.items() if k == c}
        after = {v: sorted(b for k, a, b in edges if (k, a) == (c, v) and v not in "xy") for v in own}
        paths = [[v] for v in own]
        for p in paths:
            paths += [[*p, b] for b in after[p[-1]]]
        top = min(own, key=lambda v: (-own[v], v))
        most = max(sum(own[v] for v in p) for p in paths if top in p)
        p = got[c].path
        assert got[c].through == top and top in p and got[c].total == most == sum(own[v] for v in p) and all(b in after[a] for a, b in zip(p, p[1:], strict=False))


def test_edge_support_of_any_edges(spark):
    """Edges that don't overlap, are of other lengths or hold other letters or nulls keep their ends; the reads hold ACGTA twice and CGTNA once."""
    edges = spark.createDataFrame([(1, "ACGT", "CGTA", 9), (1, "CGTN", "GTNA", 9), (1, "ACGT", "TTTA", 9), (1, "CGT", "GTA", 9), (2, "ACGT", None, 9)], "component long, src string, dst string, w long")
    reads = spark.createDataFrame([("ACGTACGTNA",), ("ACGTA",)], "seq string")
    got = {(x.component, x.src, x.dst, x.w) for x in debruijn.edge_support(edges, reads, 4).collect()}
    assert got == {(1, "ACGT", "CGTA", 2), (1, "CGTN", "GTNA", 1), (1, "ACGT", "TTTA", 2), (1, "CGT", "GTA", 0), (2, "ACGT", None, 0)}


def test_flows_make_edges_once(spark):
    plan = catalog.queries()["a07_flows"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1 and plan.count("part.parquet") == 1
