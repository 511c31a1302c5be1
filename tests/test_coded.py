"""Graphs whose nodes are numbers until the end, against those of letters."""

import pytest

from strandloom.operators import debruijn as G
from strandloom.plans import catalog

BUNDLES = [(1, "ACGTACGGTTACGXACGTNACGGaCGTT"), (2, "TTTTTTTTXACG"), (2, "ggTTACGTACGTA"), (3, None), (None, "ACGTACGGTT")]
READS = [("ACGTACGGTTACG",), ("ACGTACGGTTACG",), ("GGTTAC",), ("GGaCGTT",), ("TTTTTTTT",), (None,), ("CGTACNTA",)]
STEPS = {"flows": (G.flows, ["node"]), "prune": (G.prune, ["src", "dst"]), "prune_once": (G.prune_once, ["src", "dst"]), "damp": (lambda e: G.damp(e, 1), ["src", "dst"]), "compactable": (G.compactable, ["src", "dst"]), "edges": (lambda e: e, ["src", "dst"])}


@pytest.mark.parametrize("name", STEPS)
def test_same_rows(spark, name):
    step, nodes = STEPS[name]
    bundles, reads = spark.createDataFrame(BUNDLES, "component long, seq string"), spark.createDataFrame(READS, "seq string")
    theirs = step(G.edge_support(G.build(bundles, 4), reads, 4))
    ours = G.named(step(G.supported_nodes(bundles, reads, 4)), 4, *nodes)
    order = lambda df: sorted(map(tuple, df.select(theirs.columns).collect()), key=str)
    assert order(ours) == order(theirs) and ours.count() > 0


@pytest.mark.parametrize("name", ["a07_flows", "p08_prune_once", "p09_damp", "p10_compactable"])
def test_letters_of_nodes_are_not_shuffled(spark, name):
    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    text = plan.toString()
    assert text.count("lpad(") <= 2 and "lpad(" not in text.split("\n", 1)[1]  # made in the topmost projection only


def test_edges_are_shuffled_once_by_component(spark):
    """Before, flows and either end's join shuffled edges by component and node."""
    plan = G.prune_once(G.supported_nodes(spark.createDataFrame(BUNDLES, "component long, seq string"), spark.createDataFrame(READS, "seq string"), 4))._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.split("\n") if "Exchange hashpartitioning(component" in x]
    assert sum("REPARTITION_BY_COL" in x for x in dealt) == 1 and not any("_node#" in x or "_id#" in x for x in dealt)


def test_rounds_leave_one_table(spark, monkeypatch):
    gone = []
    monkeypatch.setattr(G, "dropped", lambda df: gone.append(df))
    bundles, reads = spark.createDataFrame(BUNDLES, "component long, seq string"), spark.createDataFrame(READS, "seq string")
    written, own = [], G.cut
    monkeypatch.setattr(G, "cut", lambda df: written.append(1) or own(df))
    G.prune(G.supported_nodes(bundles, reads, 4))
    assert len(gone) == len(written) - 1 > 0
