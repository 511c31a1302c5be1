"""Exploded rows aren't broadcast by the size of what they were exploded from."""

import os
import random
import time
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandloom.operators import clustering, coding, contigs, coverage, packed, reach, strands
from strandloom.operators import kmers as K
from strandloom.plans import catalog, kmer_queries, views

SF = "/root/testdata/sf0.001"


def grown_broadcasts(node) -> list[str]:
    """Broadcast sides of a plan's joins that hold windows or places."""
    sides = [node.children().apply(i) for i in range(node.children().size())]
    found = [x for side in sides for x in grown_broadcasts(side)]
    if node.nodeName() == "BroadcastHashJoin":
        text = sides[0 if "Left" in node.buildSide().toString() else 1].toString()
        if "Generate explode(sequence" in text or "MapInArrow" in text:
            found.append(text)
    return found


@pytest.mark.parametrize(
    "name",
    ["k22_positions", "j01_shared_kmer_pairs", "k30_shared_pairs", "k23_within_one_mismatch", "w08_sliding_jaccard", "w09_troughs", "j02_label_reads", "a04_assign_reads", "a05_fragment_total", "a01_weld_support", "a02_weld_decision", "p02_roots"],
)
def test_no_window_is_broadcast(spark, name):
    assert not grown_broadcasts(catalog.queries()[name](spark, SF)._jdf.queryExecution().sparkPlan())


def test_tiers_of_a_deep_gene(spark):
    """Hits are not compared with all that were placed before them."""
    hits = spark.range(20_000).select(F.lit(1).cast("long").alias("gene"), F.col("id").alias("hit"), (F.col("id") * 173 % 20_000 + 1).alias("lend"), (F.col("id") * 173 % 20_000 + 50 + F.col("id") % 50 * 20).alias("rend"), (F.col("id") * 7 % 101).alias("score"))
    began = time.monotonic()
    assert coding.tiers(hits).agg(F.max("tier")).first()[0] > 300
    assert time.monotonic() - began < 30


def test_narrow_tables_are_spread_out(spark, tmp_path):
    spark.range(45_000).select(F.col("id").alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size")).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    rows = views.view(spark, str(tmp_path), "transcripts")
    assert rows.rdd.getNumPartitions() == 5 and rows.count() == 45_000
    assert views.view(spark, SF, "transcripts").rdd.getNumPartitions() == 1


def test_depth_makes_a_place_once(spark):
    """Places are made of runs; no aggregate takes a row a place and interval."""
    rows = spark.createDataFrame([("s", 1, 9), ("s", 4, 6), ("s", 8, 7)], "scaff string, lend long, rend long")
    assert {x.pos: x.cov for x in coverage.depth(rows).collect()} == {p: 2 if 4 <= p <= 6 else 1 for p in range(1, 10)}
    plan = coverage.depth(rows)._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" not in plan[: plan.index("Generate explode")]


def test_neighbours_are_no_broadcast(spark):
    counts = spark.range(1 << 21).select(F.lpad(F.col("id").cast("string"), 11, "A").alias("kmer"), F.col("id").alias("cnt"))
    near = K.within_one_mismatch(counts, spark.createDataFrame([("A" * 11,)], "kmer string"), 11)
    assert "Broadcast" not in near._jdf.queryExecution().sparkPlan().toString()


def test_neighbours_within_mismatches_are_met_by_equality(spark):
    """Not by a stretch of two or three letters, which a large part of all k-mers shares."""
    words = spark.createDataFrame([("ACGTACGTACG",), ("ACGTACGTTTT",)], "kmer string")
    met = K.within_mismatches(words.withColumn("cnt", F.lit(1)), words, 11, 3)
    assert "_code" in met._jdf.queryExecution().sparkPlan().toString()
    assert {(x.kmer, x.hit): x.mismatches for x in met.collect()} == {(a.kmer, b.kmer): 0 if a == b else 3 for a in words.collect() for b in words.collect()}


def test_frames_share_their_windows(spark):
    """A window is made once a strand, not once a frame."""
    rows = spark.createDataFrame([(1, "ACGTACGTAC")], "tid long, seq string")
    scores = spark.createDataFrame([("ACGTAC", 0, 1.0), ("ACGTAC", 1, 10.0), ("GTACGT", 2, 4.0)], "kmer string, frame int, score double")
    out = coding.frame_scores(rows, scores, "tid")
    assert "Generate explode(sequence" not in out._jdf.queryExecution().sparkPlan().toString()
    assert {x.frame: x.score for x in out.collect()} == {1: 15.0, 2: 1.0, 5: 10.0, 6: 5.0}


def test_welds_are_made_once(spark, monkeypatch):
    """Candidates and edges that several steps read are written once and read again."""
    contigs = spark.createDataFrame([(1, "ACGTTGCAACGT"), (2, "TTACGTTGCAAC")], "contig long, seq string")
    assert "Scan parquet" in clustering.weldmers(contigs, 4, 2)._jdf.queryExecution().sparkPlan().toString()
    written, own = [], clustering.cut
    monkeypatch.setattr(clustering, "cut", lambda df: written.append(df.columns) or own(df))
    groups = clustering.bounded_groups(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long"), 5)
    assert written[0] == ["a", "b"] and {tuple(x) for x in groups.collect()} == {(1, 1), (2, 1), (3, 1)}


@pytest.mark.parametrize("beside", [K.successors, K.predecessors])
def test_counted_kmers_are_no_broadcast(spark, beside):
    counts = kmer_queries.read_counts(spark, SF)
    assert not grown_broadcasts(beside(counts)._jdf.queryExecution().sparkPlan())


def test_unitig_links_are_one_aggregate(spark):
    """Successors, and how many there are, come from groups of overlaps, not from joins."""
    rows = [("ACGT", 5), ("CGTA", 2), ("CGTC", 1), ("GTCC", 1), ("TCCA", 1), ("TTTT", 3), ("CCAG", 0), ("TTTG", 1)]
    links = contigs.unitig_links(spark.createDataFrame(rows, "kmer string, cnt long"))
    assert "Join" not in links._jdf.queryExecution().sparkPlan().toString()
    assert {tuple(x) for x in links.collect()} == {("CGTC", "GTCC"), ("GTCC", "TCCA")}


def test_neighbouring_edges_are_joined_up_in_their_task(spark, monkeypatch):
    """Rounds over all tasks see only what several tasks share, and nothing where none do."""
    seen, own = [], clustering._starred
    monkeypatch.setattr(clustering, "_starred", lambda df: seen.append(df.count()) or own(df))
    edges = spark.range(0, 3000, 1, 1).where("id % 10 != 9").select("id", (F.col("id") + 1).alias("b")).withColumnRenamed("id", "a")
    assert {x.node: x.component for x in clustering.components(edges).collect()} == {i: i - i % 10 for i in range(3000)}
    assert not seen
    apart = spark.range(0, 3000, 1, 7).where("id != 2000").select("id", (F.col("id") + 1).alias("b")).withColumnRenamed("id", "a")
    assert {x.node: x.component for x in clustering.components(apart).collect()} == {i: 0 if i <= 2000 else 2001 for i in range(3001)}
    assert seen[0] < 20
    odd = spark.createDataFrame([(3, None), (4, 4), (None, 5), (6, 7)], "a long, b long")
    assert {tuple(x) for x in clustering.components(odd).collect()} == {(3, 3), (4, 4), (5, 5), (6, 6), (7, 6), (None, None)}


def test_chains_follow_stretches_in_their_tasks(spark, monkeypatch):
    """Chains and circles that lie in several tasks; only circles are gone round over all k-mers."""
    r, k, words = random.Random(5), 12, {}
    for n in (60, 200, 35):
        line = "".join(r.choice("ACGT") for _ in range(n + k - 1))
        words |= {line[i : i + k]: (line[:k], i) for i in range(n)}
    ring = "".join(r.choice("ACGT") for _ in range(50))
    round_ = [(ring * 2)[i : i + k] for i in range(50)]
    least = round_.index(min(round_))
    circle = {w: (min(round_), (i - least) % 50) for i, w in enumerate(round_)}
    rounds, own = [], contigs._circles
    monkeypatch.setattr(contigs, "_circles", lambda members, links: rounds.append(members.count()) or own(members, links))
    of = lambda w: {x.kmer: (x.head, x.steps) for x in contigs.chains(spark.createDataFrame([(x, 2) for x in w], "kmer string, cnt long")).collect()}
    assert of(words) == words and not rounds
    assert of(words | circle) == words | circle and rounds == [50]


def test_edges_of_both_strands_are_made_once(spark, monkeypatch):
    written, own = [], strands.cut
    monkeypatch.setattr(strands, "cut", lambda df: written.append(df.columns) or own(df))
    edges = spark.createDataFrame([(1, "AAC", "ACG", 2), (1, "CGT", "GTT", 2)], "component long, src string, dst string, w long")
    assert [tuple(x) for x in strands.one_strand(edges).collect()] == [(1, "AAC", "ACG", 2)]
    assert written[0] == ["component", "src", "dst", "w", "rsrc", "rdst"] and not any("w" in x for x in written[1:])


def test_counting_takes_bounded_memory():
    """However long a batch is, a task holds the windows of a small piece of it at a time."""
    batch = pa.RecordBatch.from_arrays([pa.array(["ACGTTGCAAC" * 400] * 1000)], ["seq"])
    tracemalloc.start()
    assert sum(len(packed.windows_of(x.column(0), 25, False)[2]) for x in packed.pieces(iter([batch]), 0, 25)) == 1000 * 3976
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


def test_only_changed_labels_go_on(spark, monkeypatch):
    """A round's table takes the place of the one before, on the disk too."""
    kept, own = [], reach.cut
    monkeypatch.setattr(reach, "cut", lambda df: kept.append(own(df)) or kept[-1])
    edges = spark.createDataFrame([(1, f"n{i:02}", f"n{i + 1:02}") for i in range(6)], "component long, src string, dst string")
    got = {x.node: (x.o0, x.i0) for x in reach.labels(edges).collect()}
    least = {x.node: x.h for x in edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct().withColumn("h", F.xxhash64(F.lit(0), "node")).collect()}
    nodes = sorted(least)
    assert got == {n: (min(least[x] for x in nodes[i:]), min(least[x] for x in nodes[: i + 1])) for i, n in enumerate(nodes)}
    assert [os.path.exists(x._cut.removeprefix("file://")) for x in kept] == [True] + [False] * (len(kept) - 2) + [True]
    assert kept[-1].where("_out OR _into").isEmpty() and not kept[1]._cut == kept[-1]._cut
