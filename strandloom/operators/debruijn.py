"""De Bruijn graphs as edge tables (component, src, dst, w), and their clean-up.

Every operation is a join or window over edges. Fixpoints repeat it with checkpoints until nothing changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions import seq as S
from strandloom.operators import kmers as K
from strandloom.operators import packed
from strandloom.operators.lineage import cut, dropped


def build(bundles: DataFrame, k: int, both_strands: bool = False, coded: bool = False) -> DataFrame:
    """(component, src, dst, w) between neighbouring k-mers (P01), or (component, code, word) of an edge's k + 1 letters if coded. A bundle's sequence is parted at X; other letters become A; regions
    shorter than k give nothing."""
    parts = bundles.select("component", F.explode(F.split("seq", "X")).alias("seq")).select("component", S.replace_other(F.col("seq")).alias("seq"))
    if both_strands:
        parts = parts.unionByName(parts.select("component", S.revcomp(F.col("seq")).alias("seq")))
    if coded:
        return K.count_in(parts, k + 1, by=("component",), decode=False).select("component", "code", "word")
    wide = K.count_in(parts, k + 1, by=("component",))
    return wide.select("component", F.substring("kmer", 1, k).alias("src"), F.expr(f"substring(kmer, 2, {k})").alias("dst"), F.col("cnt").alias("w")).hint("merge")  # edges outgrow what Spark expects of bundles


def roots(edges: DataFrame) -> DataFrame:
    """(component, node) without predecessors."""
    return edges.select("component", F.col("src").alias("node")).distinct().join(edges.select("component", F.col("dst").alias("node")), ["component", "node"], "left_anti")


def leaves(edges: DataFrame) -> DataFrame:
    return edges.select("component", F.col("dst").alias("node")).distinct().join(edges.select("component", F.col("src").alias("node")), ["component", "node"], "left_anti")


def edge_support(edges: DataFrame, reads: DataFrame, k: int, both_strands: bool = False) -> DataFrame:
    """Edges with how often reads hold them, w (J19, A06); of both strands together if asked. An edge is met as the number of its k + 1 letters, where those can be packed, and its letters are made after that."""
    kmer = F.concat("src", F.expr("substring(dst, -1, 1)"))
    if both_strands or k + 1 > packed.MOST:
        seen = K.count_in(reads, k + 1)
        seen = (K.both_strands(seen) if both_strands else seen).withColumnRenamed("cnt", "_w")
        rows = edges.withColumn("kmer", kmer).drop("w").join(seen, "kmer", "left")
    else:
        seen = K.count_in(reads, k + 1, decode=False).withColumnRenamed("cnt", "_w")
        told = F.coalesce((F.length("src") == k) & (F.col("dst") == F.concat(F.expr("substring(src, 2)"), F.expr("substring(dst, -1, 1)"))), F.lit(False))  # src and dst follow from the k-mer
        rows = edges.select("component", kmer.alias("kmer"), *(F.when(~told, F.col(c)).alias(f"_{c}") for c in ("src", "dst")), told.alias("_told"))
        rows = rows.select("component", *packed.encoded("kmer", k + 1), "_src", "_dst", "_told").hint("merge").join(seen, ["code", "word"], "left")
        at = lambda c, first: F.when(F.col("_told"), F.substring("kmer", first, k)).otherwise(F.col(f"_{c}")).alias(c)
        rows = packed.decoded(rows, k + 1).select("component", at("src", 1), at("dst", 2), "_w").hint("merge")
    return rows.select("component", "src", "dst", F.coalesce("_w", F.lit(0)).alias("w"))


def supported_nodes(bundles: DataFrame, reads: DataFrame, k: int) -> DataFrame:
    """(component, src, dst, w): the edges of ``build`` with their support, as ``edge_support`` has it, where a node is its code and word. What joins and groups nodes takes them so; ``named`` gives their letters
    at the end. No letters of nodes are made, sorted or shuffled before that, and edges are dealt by component
    while they are one number each, so grouping them by component and node shuffles nothing more; a component's edges are one task's, in sorted runs."""
    if k + 1 > packed.MOST:
        raise ValueError(f"k must be up to {packed.MOST - 1}")
    seen = K.count_in(reads, k + 1, decode=False).withColumnRenamed("cnt", "_w")
    rows = build(bundles, k, coded=True).hint("merge").join(seen, ["code", "word"], "left").select("component", "code", "word", "_w").repartition("component")
    node = lambda part: F.struct(part[0].alias("code"), part[1].alias("word"))
    return rows.select("component", node(packed.without_last(k + 1)).alias("src"), node(packed.without_first(k + 1)).alias("dst"), F.coalesce("_w", F.lit(0)).alias("w")).hint("merge")


def named(rows: DataFrame, k: int, *nodes: str) -> DataFrame:
    """rows with the letters of nodes of k letters in place of their codes and words."""
    letters = lambda c: F.when(F.col(f"{c}.code") >= 0, packed.letters(F.col(f"{c}.code"), k)).otherwise(F.col(f"{c}.word"))
    return rows.select(*[letters(c).alias(c) if c in nodes else F.col(c) for c in rows.columns])


def flows(edges: DataFrame) -> DataFrame:
    """(component, node, inflow, outflow, indeg, outdeg) (A07). Edges are made once and give a row an end."""
    w, no, one, zero = F.col("w"), F.lit(0).cast(edges.schema["w"].dataType), F.lit(1), F.lit(0)
    end = lambda node, i, o, d, e: F.struct(F.col(node).alias("node"), i.alias("i"), o.alias("o"), d.alias("d"), e.alias("e"))
    ends = edges.select("component", F.inline(F.array(end("dst", w, no, one, zero), end("src", no, w, zero, one))))
    return ends.groupBy("component", "node").agg(F.sum("i").alias("inflow"), F.sum("o").alias("outflow"), F.sum("d").alias("indeg"), F.sum("e").alias("outdeg"))


def with_flows(edges: DataFrame) -> DataFrame:
    """(component, src, dst, w) with what enters and leaves either end: s_in, s_out, s_deg_in, s_n_out of src, and the same with d_ of dst. An edge is a row of each of its ends, which windows sum, and one row again after
    that: where edges are dealt by component nothing is shuffled, while joins with flows shuffle edges and nodes twice. Edges without a component or an end have no flows."""
    names = ("in", "out", "deg_in", "n_out")
    w, no, one, zero = F.col("w"), F.lit(0).cast(edges.schema["w"].dataType), F.lit(1), F.lit(0)
    end = lambda node, is_src, *x: F.struct(F.col(node).alias("_node"), F.lit(is_src).alias("_is"), *[c.alias(f"_{n}") for n, c in zip(names, x, strict=True)])
    rows = edges.select("component", "src", "dst", "w").dropna(subset=["component", "src", "dst"]).withColumn("_id", F.monotonically_increasing_id())
    ends = rows.select("component", "src", "dst", "w", "_id", F.inline(F.array(end("dst", False, w, no, one, zero), end("src", True, no, w, zero, one))))
    node = Window.partitionBy("component", "_node")
    ends = ends.select("component", "src", "dst", "w", "_id", "_is", *[F.sum(f"_{n}").over(node).alias(f"_{n}") for n in names])
    told = [F.max(F.when(F.col("_is") == is_src, F.col(f"_{n}"))).alias(f"{e}_{n}") for e, is_src in (("s", True), ("d", False)) for n in names]
    return ends.groupBy("component", "_id", "src", "dst", "w").agg(*told).drop("_id")


def prune_once(edges: DataFrame, edge_ratio: float = 0.05, flow_ratio: float = 0.02, nodes: DataFrame | None = None) -> DataFrame:
    """Without edges that are weak beside the others of their ends (P08): at most edge_ratio of what enters dst or leaves src, where that is
    more than one edge; or less than flow_ratio of what enters src, of what leaves dst, or of the average weight of either. nodes (component, node, avg) has those averages;
    without it, a node's is the mean of what enters and what leaves it, of one side alone at a root or leaf."""
    mean = lambda e: (F.col(f"{e}_in") + F.col(f"{e}_out")) / F.when((F.col(f"{e}_deg_in") > 0) & (F.col(f"{e}_n_out") > 0), 2).otherwise(1)
    rows = with_flows(edges)
    if nodes is None:
        rows = rows.withColumn("s_avg", mean("s")).withColumn("d_avg", mean("d"))
    else:
        for e, end in (("s", "src"), ("d", "dst")):
            rows = rows.join(nodes.select("component", F.col("node").alias(end), F.col("avg").alias(f"{e}_avg")), ["component", end], "left")
    rows = rows.withColumnRenamed("s_n_out", "s_n").withColumnRenamed("d_deg_in", "d_n")
    w = F.col("w")
    weak = ((F.col("d_n") > 1) & (w <= edge_ratio * F.col("d_in"))) | ((F.col("s_n") > 1) & (w <= edge_ratio * F.col("s_out"))) | (w < flow_ratio * F.col("s_in")) | (w < flow_ratio * F.col("d_out"))
    weak = weak | F.coalesce(w < flow_ratio * F.greatest("s_avg", "d_avg"), F.lit(False))
    return rows.where(~weak).select("component", "src", "dst", "w")


def prune(edges: DataFrame, **ratios) -> DataFrame:
    """prune_once until nothing goes."""
    now = edges.transform(cut)
    n, before = now.count(), -1
    while n != before:
        old, now, before = now, prune_once(now.repartition("component"), **ratios).transform(cut), n
        dropped(old)  # what a round has read goes when its result stands
        n = now.count()
    return now


def damp(edges: DataFrame, factor: int = 200) -> DataFrame:
    """Extreme weights lowered (P09): more than ``factor`` times both the flow into src and the flow out of dst becomes the larger of those two flows times factor."""
    rows = with_flows(edges)
    most = F.greatest(F.col("s_in"), F.col("d_out")) * factor
    extreme = (F.col("s_in") > 0) & (F.col("d_out") > 0) & (F.col("w") > most)
    return rows.select("component", "src", "dst", F.when(extreme, most).otherwise(F.col("w")).alias("w"))


def compactable(edges: DataFrame) -> DataFrame:
    """(component, src, dst) of edges whose ends can be merged: the only one out of src and into dst (P10)."""
    return with_flows(edges).where("s_n_out = 1 AND d_deg_in = 1 AND src != dst").select("component", "src", "dst")


def bubbles(edges: DataFrame) -> DataFrame:
    """(component, start, a, b, stop, keep, w) of pairs of one-way detours between two nodes (P12): the heavier one is kept, on a tie b; weights add up."""
    f = flows(edges).where("indeg = 1 AND outdeg = 1").select("component", F.col("node").alias("mid"))
    into = edges.select("component", F.col("src").alias("start"), F.col("dst").alias("mid"), F.col("w").alias("w1"))
    out = edges.select("component", F.col("src").alias("mid"), F.col("dst").alias("stop"), F.col("w").alias("w2"))
    paths = into.join(f, ["component", "mid"], "left_semi").join(out, ["component", "mid"]).select("component", "start", "stop", "mid", (F.col("w1") + F.col("w2")).alias("w"))
    a, b = (paths.select("component", "start", "stop", F.col("mid").alias(m), F.col("w").alias(f"w_{m}")) for m in ("a", "b"))
    pairs = a.join(b, ["component", "start", "stop"]).where("a < b")
    return pairs.select("component", "start", "a", "b", "stop", F.when(F.col("w_a") > F.col("w_b"), F.col("a")).otherwise(F.col("b")).alias("keep"), (F.col("w_a") + F.col("w_b")).alias("w"))


def collapse_bubbles(edges: DataFrame, letters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, nodes) after single-letter bubbles are collapsed (P12). Ways from one node to another over one node of a single letter, which has no other edges, become one: the
    heaviest stays (on a tie the one with the larger name) with the weights of all, and the nodes (component, node, seq, code, merged) say for each that stayed its letter, the ambiguity code of all letters, and how
    many ways it stands for. letters: (component, node, seq). A bubble of any number of ways is one group of an aggregate; ways needn't be paired."""
    single = letters.where(F.length("seq") == 1).select("component", F.col("node").alias("mid"), "seq")
    mids = flows(edges).where("indeg = 1 AND outdeg = 1").select("component", F.col("node").alias("mid")).join(single, ["component", "mid"])
    into = edges.select("component", F.col("src").alias("start"), F.col("dst").alias("mid"), F.col("w").alias("w1"))
    out = edges.select("component", F.col("src").alias("mid"), F.col("dst").alias("stop"), F.col("w").alias("w2"))
    ways = mids.join(into, ["component", "mid"]).join(out, ["component", "mid"])
    rank = F.struct(F.col("w1") + F.col("w2"), "mid")
    kept = ways.groupBy("component", "start", "stop").agg(
        F.count(F.lit(1)).alias("merged"), F.max_by("mid", rank).alias("keep"), F.max_by("seq", rank).alias("seq"), F.sum("w1").alias("w1"), F.sum("w2").alias("w2"), S.iupac_code(F.collect_set("seq")).alias("code"),
    ).where("merged > 1").transform(cut)
    gone = ways.join(kept.select("component", "start", "stop"), ["component", "start", "stop"], "left_semi").select("component", "mid")
    rest = edges.join(gone.withColumnRenamed("mid", "dst"), ["component", "dst"], "left_anti").join(gone.withColumnRenamed("mid", "src"), ["component", "src"], "left_anti")
    new = kept.select("component", F.explode(F.array(F.struct(F.col("start").alias("src"), F.col("keep").alias("dst"), F.col("w1").alias("w")), F.struct(F.col("keep").alias("src"), F.col("stop").alias("dst"), F.col("w2").alias("w")))).alias("e"))
    return rest.select("component", "src", "dst", "w").unionByName(new.select("component", "e.*")), kept.select("component", F.col("keep").alias("node"), "seq", "code", "merged")


def heaviest_paths(edges: DataFrame, counts: DataFrame) -> DataFrame:
    """(component, through, path, total): of each component the path with the largest sum of node counts among those through its most frequent node, ties by smaller names (P25). counts:
    (component, node, cnt). What is best from a node on, and up to it, settles layer by layer, a join and an aggregate each, for all components at once; paths are
    put together from the best next steps at the end. Circles are no part of it: edges that lie on or behind one are left out."""
    place = layers(edges).select("component", "node")
    end = lambda c: place.withColumnRenamed("node", c)
    links = edges.join(end("src"), ["component", "src"]).join(end("dst"), ["component", "dst"]).select("component", "src", "dst").distinct().transform(cut)
    nodes = counts.select("component", "node", F.col("cnt").cast("long").alias("cnt")).transform(cut)
    top = nodes.groupBy("component").agg(F.min_by("node", F.struct(-F.col("cnt"), "node")).alias("through"))

    def best(a: str, b: str) -> DataFrame:
        """(component, node, step, total): the next node from a node on along edges from a to b, null at the end, and the sum from there on."""
        steps = links.select("component", F.col(a).alias("node"), F.col(b).alias("step"))
        now = nodes.select("component", "node", F.lit(None).cast("string").alias("step"), F.lit(0).cast("long").alias("ahead"), "cnt").transform(cut)
        seen = None
        while (state := tuple(now.agg(F.sum("ahead"), F.count("step")).first())) != seen:
            seen = state
            far = steps.join(now.select("component", F.col("node").alias("step"), (F.col("ahead") + F.col("cnt")).alias("ahead")), ["component", "step"])
            chosen = far.groupBy("component", "node").agg(F.min(F.struct((-F.col("ahead")).alias("less"), "step")).alias("b"))
            now = nodes.join(chosen, ["component", "node"], "left").select("component", "node", F.col("b.step").alias("step"), F.coalesce(-F.col("b.less"), F.lit(0)).alias("ahead"), "cnt").transform(cut)
        return now.select("component", "node", "step", (F.col("ahead") + F.col("cnt")).alias("total"))

    def followed(steps: DataFrame) -> DataFrame:
        """(component, nodes, total) from each component's most frequent node on."""
        now = top.select("component", F.array("through").alias("nodes"), F.col("through").alias("node"), F.lit(True).alias("on")).transform(cut)
        go = steps.select("component", "node", "step")
        while not now.where("on").isEmpty():
            ahead = now.join(go, ["component", "node"], "left")
            now = ahead.select("component", F.when(F.col("step").isNotNull(), F.array_append("nodes", F.col("step"))).otherwise(F.col("nodes")).alias("nodes"), F.coalesce("step", "node").alias("node"), F.col("step").isNotNull().alias("on")).transform(cut)
        totals = steps.select("component", F.col("node").alias("through"), "total")
        return now.select("component", "nodes", F.element_at("nodes", 1).alias("through")).join(totals, ["component", "through"])

    on, back = followed(best("src", "dst")), followed(best("dst", "src")).select("component", F.reverse("nodes").alias("before"), F.col("total").alias("other"))
    own = nodes.select("component", F.col("node").alias("through"), "cnt")
    both = on.join(back, "component").join(own, ["component", "through"])
    path = F.concat(F.slice("before", F.lit(1), F.size("before") - 1), "nodes")
    return both.select("component", "through", path.alias("path"), (F.col("total") + F.col("other") - F.col("cnt")).alias("total"))


def with_ends(edges: DataFrame, source: str = "S", sink: str = "T") -> DataFrame:
    """Edges from a source to all roots and from all leaves to a sink, weight 1."""
    s = roots(edges).select("component", F.lit(source).alias("src"), F.col("node").alias("dst"), F.lit(1).cast("long").alias("w"))
    t = leaves(edges).select("component", F.col("node").alias("src"), F.lit(sink).alias("dst"), F.lit(1).cast("long").alias("w"))
    return edges.unionByName(s).unionByName(t)


def layers(edges: DataFrame) -> DataFrame:
    """(component, node, layer): the longest way from a root, by peeling (P15). Nodes on or behind circles have none. A round is one join; there are as many as layers."""
    left = edges.select("component", "src", "dst").distinct().transform(cut)
    nodes = left.select("component", F.col("src").alias("node")).union(left.select("component", "dst")).distinct().transform(cut)
    out, k = None, 0
    while True:
        now = nodes.join(left.select("component", F.col("dst").alias("node")), ["component", "node"], "left_anti").withColumn("layer", F.lit(k)).transform(cut)
        if now.isEmpty():
            break
        out = now if out is None else out.unionByName(now)
        nodes = nodes.join(now, ["component", "node"], "left_anti").transform(cut)
        left = left.join(now.select("component", F.col("node").alias("src")), ["component", "src"], "left_anti").transform(cut)
        k += 1
    return nodes.withColumn("layer", F.lit(None).cast("int")).limit(0) if out is None else out


def reachable(edges: DataFrame) -> DataFrame:
    """(component, a, b, dist): the fewest edges from a to b (P16), by doubling; pairs, so for one component's graph at a time."""
    now = edges.select("component", F.col("src").alias("a"), F.col("dst").alias("b"), F.lit(1).alias("dist")).distinct().transform(cut)
    seen = (-1, -1)
    while True:
        step = now.select("component", F.col("a").alias("m"), "b", F.col("dist").alias("d2"))
        more = now.select("component", "a", F.col("b").alias("m"), F.col("dist").alias("d1")).join(step, ["component", "m"]).where("a != b").select("component", "a", "b", (F.col("d1") + F.col("d2")).alias("dist"))
        now = now.unionByName(more).groupBy("component", "a", "b").agg(F.min("dist").alias("dist")).transform(cut)
        state = tuple(now.agg(F.count(F.lit(1)), F.sum("dist")).first())
        if state == seen:
            return now
        seen = state


def triplets(read_paths: DataFrame) -> DataFrame:
    """(component, before, node, after, cnt) seen in reads (P21). read_paths: component, path array."""
    rows = read_paths.where(F.size("path") >= 3).select("component", "path", F.explode(F.sequence(F.lit(1), F.size("path") - 2)).alias("i"))
    at = lambda k: F.element_at("path", F.col("i") + k)
    return rows.select("component", at(0).alias("before"), at(1).alias("node"), at(2).alias("after")).groupBy("component", "before", "node", "after").agg(F.count(F.lit(1)).alias("cnt"))


def allowed_steps(edges: DataFrame, seen: DataFrame) -> DataFrame:
    """(component, before, node, after): steps that reads allow (P21): only seen ones at nodes with any triplet, all elsewhere."""
    a = edges.select("component", F.col("src").alias("before"), F.col("dst").alias("node"))
    b = edges.select("component", F.col("src").alias("node"), F.col("dst").alias("after"))
    every = a.join(b, ["component", "node"])
    locked = seen.select("component", "node").distinct()
    return every.join(locked, ["component", "node"], "left_anti").select("component", "before", "node", "after").unionByName(every.join(seen.select("component", "before", "node", "after"), ["component", "before", "node", "after"], "left_semi").select("component", "before", "node", "after"))


def crossings(edges: DataFrame, seen: DataFrame) -> DataFrame:
    """(component, node, indeg, outdeg, pairs, resolved) of nodes with several ways in and out (P24): resolved if reads pair as many ways as the larger degree."""
    x = flows(edges).where("indeg > 1 AND outdeg > 1").select("component", "node", "indeg", "outdeg")
    n = seen.groupBy("component", "node").agg(F.count(F.lit(1)).alias("pairs"))
    rows = x.join(n, ["component", "node"], "left").na.fill(0, ["pairs"])
    return rows.withColumn("resolved", (F.col("pairs") == F.greatest("indeg", "outdeg")).cast("int"))


def component_stats(edges: DataFrame, least_avg: float = 1.0) -> DataFrame:
    """(component, n, total, mean) with a mean weight of at least least_avg (A10)."""
    s = edges.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("total"))
    return s.withColumn("mean", F.round(F.col("total") / F.col("n"), 4)).where(F.col("total") / F.col("n") >= least_avg)


def read_jaccard(marks: DataFrame) -> DataFrame:
    """(a, b, ratio): reads of both nodes of an edge over reads of either (A37). marks: node, read; edges are neighbours in marks' ``next``. Reads are met by (node, read), never gathered by node."""
    has = marks.select("node", "read").distinct()
    n = has.groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
    pairs = marks.where("next IS NOT NULL").select(F.col("node").alias("a"), F.col("next").alias("b")).distinct()
    shared = pairs.join(has.select(F.col("node").alias("a"), "read"), "a").join(has.select(F.col("node").alias("b"), "read"), ["b", "read"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("_c"))
    size = lambda side: n.select(F.col("node").alias(side), F.col("_n").alias(f"_n_{side}"))
    rows = pairs.join(shared, ["a", "b"], "left").join(size("a"), "a").join(size("b"), "b")
    c = F.coalesce("_c", F.lit(0))
    return rows.select("a", "b", F.round(c / (F.col("_n_a") + F.col("_n_b") - c), 6).alias("ratio"))


def dot_lines(edges: DataFrame) -> DataFrame:
    """(component, line) of a GraphViz file."""
    return edges.select("component", F.format_string('"%s" -> "%s" [label="%d"]', "src", "dst", "w").alias("line"))
