"""Transcript paths on hand-made graphs with known transcripts, and against every path that there is."""

import random
from collections import Counter

import pytest

from strandloom.operators import debruijn, paths

K = 15


def letters(r, n):
    return "".join(r.choice("ACGT") for _ in range(n))


def edges_of(seqs, k=K):
    return sorted({(s[i : i + k], s[i + 1 : i + k + 1]) for s in seqs for i in range(len(s) - k)})


def run(spark, seqs, reads, **how):
    df = spark.createDataFrame([(1, s) for s in seqs], "component long, seq string")
    rows = [(1, *((x, None, None) if isinstance(x, str) else x)) for x in reads]
    r = spark.createDataFrame(rows, "component long, seq string, fragment string, mate int")
    return paths.transcripts(debruijn.build(df, K).select("component", "src", "dst"), r, K, **how).collect()


def pieces(s, size, step=1):
    return [s[i : i + size] for i in range(0, len(s) - size + 1, step)]


def test_shared_ends(spark):
    r = random.Random(1)
    head, a, b, tail = letters(r, 80), letters(r, 70), letters(r, 50), letters(r, 60)
    seqs = [head + a + tail, head + b + tail, letters(r, 120)]
    got = run(spark, seqs, [x for s in seqs for x in pieces(s, 60)] * 2)
    assert {g.seq for g in got} == set(seqs)
    for g in got:
        spans = [x.split(":")[1].split("-") for x in g.path.strip("[]").split(" ")]
        assert [int(spans[0][0]), int(spans[-1][1])] == [0, g.len - 1]
        assert all(int(x[1]) + 1 == int(y[0]) for x, y in zip(spans, spans[1:], strict=False))
    assert {len(g.path.split(" ")) for g in got} == {1, 3}


def test_mates_tell_which_variants_go_together(spark):
    r = random.Random(2)
    a, b, c = letters(r, 60), letters(r, 60), letters(r, 60)
    one, two = ("CATTGACCTAGGTACCATGACTTGCA", "GGCATTAACGTCCATGTTAACCGGTA"), ("TTGACCGATACCAGTTAGACCATACG", "ACCGTTTGACACCATTGGACATTACC")
    seqs = [a + one[0] + b + two[0] + c, a + one[1] + b + two[1] + c]
    mated = []
    for s in seqs:
        for i in range(40, 75, 3):
            mated += [(s[i : i + 40], f"{s[:90]}{i}", 1), (s[i + 80 : i + 130], f"{s[:90]}{i}", 2)]
    single = [x for s in seqs for x in pieces(s, 35)] * 2
    got = {g.seq for g in run(spark, seqs, single + mated * 2)}
    assert set(seqs) <= got
    alone = paths.Graph(edges_of(seqs), K)
    behind = alone.reachable()
    p, q = (paths.node_path(paths.thread_read(x, K, alone.kmers_after), alone) for x in (mated[0][0], mated[1][0]))
    assert paths.combine_mates(p, q, behind)[0][0] == p[0]


def test_tandem_repeats_are_unrolled(spark):
    r = random.Random(3)
    left, unit, right = letters(r, 50), letters(r, 30), letters(r, 50)
    for times in (1, 2, 3):
        seq = left + unit * times + right
        got = run(spark, [seq], [seq] * 3)
        assert [g.seq for g in got] == [seq], times


def test_unroll_circles_of_one_and_two():
    g = paths.Graph([], 3)
    g.letters, g.head, g.after = {0: "A", 1: "C", 2: "G"}, {0: "xx", 1: "xx", 2: "xx"}, {0: {1}, 1: {1, 2}, 2: set()}
    out = paths.unroll(g, Counter({((0, 1, 1, 1, 2), ()): 2}))
    (path, _), = out
    assert len(set(path)) == 5 and all(b in g.after[a] for a, b in zip(path, path[1:], strict=False)) and "".join(g.letters[n] for n in path) == "ACCCG"
    assert all(2 in g.after[n] for n in path[1:4]) and path[1] not in g.after[path[1]]
    g.letters, g.head, g.after = {0: "A", 1: "C", 2: "T", 3: "G"}, dict.fromkeys(range(4), "xx"), {0: {1}, 1: {2, 3}, 2: {1}, 3: set()}
    out = paths.unroll(g, Counter({((0, 1, 2, 1, 2, 1, 3), ()): 1, ((2, 1, 3), ()): 1}))
    long = next(p for p, _ in out if len(p) == 7)
    assert "".join(g.letters[n] for n in long) == "ACTCTCG" and len(set(long)) == 7 and all(b in g.after[a] for a, b in zip(long, long[1:], strict=False))
    g.after = paths.without_circles(g.after, paths.topological(g.after))
    order = paths.topological(g.after)
    assert all(order.index(a) < order.index(b) for a in g.after for b in g.after[a])


def brute_thread(seq, k, after, most):
    start = next((i for i in range(len(seq) - k + 1) if seq[i : i + k] in after), None)
    if start is None:
        return []
    best = None
    todo = [(0, (seq[start : start + k],))]
    while todo:
        bad, path = todo.pop()
        at = start + k + len(path) - 1
        steps = after[path[-1]] if at < len(seq) else []
        if not steps:
            key = (bad, -len(path), path)
            best = key if best is None or key < best else best
        todo += [(bad + (n[-1] != seq[at]), (*path, n)) for n in steps if bad + (n[-1] != seq[at]) <= most]
    return best


def test_threading_against_all_ways():
    r = random.Random(5)
    for _ in range(200):
        base = letters(r, 30)
        seqs = [base] + ["".join(r.choice("ACGT") if r.random() < 0.1 else c for c in base) for _ in range(3)]
        k = 5
        after = {}
        for a, b in edges_of(seqs, k):
            after.setdefault(a, []).append(b)
            after.setdefault(b, [])
        read = "".join(r.choice("ACGT") if r.random() < 0.08 else c for c in base[r.randrange(8) :])
        if any(x in after.get(x, []) for x in after):
            continue
        want = brute_thread(read, k, after, 5)
        got = paths.thread_read(read, k, after)
        if not want:
            assert got == []
            continue
        bad = sum(x[-1] != read[read.index(got[0]) + k + i] for i, x in enumerate(got[1:]))
        assert (bad, -len(got)) == want[:2] and all(b in after[a] for a, b in zip(got, got[1:], strict=False))


def test_threading_many_bubbles_is_quick():
    r = random.Random(6)
    parts = [letters(r, 12) for _ in range(80)]
    seqs = ["".join(p + c for p in parts) for c in "ACGT"]
    after = {}
    for a, b in edges_of(seqs, 11):
        after.setdefault(a, []).append(b)
        after.setdefault(b, [])
    read = "".join(p + r.choice("ACGT") for p in parts)
    found = paths.thread_read(read, 11, after)
    assert found[0] + "".join(x[-1] for x in found[1:]) == read


def test_pair_algebra():
    pair = ((1, 2, 3), (6, 7))
    assert paths.compatible(pair, (0, 1, 2, 3, 4)) and paths.compatible(pair, (2, 3, 5, 6)) and paths.compatible(pair, (7, 8))
    assert not paths.compatible(pair, (1, 2, 4)) and not paths.compatible(pair, (8, 9)) and not paths.compatible(pair, (0, 2, 3)) and not paths.compatible(pair, (1, 2, 3, 5, 7))
    behind = {1: {2, 3, 4, 5}, 2: {3, 4, 5}, 3: {4, 5}, 4: {5}, 5: set()}
    assert paths.combine_mates((1, 2, 3), (2, 3), behind) == ((1, 2, 3), ())
    assert paths.combine_mates((1, 2), (4, 5), behind) == ((1, 2), (4, 5)) == paths.combine_mates((4, 5), (1, 2), behind)
    assert paths.combine_mates((1, 2, 3), (3, 5), behind) == ((1, 2, 3, 5), ()) or paths.combine_mates((1, 2, 3), (3, 5), behind) == ((1, 2, 3), (3, 5))
    assert paths.combine_mates((5,), (9,), behind) is None
    letters_ = dict.fromkeys(range(10), "ACGT")
    reads = [(((1, 2, 3), ()), 2), (((2, 4), ()), 1)]
    assert paths.supported((1, 2), 3, reads, letters_, 0) and not paths.supported((1, 2), 4, reads, letters_, 0) and paths.supported((1, 2), 4, reads, letters_, 0, 1)
    assert not paths.supported((0, 2), 3, reads, letters_, 0)  # the read came from elsewhere
    assert paths.supported((1, 2), 3, reads, letters_, 100, mode="lenient")


def all_paths(after, start):
    return [[start]] if not after[start] else [[start, *p] for n in after[start] for p in all_paths(after, n)]


def test_enumeration_against_all_paths():
    r = random.Random(7)
    for _ in range(60):
        n = 9
        after = {i: {j for j in range(i + 1, min(n, i + 4)) if r.random() < 0.5} for i in range(n)}
        g = paths.Graph([], 3)
        g.letters, g.head, g.after = dict.fromkeys(range(n), "ACGT"), dict.fromkeys(range(n), "AC"), after
        roots = [i for i in range(n) if not any(i in x for x in after.values())]
        every = [tuple(p) for s in roots for p in all_paths(after, s)]
        chosen = r.sample(every, min(len(every), 3))
        found = paths.enumerate_paths(g, paths.topological(after), Counter({(p, ()): 2 for p in chosen}))
        # Fragments that are whole paths: each is found, and whatever else is found has no fragment that it could hold against a step.
        assert all(any(paths.contains(f, p) for f in found) for p in chosen)
        assert all(p in chosen or not any(paths.contains(p, c) for c in chosen) or any(c in found for c in chosen) for p in found)
        seen_edges = {e for p in found for e in zip(p, p[1:], strict=False)}
        assert seen_edges == {(a, b) for a in after for b in after[a]}  # no edge is lost
        free = paths.enumerate_paths(g, paths.topological(after), Counter({(p, ()): 2 for p in every}), lock=False)
        assert set(free) == set(every)


def spelled(edges, names):
    after, into = {n: [] for n in names}, set()
    for a, b, _ in edges:
        after[a].append(b)
        into.add(b)
    return {"".join(names[x] for x in p) for s in names if s not in into for p in all_paths(after, s)}


def test_shared_prefixes_spell_the_same():
    r = random.Random(9)
    for _ in range(200):
        n = 7
        names = {i: letters(r, r.randrange(1, 5)) for i in range(n)}
        edges = [(i, j, float(r.randrange(1, 9))) for i in range(n) for j in range(i + 1, n) if r.random() < 0.4]
        names = {i: x + "$" * (i not in {a for a, _, _ in edges}) for i, x in names.items()}  # ends are marked, as by a sink
        new, letters_ = paths.share_prefixes(edges, names)
        assert spelled(new, letters_) == spelled(edges, names)
    new, names = paths.share_prefixes([(0, 1, 3.0), (0, 2, 5.0)], {0: "A", 1: "CGT", 2: "CGA"})
    assert names == {0: "A", 1: "T", 2: "A", 3: "C", 4: "G"} and new == [(0, 3, 5.0), (3, 4, 5.0), (4, 1, 3.0), (4, 2, 5.0)]


def test_compact_prefixes(spark):
    e = spark.createDataFrame([(c, 0, n, 2.0) for c in (1, 2) for n in (1, 2)], "component long, src long, dst long, w double")
    v = spark.createDataFrame([(c, n, x) for c in (1, 2) for n, x in ((0, "A"), (1, "CT"), (2, "CG"))], "component long, node long, letters string")
    edges, nodes = paths.compact_prefixes(e, v)
    assert edges.count() == 6 and nodes.where("letters = 'C'").count() == 2


def test_break_and_join_by_pairs(spark):
    seqs = spark.createDataFrame([(1, "A" * 200), (2, "C" * 50)], "id long, seq string")
    spans = spark.createDataFrame([(1, 5, 90), (1, 10, 80), (1, 120, 190), (1, 115, 180)], "id long, lend long, rend long")
    got = [(x.id, x.part, x.lend, x.rend, len(x.seq)) for x in paths.break_by_pairs(seqs, spans, 1, 25).orderBy("id", "part").collect()]
    assert got == [(1, 1, 1, 90, 90), (1, 2, 115, 200, 86), (2, 1, 1, 50, 50)]
    links = spark.createDataFrame([(1, 2)] * 3 + [(1, 3)] * 2 + [(4, 2)] * 5 + [(3, 5)] * 2 + [(6, 6)] * 4, "a long, b long")
    assert sorted(tuple(x) for x in paths.join_by_pairs(links).collect()) == [(3, 5, 2), (4, 2, 5)]


def test_similar_pairs(spark):
    rows = spark.createDataFrame([(1, 1, "ACGTACGT"), (1, 2, "ACGTACGA"), (1, 3, "GGGGGGGG"), (2, 4, "ACGT")], "node long, id long, seq string")
    assert sorted(tuple(x) for x in paths.similar_pairs(rows).collect()) == [(1, 1, 2, 1, True), (1, 1, 3, 6, False), (1, 2, 3, 6, False)]


@pytest.mark.parametrize("mode", ["lenient", "original"])
def test_other_support_tests(spark, mode):
    r = random.Random(11)
    head, a, b = letters(r, 60), letters(r, 60), letters(r, 60)
    seqs = [head + a, head + b]
    assert {g.seq for g in run(spark, seqs, [x for s in seqs for x in pieces(s, 50)] * 2, mode=mode)} == set(seqs)


def test_circles_of_three_nodes_keep_their_copies():
    """A repeat whose unit is three nodes, one of them in two forms: each read's laps stay, and the graph has no circle left."""
    g = paths.Graph([], 3)
    names = {0: "A", 1: "C", 2: "G", 3: "T", 4: "A", 5: "G"}  # 0 before, 1 -> 2 or 5 -> 3 -> 1 again, 4 behind
    g.letters, g.head = dict(names), dict.fromkeys(names, "xx")
    g.after = {0: {1}, 1: {2, 5}, 2: {3}, 5: {3}, 3: {1, 4}, 4: set()}
    reads = [(0, 1, 2, 3, 1, 5, 3, 1, 2, 3, 4), (2, 3, 1, 5, 3, 4), (0, 1, 2, 3, 4), (5, 3, 4)]
    out = paths.unroll_longer(g, Counter({(p, ()): i + 1 for i, p in enumerate(reads)}))
    assert sorted(out.values()) == [1, 2, 3, 4] and paths.strong_parts(g.after) == []
    for (p, _), n in out.items():
        assert "".join(g.letters[x] for x in p) == "".join(names[x] for x in reads[n - 1]) and len(set(p)) == len(p)
        assert all(b in g.after[a] for a, b in zip(p, p[1:], strict=False))
    order = paths.topological(g.after)
    assert paths.without_circles(g.after, order) == g.after
    reached = set(order) - {u for us in g.after.values() for u in us}
    assert reached == {0}  # copies begin nowhere but behind others


def test_strong_parts_of_random_graphs():
    r = random.Random(8)
    for n in (5, 12, 40):
        for _ in range(30):
            after = {v: {u for u in range(n) if r.random() < 1.3 / n} for v in range(n)}
            leads = {v: {v} for v in after}
            for _ in after:
                leads = {v: set().union({v}, *(leads[u] for u in after[v]), leads[v]) for v in after}
            want = {tuple(sorted(u for u in leads[v] if v in leads[u])) for v in after}
            assert [tuple(x) for x in paths.strong_parts(after)] == sorted(x for x in want if len(x) > 1)


def test_tandem_repeats_with_variants_are_unrolled(spark):
    """Units that differ in one place make circles of several nodes: each order of forms comes back."""
    r = random.Random(13)
    left, unit, right = letters(r, 50), letters(r, 40), letters(r, 50)
    other = unit[:20] + ("A" if unit[20] != "A" else "C") + unit[21:]
    seq = left + unit + other + unit + right
    got = run(spark, [seq], [seq] * 3)
    assert seq in [g.seq for g in got]
