"""Paths between pairs of nodes, and k-mers within mismatches, against plain Python."""

import random

from strandloom.operators import kmers as K
from strandloom.operators import reach


def closure(edges):
    out = {}
    for c, a, b in edges:
        out.setdefault((c, a), set()).add(b)
    for c, a in list(out):
        seen, todo = set(), [a]
        while todo:
            for n in out.get((c, todo.pop()), ()):
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        yield from ((c, a, b) for b in seen)


def test_pairs_of_random_graphs(spark):
    r = random.Random(1)
    edges = [(c, f"n{r.randrange(30)}", f"n{r.randrange(30)}") for c in range(6) for _ in range(12 + 8 * c)]  # from sparse to with circles and loops
    edges += [(9, f"c{k}", f"c{k + 1}") for k in range(12)] + edges[:5]
    pairs = [(c, f"n{a}", f"n{b}") for c in range(6) for a in range(0, 30, 2) for b in range(30)] + [(9, "c0", "c12"), (9, "c12", "c0"), (9, "c3", "c3"), (7, "x", "y"), (1, "n1", "gone"), (1, None, "n1")]
    want = set(closure(edges))
    got = {tuple(x)[:3]: x for x in reach.reaches(spark.createDataFrame(edges, "component long, src string, dst string"), spark.createDataFrame(pairs * 2, "component long, a string, b string")).collect()}
    assert set(got) == set(pairs) and {p for p, x in got.items() if x.reaches} == want & set(pairs)
    assert not any(x.reaches and x.by_label for x in got.values())
    refuted = sum(x.by_label for x in got.values())
    assert refuted > 0.8 * sum(not x.reaches for x in got.values())  # labels alone tell most


def test_no_edges(spark):
    none = spark.createDataFrame([], "component long, src string, dst string")
    assert [x.reaches for x in reach.reaches(none, spark.createDataFrame([(1, "a", "b")], "component long, a string, b string")).collect()] == [False]


def test_kmers_within_mismatches(spark):
    r = random.Random(2)
    words = ["".join(r.choices("ACGTN", weights=[6, 3, 3, 3, 1], k=9)) for _ in range(150)]
    counts = spark.createDataFrame([(w, i + 1) for i, w in enumerate(dict.fromkeys(words))] + [("ACG", 1)], "kmer string, cnt long")
    wanted = spark.createDataFrame([(w,) for w in words[:40] * 2 + ["AAAAAAAAA", "short"]], "kmer string")
    for most in (0, 1, 3):
        got = sorted(map(tuple, K.within_mismatches(counts, wanted, 9, most).collect()))
        far = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))
        assert got == sorted((a, b, i + 1, far(a, b)) for a in {*words[:40], "AAAAAAAAA"} for i, b in enumerate(dict.fromkeys(words)) if far(a, b) <= most)
