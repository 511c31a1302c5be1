"""Forms of expression operators that spread one comparison or one grid over tasks, against plain Python."""

import math
import random

import pytest

from strandloom.operators import expression


def test_adjusted_in_blocks(spark):
    r = random.Random(3)
    rows = [(f, c, r.choice([0.0, 0.01, 0.2, r.random(), 1.0])) for c in ("x", "y") for f in range(40)]
    want = {}
    for c in ("x", "y"):
        order = sorted((p, f) for f, k, p in rows if k == c)
        least = 1.0
        for rank in range(len(order), 0, -1):
            p, f = order[rank - 1]
            least = min(least, p * len(order) / rank)
            want[f, c] = least
    df = spark.createDataFrame(rows, "feature long, comparison string, p double").repartition(3)
    for size in (1, 3, 7, 100_000):
        got = expression.adjusted(df, size=size)
        assert got.columns == ["feature", "comparison", "p", "fdr"]
        assert {(x.feature, x.comparison): x.fdr for x in got.collect()} == pytest.approx(want)
    assert expression.adjusted(df.limit(0)).count() == 0


def test_noise_probability_is_exact_to_a_cell(spark):
    r = random.Random(6)
    samples = {"a1": "a", "a2": "a", "b1": "b", "b2": "b", "b3": "b"}
    counts = {(f, s): r.randrange(1, 400) for f in range(30) for s in samples}
    df = spark.createDataFrame([(f, s, n) for (f, s), n in counts.items()], "feature long, sample string, cnt long")
    groups = spark.createDataFrame(list(samples.items()), "sample string, grp string")
    total = {s: sum(n for (_, t), n in counts.items() if t == s) for s in samples}
    rate = {k: n / total[k[1]] * 1e6 for k, n in counts.items()}
    cell = lambda x: math.floor(math.log2(x + 1) * 64)
    noise = [(cell(abs(math.log2(rate[f, s] / rate[f, t]))), cell(abs(rate[f, s] - rate[f, t]))) for f in range(30) for s in samples for t in samples if s < t and samples[s] == samples[t]]
    for x in expression.noise_probability(df, groups).collect():
        i, j = cell(abs(x.m)), cell(x.d)
        assert x.prob == pytest.approx(sum(a < i and b < j for a, b in noise) / len(noise))


def test_middle_keeps_the_ranks_between(spark):
    r = random.Random(2)
    rows = [(s, f, float(r.randrange(12))) for s, n in (("x", 50), ("y", 7), ("z", 1)) for f in range(n)]
    df = spark.createDataFrame(rows, "sample string, feature long, m double").repartition(3)
    for trim in (0.0, 0.05, 0.3):
        bounds = {x.sample: (x.m_low, x.m_high) for x in expression.middle(df, "m", trim).collect()}
        for s in "xyz":
            values = sorted(v for t, _, v in rows if t == s)
            off = math.floor(len(values) * trim)
            want = [v for v in values if off + 1 <= values.index(v) + 1 <= len(values) - off]
            low, high = bounds[s]
            assert [v for v in values if (low is None or v > low) and v <= high] == want
    assert expression.middle(df.limit(0), "m", 0.3).count() == 0
