"""Alignments of many pairs at a time, and pairs that share a window, against those one by one."""

import random

import numpy as np
import pytest

from strandloom.operators import align as AL
from strandloom.operators import packed


@pytest.mark.parametrize("costs", [{}, {"match": 1, "mismatch": -1, "gap_open": 2, "gap_extend": 2}, {"match": 90, "mismatch": -200, "gap_open": 150, "gap_extend": 3}, {"gap_open": 1, "gap_extend": 1}])
def test_lots_are_alignments_one_by_one(costs):
    r = random.Random(7)
    text = lambda: "".join(r.choices("ACGT", k=r.choice((0, 1, 2, 9, 9, 9, 23))))
    a = [text() for _ in range(300)]
    b = [text() if r.random() < 0.5 else x[r.randrange(3) :] + text() for x in a]
    found = AL.align_all(a, b, **costs)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        assert found[:, i].tolist() == [AL.align(x, y, **costs)[k] for k in AL.OUT], (x, y)


def test_small_lots_and_large_numbers(monkeypatch):
    monkeypatch.setattr(AL, "CELLS", 5000)
    a, b = ["ACGT" * 30, "ACGTT" * 9, "ACGT" * 30], ["ACGT" * 28, "AGT" * 9, "TTTT" * 28]
    assert np.array_equal(AL.align_all(a, b, match=100), np.array([[AL.align(x, y, match=100)[k] for x, y in zip(a, b, strict=True)] for k in AL.OUT]))


def test_pairs_that_share_a_window(spark, monkeypatch):
    r = random.Random(2)
    base = ["".join(r.choices("ACGT", k=90)) for _ in range(4)]
    rows = [(i, (g := r.choice(base))[(at := r.randrange(50)) : at + r.choice((5, 16, 30, 40))]) for i in range(80)]
    rows += [(100, base[0][:10] + "N" + base[0][10:30]), (101, base[0][4:10] + "N" + base[0][10:20]), (102, None), (103, "A" * 60), (104, "A" * 30), (None, base[0])]
    windows = {i: {s[p : p + 16] for p in range(len(s) - 15)} for i, s in rows if s and i is not None}
    want = {(a, b) for a in windows for b in windows if a < b and windows[a] & windows[b]}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    monkeypatch.setattr(packed, "PIECE", 200)
    try:
        found = [tuple(x) for x in packed.sharing(spark.createDataFrame(rows, "id long, seq string").repartition(3), "id", 16).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(found) == want and len(found) == len(want) and (100, 101) in want
