"""K-mers in numbers against windows cut in plain Python, and numbering of rows."""

import random
import timeit
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandloom.operators import clustering, contigs, kmers, packed, setmath
from strandloom.operators.lineage import numbered
from strandloom.plans import catalog

PAIRS = str.maketrans("ACGTNacgtn", "TGCANtgcan")


def smaller(word):
    return min(word, word.translate(PAIRS)[::-1])


def some_texts(r, n, letters):
    return [None if r.random() < 0.05 else "".join(r.choice(letters) for _ in range(r.randrange(70))) for _ in range(n)]


def test_windows_of_a_batch():
    r = random.Random(1)
    for t in range(300):
        k = r.randrange(1, 32)
        texts = some_texts(r, r.randrange(8), "ACGT" * 10 + "Nna é中")
        array = pa.array(texts, pa.string())
        if t % 3 == 0 and texts:
            array, texts = array.slice(1), texts[1:]
        for canonical in (False, True):
            row, place, code, words = packed.windows_of(array, k, canonical)
            got = [(a, b, "".join("ACGT"[c >> 2 * (k - 1 - j) & 3] for j in range(k))) for a, b, c in zip(row.tolist(), place.tolist(), code.tolist(), strict=True)] + words
            want = [(i, p, x[p : p + k]) for i, x in enumerate(texts) if x for p in range(len(x) - k + 1)]
            assert sorted(got) == sorted((i, p, smaller(w) if canonical else w) for i, p, w in want)


@pytest.mark.parametrize("k", [1, 5, 31, 40])
def test_counts(spark, k):
    r = random.Random(k)
    texts = [x for x in some_texts(r, 40, "ACGT" * 20 + "N c")] + ["ACGTA" * 12] * 3
    rows = [(i, x, "ab"[i % 2], i % 5) for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "id long, seq string, grp string, w long").repartition(3)
    for canonical in (False, True):
        want, weighted, grouped = Counter(), Counter(), Counter()
        for _, x, g, w in rows:
            for p in range(len(x or "") - k + 1):
                word = smaller(x[p : p + k]) if canonical else x[p : p + k]
                want[word] += 1
                weighted[word] += w
                grouped[g, word] += 1
        assert {x.kmer: x.cnt for x in kmers.count_in(df, k, canonical).collect()} == want
        assert {x.kmer: x.cnt for x in kmers.count_in(df, k, canonical, "w").collect()} == weighted
        assert {(x.grp, x.kmer): x.cnt for x in kmers.count_in(df, k, canonical, by=("grp",)).collect()} == grouped
        plain = {x: n for x, n in want.items() if set(x) <= set("ACGT")}
        assert {x.kmer: x.cnt for x in kmers.count_in(df, k, canonical, plain_only=True).collect()} == plain
    if k <= packed.MOST:
        framed = Counter((x[p : p + k], p % 3) for _, x, _, _ in rows if x for p in range(len(x) - k + 1))
        assert {(x.kmer, x.frame): x.cnt for x in packed.count(df, k, frames=3).collect()} == framed
        spots = Counter((i, p, x[p : p + k]) for i, x, _, _ in rows if x for p in range(len(x) - k + 1))
        got = packed.windows(df, k, "id").select("id", "pos", F.when(F.col("code") >= 0, packed.letters(F.col("code"), k)).otherwise(F.col("word")).alias("w"))
        assert Counter(tuple(x) for x in got.collect()) == spots
    assert kmers.count_in(df.limit(0), k).count() == 0


def test_bucketed_histogram(spark):
    counts = spark.createDataFrame([(c,) for c in range(1, 130)], "cnt long")
    for low, high, step in ((1, 100, 5), (20, 60, 7), (3, 50, 10)):
        first = max(1, low - step)
        want = Counter(first + (min(max(c, first), high + step) - first) // step * step for c in range(1, 130))
        assert {x.bucket: x.n for x in kmers.bucketed_histogram(counts, low, high, step).collect()} == want


def test_numbered_rows(spark):
    r = random.Random(2)
    rows = [(r.randrange(5), i) for i in range(500)]
    got = numbered(spark.createDataFrame(rows, "a int, b int").repartition(7), F.desc("a"), "b").collect()
    assert [(x.a, x.b) for x in sorted(got, key=lambda x: x["rank"])] == sorted(rows, key=lambda x: (-x[0], x[1]))
    assert sorted(x["rank"] for x in got) == list(range(1, 501))


def test_unitigs_of_chains_and_circles(spark):
    chain, circle = "ACGTTGCAATCGGA", "CCATAGATTC"
    words = {chain[i : i + 5] for i in range(len(chain) - 4)} | {(circle * 2)[i : i + 5] for i in range(len(circle))}
    got = {x.head: (x.n_kmers, x.tail) for x in contigs.unitigs(spark.createDataFrame([(w, 2) for w in words], "kmer string, cnt long")).collect()}
    ring = sorted((circle * 2)[i : i + 5] for i in range(len(circle)))[0]
    tail = (circle * 3)[(circle * 2).index(ring) + len(circle) - 1 :][:5]
    assert got == {chain[:5]: (len(chain) - 4, chain[-5:]), ring: (len(circle), tail)}


def test_reachable_kmers(spark):
    words = ["AAC", "ACG", "CGT", "CGA", "GTT", "GAA", "TTT"]
    counts = spark.createDataFrame([(w, 5) for w in words], "kmer string, cnt long")
    got = {(x.start, x.kmer) for x in contigs.reachable_kmers(counts, spark.createDataFrame([("AAC",), ("GTT",), ("GGG",)], "kmer string")).collect()}
    after = {w: [v for v in words if v[:2] == w[1:]] for w in words}
    want = set()
    for start in ("AAC", "GTT"):
        todo = [start]
        while todo:
            x = todo.pop()
            if (start, x) not in want:
                want.add((start, x))
                todo += after[x]
    assert got == want


def test_packed_tables_give_what_words_give(spark):
    """Neighbours, error pruning, threads and set algebra over k-mers as numbers, some of which have letters that can't be packed."""
    r = random.Random(11)
    rows = [(i, "".join(r.choices("ACGTNé", weights=[9, 6, 6, 6, 2, 1], k=r.choice([0, 4, 5, 30, 80]))), r.choice("AB")) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, seq string, db string").repartition(3)
    for k in (2, 5, 31):
        words, codes = kmers.count_in(df, k), kmers.count_in(df, k, decode=False)
        same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect()))
        assert same(words, packed.decoded(codes, k))
        assert same(kmers.successors(words), kmers.successors(codes, k)) and same(kmers.predecessors(words), kmers.predecessors(codes, k))
        assert same(kmers.prune_errors(words, 0.4), packed.decoded(kmers.prune_errors(codes, 0.4), k))
        assert same(kmers.thread(df, words, k, "id"), kmers.thread(df, codes, k, "id"))
        both, in_code = kmers.count_in(df, k, by=("db",)), kmers.count_in(df, k, by=("db",), decode=False)
        assert same(setmath.minimum(both, 2), packed.decoded(setmath.minimum(in_code, 2), k))
        a, b = ([x.where(f"db = '{d}'").drop("db") for x in (both, in_code)] for d in "AB")
        for f in (setmath.subtract, setmath.absolute, setmath.divide):
            assert same(f(a[0], b[0]), packed.decoded(f(a[1], b[1]), k))
    with pytest.raises(ValueError, match="can't be packed"):
        kmers.count_in(df, 40, decode=False)


def stretched_reads(spark):
    r = random.Random(1)
    base = ["".join(r.choice("ACGT") for _ in range(150)) for _ in range(20)]
    seqs = [None, "", "A" * 300]
    for _ in range(300):
        at = r.randrange(110)
        x = r.choice(base)[at : at + r.randrange(60)]
        x = x[:10] + r.choice(["N", "é", "XX"]) + x[10:] if r.random() < 0.2 else x
        seqs.append(x.translate(PAIRS)[::-1] if r.random() < 0.3 and x.isascii() else x)
    return base, seqs, spark.createDataFrame([(i, x, i % 5) for i, x in enumerate(seqs)], "read_id long, seq string, w int").repartition(3)


@pytest.mark.parametrize(("k", "canonical", "weight", "plain"), [(16, False, None, False), (20, True, "w", False), (25, False, "w", True), (27, True, None, False)])
def test_stretches_count_every_window(spark, k, canonical, weight, plain):
    """Batches are few rows, so a bucket goes on from one to the next."""
    _, seqs, df = stretched_reads(spark)
    want = Counter()
    for i, x in enumerate(seqs):
        for j in range(len(x or "") - k + 1):
            w = x[j : j + k]
            if not plain or not set(w) - set("ACGT"):
                want[min(w, w.translate(PAIRS)[::-1]) if canonical else w] += i % 5 if weight else 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        rows = packed.count(df, k, canonical=canonical, weight=weight, plain_only=plain).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(rows) == len(want) and {x.kmer: x.cnt for x in rows} == dict(want)


def test_labels_by_stretches_are_those_of_joined_windows(spark, monkeypatch):
    base, seqs, reads = stretched_reads(spark)
    r = random.Random(2)
    bundles = spark.createDataFrame([(r.choice([0, 1, 2, 3, None]), x[:60] + r.choice(["", "N"]) + x[60:]) for x in base] + [(r.randrange(4), x) for x in seqs[:60]], "component long, seq string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = sorted(map(str, clustering.label_reads(reads, bundles, 25).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(packed, "STRETCHED", range(0))
    assert got == sorted(map(str, clustering.label_reads(reads, bundles, 25).collect())) and len(got) > 100


@pytest.mark.parametrize("name", ["j02_label_reads", "k04_weighted_count"])
def test_reads_are_shuffled_by_stretches(spark, name):
    """Not by windows, and reads are made once."""
    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(bucket" in plan and "hashpartitioning(code" not in plan and plan.count("lineitem.parquet") == 1


def test_several_lengths_are_counted_in_one_pass(spark):
    r = random.Random(5)
    df = spark.createDataFrame([(x,) for x in some_texts(r, 60, "ACGTN")], "seq string")
    rows = packed.count(df, 6, frames=3, also=(5,)).collect()
    for k in (6, 5):
        want = packed.count(df, k, frames=3, decode=False).collect()
        assert sorted((x.frame, x.code, x.word, x.cnt) for x in rows if x.k == k) == sorted((x.frame, x.code, x.word, x.cnt) for x in want)


def test_scores_make_reads_once(spark):
    plan = catalog.queries()["n11_coding_selected"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 0  # their counts are a table by now


def test_keys_of_a_batch_are_told_apart():
    """One key column is looked up as a whole, nulls too, in less time than Python needs to list it."""
    keys, which = packed._keys(pa.RecordBatch.from_arrays([pa.array(["A", None, "B", "A", None])], ["db"]), 1)
    assert [keys[0][i].as_py() for i in which.tolist()] == ["A", None, "B", "A", None] and len(keys[0]) == 3
    column = pa.array(["A", "N", "R"] * 300_000)
    batch = pa.RecordBatch.from_arrays([column], ["db"])
    taken = lambda f: min(timeit.repeat(f, number=1, repeat=3))
    assert taken(lambda: packed._keys(batch, 1)) < taken(column.to_pylist)
