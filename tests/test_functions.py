import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandloom.functions import seq as S
from strandloom.operators import align, coding, paths


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_revcomp_and_palindromes(spark):
    assert one(spark, S.revcomp(F.lit("AACGTN"))) == "NACGTT"
    assert one(spark, S.is_palindrome(F.lit("ACGT"))) is True
    assert one(spark, S.canonical(F.lit("TTTT"))) == "AAAA"
    assert one(spark, S.revcomp(F.lit(""))) == ""


def test_pack_round_trip(spark):
    r = random.Random(1)
    kmers = ["".join(r.choice("ACGT") for _ in range(31)) for _ in range(50)]
    rows = spark.createDataFrame([(k,) for k in kmers], "k string").select("k", S.unpack(S.pack(F.col("k")), 31).alias("u"), S.unpack(S.packed_revcomp(S.pack(F.col("k")), 31), 31).alias("r"), S.revcomp(F.col("k")).alias("want"))
    assert all(x.k == x.u and x.r == x.want for x in rows.collect())


def test_cigar_and_gaps(spark):
    got = one(spark, S.cigar_blocks(F.lit(100), F.lit("5S10M3D7M2I4M100N6M3H")))
    assert [(b.lend, b.rend) for b in got] == [(100, 109), (113, 119), (120, 123), (224, 229)]
    merged = one(spark, S.merge_short_gaps(S.cigar_blocks(F.lit(100), F.lit("10M3D7M100N6M"))))
    assert [(b.lend, b.rend) for b in merged] == [(100, 119), (220, 225)]


def test_translation(spark):
    assert one(spark, S.translate_frame(F.lit("ATGAAANNNTAAG"), 1)) == "MKX*"
    assert one(spark, S.translate_frame(F.lit("AT"), 1)) == ""
    assert one(spark, S.translate_frame(F.lit("TTTCAT"), 4)) == "MK"
    assert one(spark, S.iupac_code(F.array(F.lit("G"), F.lit("A")))) == "R"
    assert one(spark, S.entropy(F.lit("ACGT"))) == 2.0
    assert one(spark, S.compress_runs(F.lit("AAACCGTT"))) == "ACGT"


def test_sql_functions(spark):
    S.register(spark)
    assert spark.sql("SELECT revcomp('AAC') AS a, canonical_kmer('TTT') AS b, core_read_name('r1/2') AS c").first() == ("GTT", "AAA", "r1")


def brute_global(a, b, match, mismatch, go, ge):
    best = {}

    def f(i, j, s):
        if (i, j, s) in best:
            return best[i, j, s]
        if i == 0 and j == 0:
            return 0 if s == 0 else -(10**9)
        out = -(10**9)
        if s == 0 and i and j:
            out = max(f(i - 1, j - 1, t) for t in range(3)) + (match if a[i - 1] == b[j - 1] else mismatch)
        if s == 1 and i:
            out = max(f(i - 1, j, t) - (ge if t == 1 else go) for t in range(3))
        if s == 2 and j:
            out = max(f(i, j - 1, t) - (ge if t == 2 else go) for t in range(3))
        best[i, j, s] = out
        return out

    return max(f(len(a), len(b), t) for t in range(3))


@settings(max_examples=60, deadline=None)
@given(st.text("ACGT", max_size=9), st.text("ACGT", max_size=9))
def test_alignment_score(a, b):
    got = align.align(a, b, 4, -5, 10, 1)
    assert got["score"] == brute_global(a, b, 4, -5, 10, 1)
    assert 2 * (got["matches"] + got["mismatches"]) + got["gaps"] == len(a) + len(b)


def test_local_alignment():
    got = align.align("TTTTACGTACGTTTTT", "GGACGTACGGG", local=True)
    assert got["matches"] >= 7 and got["mismatches"] == 0 and got["gaps"] == 0


def test_orfs():
    found = coding.find_orfs("CCATGAAATTTTAGCC", partial=False)
    assert ("+", 2, 14, True, True) in found


def test_threading_and_mates():
    seq = "ACGTTGCAATCG"
    after = {seq[i : i + 4]: [seq[i + 1 : i + 5]] for i in range(len(seq) - 4)}
    after[seq[-4:]] = []
    assert paths.sequence_of(paths.thread_read("GTTGCAA", 4, after)) == "GTTGCAA"
    assert paths.sequence_of(paths.thread_read("GTTGCTA", 4, after)) == "GTTGCAA"
    behind = {1: {2, 3, 4, 5}, 2: {3, 4, 5}, 3: {4, 5}, 4: {5}, 5: set()}
    assert paths.combine_mates((1, 2, 3), (3, 4), behind) == ((1, 2, 3, 4), ())
    assert paths.combine_mates((5,), (1,), behind) == ((1,), (5,))


def test_shared_start_gives_two_transcripts(spark):
    import random as rnd

    r = rnd.Random(4)
    head, a, b = ("".join(r.choice("ACGT") for _ in range(60)) for _ in range(3))
    seqs = [(1, head + a), (1, head + b)]
    df = spark.createDataFrame(seqs, "component long, seq string")
    from strandloom.operators import debruijn

    found = paths.transcripts(debruijn.build(df, 20).select("component", "src", "dst"), df.union(df), 20).collect()
    assert {f.seq for f in found} == {s for _, s in seqs}
