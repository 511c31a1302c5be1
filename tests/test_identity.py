"""The best identity of a sequence with itself shifted."""

from pyspark.sql import functions as F

from strandloom.operators import clustering


def test_internal_identity(spark):
    texts = ["ACGTACGTAA", "AAAAA", "ACGT", "", None, "ÄßÄßÄßÄß", "GATTACAGATTA", "ACGTT"]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, seq string").select("i", clustering.internal_identity(F.col("seq")).alias("x"))

    def plain(t):
        t = t or ""
        return max((sum(a == b for a, b in zip(t, t[s:], strict=False)) / (len(t) - s) for s in range(1, len(t) - 3)), default=0.0)

    assert {r["i"]: r["x"] for r in found.collect()} == {i: plain(t) for i, t in enumerate(texts)}
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()  # not an interpreted loop a letter
