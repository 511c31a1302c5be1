"""Set operations on k-mer tables. Tables of several databases are one frame (db, kmer, cnt), so each operation is one aggregation. K-mers may be packed, (code, word) in
place of kmer, here and in what is returned, so that whole numbers are shuffled and letters are made at the end."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tagged(tables: dict[str, DataFrame]) -> DataFrame:
    """(db, kmer, cnt) of named tables."""
    return reduce(lambda a, b: a.unionByName(b), [t.select(F.lit(name).alias("db"), "kmer", "cnt") for name, t in tables.items()])


def _key(df: DataFrame) -> list[str]:
    return ["kmer"] if "kmer" in df.columns else ["code", "word"]


def _by_kmer(dbs: DataFrame, value, n: int | None = None, condition=None) -> DataFrame:
    key = _key(dbs)
    out = dbs.groupBy(*key).agg(value.alias("cnt"), F.count_distinct("db").alias("_n"))
    if n is not None:
        out = out.where(F.col("_n") == n)
    if condition is not None:
        out = out.where(condition(F.col("_n")))
    return out.select(*key, "cnt")


def minimum(dbs: DataFrame, n: int) -> DataFrame:
    """Smallest count of k-mers that are in all n databases."""
    return _by_kmer(dbs, F.min("cnt"), n)


def minimum_any(dbs: DataFrame) -> DataFrame:
    """Smallest count over the databases that have the k-mer."""
    return _by_kmer(dbs, F.min("cnt"))


def maximum(dbs: DataFrame, n: int) -> DataFrame:
    """Largest count of k-mers that are in all n databases."""
    return _by_kmer(dbs, F.max("cnt"), n)


def maximum_any(dbs: DataFrame) -> DataFrame:
    """Largest count over any database."""
    return _by_kmer(dbs, F.max("cnt"))


def add(dbs: DataFrame) -> DataFrame:
    """Sum of counts."""
    return _by_kmer(dbs, F.sum("cnt"))


def presence(dbs: DataFrame, how: str, n: int) -> DataFrame:
    """K-mers, with count 1, that are in all (and), not all (nand), any (or) or an odd number (xor) of n databases."""
    conditions = {"and": lambda c: c == n, "nand": lambda c: c < n, "or": lambda c: c >= 1, "xor": lambda c: c % 2 == 1}
    return _by_kmer(dbs, F.max(F.lit(1).cast("long")), condition=conditions[how])


def subtract(a: DataFrame, b: DataFrame) -> DataFrame:
    """A minus B, at least 0; zeros and k-mers of B alone are dropped."""
    key = _key(a)
    rows = a.join(b.select(*key, F.col("cnt").alias("_b")), key, "left")
    return rows.select(*key, F.greatest(F.col("cnt") - F.coalesce("_b", F.lit(0)), F.lit(0)).alias("cnt")).where("cnt > 0")


def absolute(a: DataFrame, b: DataFrame) -> DataFrame:
    """|A - B| over the k-mers of either; zeros are dropped."""
    key = _key(a)
    rows = a.select(*key, F.col("cnt").alias("_a")).join(b.select(*key, F.col("cnt").alias("_b")), key, "full")
    return rows.select(*key, F.abs(F.coalesce("_a", F.lit(0)) - F.coalesce("_b", F.lit(0))).alias("cnt")).where("cnt > 0")


def divide(a: DataFrame, b: DataFrame) -> DataFrame:
    """floor(1000 A / B) of the k-mers of both, below 2**32."""
    key = _key(a)
    rows = a.join(b.select(*key, F.col("cnt").alias("_b")), key)
    return rows.select(*key, F.least(F.floor(F.col("cnt") * 1000 / F.col("_b")), F.lit(2**32 - 1)).cast("long").alias("cnt"))


def threshold(a: DataFrame, how: str, value: int) -> DataFrame:
    """K-mers with counts lessthan, lessthanorequal, greaterthan, greaterthanorequal or equal to a value."""
    c = F.col("cnt")
    return a.where({"lessthan": c < value, "lessthanorequal": c <= value, "greaterthan": c > value, "greaterthanorequal": c >= value, "equal": c == value}[how])
