"""Expression tables of all samples: counts, normalisation factors and FPKM, from one row an aligned fragment.

  counts/sample=S       feature, cnt
  factors               sample, lib_size, factor, eff_size by trimmed means of M values
  expression/sample=S   feature, cnt, fpkm by the sample's own size, tmm_fpkm by its effective size

Every run replaces all three, so it can be repeated at any time. Counts are written first and read again for the rest, so fragments are read once.
Fragments without a feature or sample are left out, as are features of unknown length from expression. The settings say, in SQL, which are a fragment's feature and sample and a feature's id and length.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import common
from strandloom.operators import expression as X

log = logging.getLogger("expression_tables")
COUNTS = "feature long, cnt long, sample string"
FACTORS = "sample string, lib_size long, factor double, eff_size double"
EXPRESSION = "feature long, cnt long, fpkm double, tmm_fpkm double, sample string"


def read_expression(spark: SparkSession, output: str) -> DataFrame:
    """(sample, feature, cnt, fpkm, tmm_fpkm)."""
    return spark.read.schema(EXPRESSION).parquet(f"{output}/expression").select("sample", "feature", "cnt", "fpkm", "tmm_fpkm")


def _saved(rows: DataFrame, path: str, by_sample: bool = True) -> int:
    """Replaces a table and gives its number of rows."""
    writer = rows.hint("rebalance", "sample").write.partitionBy("sample") if by_sample else rows.coalesce(1).write
    writer.mode("overwrite").parquet(path)
    n = rows.sparkSession.read.schema(rows.schema).parquet(path).count()  # of the files' footers
    log.info("%d rows into %s", n, path)
    return n


def run(spark: SparkSession, fragments: str, features: str, output: str, settings: dict | None = None) -> dict:
    """Writes the three tables and says how many rows were read and written."""
    s = settings or common.config("expression_tables.json")
    rows = spark.read.parquet(fragments).select(F.expr(s["feature"]).cast("long").alias("feature"), F.expr(s["sample"]).cast("string").alias("sample"))
    counts = rows.where("feature IS NOT NULL AND sample != ''").groupBy("feature", "sample").agg(F.count(F.lit(1)).alias("cnt")).select("feature", "cnt", "sample")
    done = {"counts": _saved(counts, f"{output}/counts")}
    counts = spark.read.schema(COUNTS).parquet(f"{output}/counts")
    n = counts.agg(F.sum("cnt")).first()[0] or 0
    log.info("%d fragments of %s", n, fragments)
    lengths = spark.read.parquet(features).select(F.expr(s["feature_id"]).cast("long").alias("feature"), F.expr(s["length"]).cast("double").alias("len")).where("len > 0")
    done["factors"] = _saved(X.tmm(counts, s["trim_m"], s["trim_a"], s["least_sum"]).select("sample", F.col("lib_size").cast("long").alias("lib_size"), "factor", "eff_size"), f"{output}/factors", by_sample=False)

    factors = spark.read.schema(FACTORS).parquet(f"{output}/factors")
    sizes = counts.groupBy("sample").agg(F.sum("cnt").alias("total"))
    per_kb = F.col("cnt") / (F.col("len") / 1e3)
    both = counts.join(lengths, "feature").join(sizes.join(factors, "sample", "left"), "sample")
    out = both.select("feature", "cnt", F.round(per_kb / (F.col("total") / 1e6), 6).alias("fpkm"), F.round(per_kb / (F.col("eff_size") / 1e6), 6).alias("tmm_fpkm"), "sample")
    done["expression"] = _saved(out, f"{output}/expression")
    return {"fragments": n} | done


if __name__ == "__main__":
    common.main(__doc__, "expression_tables.json", {"fragments": "Parquet table with a row an aligned fragment", "features": "Parquet table of features", "output": "folder of the three tables"}, run)
