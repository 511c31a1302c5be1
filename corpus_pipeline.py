"""The corpus pipeline over ``documents``: toxic documents go, one of each group of near-equal
documents stays, secrets are masked, sources are mixed to their targets, and the mix is encoded.

Each stage takes (spark, docs, sf_dir), works on all rows of docs and returns all rows that it keeps.
All but the last return the columns of their docs, whatever further columns those are and whatever their names. A null text is kept as it is until the last stage, where it has
no tokens; rows with a null id are never near-equal to others. An empty table stays empty.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import bpe, common, jaccard, mixing, places, secrets, toxicity


GOES, ALONE, REPEATED = 0, 1, 2  # decisions about an id's rows


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold, rows that repeat an id one by one."""
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    mark = common.fresh(docs, "_toxicity")
    return toxicity.score(docs, model, name=mark).where(~toxicity.rejected(mark)).select(common.all_of(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component. Of rows that repeat an id, the one with the smallest text stays (then by the
    other columns from left to right, nulls first; columns with maps or variants in them don't count); rows with a null id all stay."""
    found = common.written(jaccard.join(docs.select("doc_id", "text")), "components")
    ids = found.groupBy(F.col("doc_id").alias("id")).agg(F.min("component_id").alias("least"), F.count(F.lit(1)).alias("n"))
    value = F.when(F.col("id").isNull(), ALONE).when(F.col("least") != F.col("id"), GOES).otherwise(F.when(F.col("n") > 1, REPEATED).otherwise(ALONE))
    kept = common.written(ids.select("id", value.alias("value")), "kept")
    mark = common.fresh(docs, "_value")
    out = places.with_value(docs, kept, name=mark)
    alone = out.where(F.col(mark) == ALONE).select(common.all_of(docs))
    if kept.where(F.col("value") == REPEATED).isEmpty():
        return alone
    by = ["text", *(common.quoted(f.name) for f in docs.schema if f.name != "text" and not re.search(r"\bmap<|\bvariant\b", f.dataType.simpleString()))]
    once = out.where(F.col(mark) == REPEATED).groupBy(F.col("doc_id").alias(mark)).agg(F.min_by(F.struct(*common.all_of(docs)), F.struct(*by)).alias("row"))
    return alone.unionByName(once.select("row.*"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked; n_chars, where there is such a column, follows."""
    out = secrets.redact(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))).select(common.all_of(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Rows that share an id are taken equally often."""
    copies = mixing.mix(docs).groupBy(F.col("doc_id").alias("id")).agg(F.max("copies").alias("value"))
    mark = common.fresh(docs, "_value")
    rows = places.with_value(docs, copies, name=mark).where(F.col(mark) > 0)
    return rows.select(*common.all_of(docs), F.explode(F.sequence(F.lit(1).cast("long"), F.col(mark))).alias(mark)).select(common.all_of(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and the digest of what the ids decode to."""
    return bpe.encode(docs.drop("n_chars"), bpe.VOCABULARY)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.written(docs, f"stage-{k}")
    return docs
