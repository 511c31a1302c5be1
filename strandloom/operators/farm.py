"""Lists of independent tasks run on the cluster, with results that stay and a list of what failed.

Spark's scheduler deals out the tasks and repeats those of lost executors. What a task gave, or why it failed, is a row of a Parquet table,
so a second run does only what has no result yet.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.lineage import cut

RESULT = "id string, ok boolean, result string, error string, run long"


def results(spark, path: str) -> DataFrame:
    """(id, ok, result, error): the last outcome of each task at a path, a success if there ever was one; empty before the first run."""
    try:
        rows = spark.read.schema(RESULT).parquet(path)
    except AnalysisException as gone:
        if "PATH_NOT_FOUND" not in str(gone):
            raise
        rows = spark.createDataFrame([], RESULT)
    best = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("ok"), F.desc("run")))
    return rows.withColumn("_k", best).where("_k = 1").select("id", "ok", "result", "error")


def run_tasks(tasks: DataFrame, work: Callable[[str], str], path: str, partitions: int | None = None) -> DataFrame:
    """Runs work(payload) of each task (id, payload) that has no success at ``path`` yet, and adds the outcomes there; gives the outcomes of all runs. An exception fails its
    task only. ids are unique."""
    spark = tasks.sparkSession
    before = results(spark, path).transform(cut)  # as it is now: the path is added to below
    number = before.count()
    todo = tasks.select(F.col("id").cast("string").alias("id"), F.col("payload").cast("string").alias("payload")).join(before.where("ok").select("id"), "id", "left_anti")

    def run(batches):
        for pdf in batches:
            rows = []
            for key, payload in zip(pdf["id"], pdf["payload"], strict=True):
                try:
                    rows.append((key, True, work(payload), None, number))
                except Exception as e:  # a failed task is an outcome
                    rows.append((key, False, None, f"{type(e).__name__}: {e}", number))
            yield pd.DataFrame(rows, columns=["id", "ok", "result", "error", "run"])

    n = partitions or spark.sparkContext.defaultParallelism
    todo.repartition(n).mapInPandas(run, RESULT).write.mode("append").parquet(path)
    return results(spark, path)


def failed(spark, path: str) -> DataFrame:
    """(id, error) of the tasks without a success."""
    return results(spark, path).where("NOT ok").select("id", "error")
