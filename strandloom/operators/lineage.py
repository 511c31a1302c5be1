"""Cutting lineage in fixpoint loops, numbering rows, one-row tables beside others."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share. Where it isn't set, a temporary folder takes its place if everything runs in this process
    (tests); a cluster must name one."""
    sc = spark.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="strandloom-"))
    return sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder name in the shared folder; what is there goes when the driver ends."""
    name = os.path.join(shared_dir(spark), f"strandloom-{tag}-{uuid.uuid4().hex}")
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return name


def cut(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, read again: its rows are computed once (a checkpoint computes them twice), and what is read has known sizes."""
    path = scratch(df.sparkSession, "cut")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut = path
    return out


def dropped(df: DataFrame) -> None:
    """Removes the files of a table that ``cut`` has written, once nothing reads it any more, so that rounds of a fixpoint don't pile up on the disk."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._cut)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """df with the place of each row, from 1, in an order that leaves no ties. Rows are sorted by ranges in parallel; only the ranges' sizes, a row
    a partition, meet in one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = rows.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).transform(cut)
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    return rows.join(F.broadcast(before), "_range").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_range", "_at", "_before")


def beside(df: DataFrame, one: DataFrame) -> DataFrame:
    """df with the columns of a one-row table, an aggregate over all of some rows, beside each row: it is broadcast, where a window over all rows would gather them in a task."""
    return df.crossJoin(F.broadcast(one))
