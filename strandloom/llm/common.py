"""Helpers shared by the corpus operators.

Null texts are read as empty texts everywhere. Every operator selects the columns that it
needs by name before it adds its own, so extra columns of the input never clash with its
internal names.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches of whole texts are worked on in pieces, so that a few very long rows fit a worker.
SLICE_ROWS, SLICE_BYTES = 512, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir. Where that is unset, a temporary folder is set as such if everything
    runs in this process (tests); a cluster must name one."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strandloom-")
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir()
    return found


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder name in the shared folder; what is there goes when the driver ends."""
    name = os.path.join(shared_dir(spark), f"strandloom-{tag}-{uuid.uuid4().hex}")
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return name


def remove(spark: SparkSession, name: str) -> None:
    """Removes a folder of the shared folder before the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def open_folder(uri: str):
    """(file system, path) of a folder that all executors share."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path, recursive=True)
    return store, path


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cuts the lineage: df as a Parquet table in the shared folder, read again."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most SLICE_ROWS rows and, by their mean length, about SLICE_BYTES, so that what is made of a piece stays small too.
    Spark bounds the bytes of the batches themselves; no setting of the session is touched. What a task's batches took goes back to the system at its end, as the worker lives on."""
    for b in batches:
        step = max(1, min(SLICE_ROWS, b.num_rows * SLICE_BYTES // max(1, b.nbytes)))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)
    b = None
    trim()


def fresh(df: DataFrame, name: str) -> str:
    """A column name like this one that df doesn't have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def trim() -> None:
    """Gives free memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


_caches: dict[str, list] = {}


def cache(owner: str, *caches: dict) -> None:
    """Registers caches that Python workers keep between tasks."""
    _caches.setdefault(owner, []).extend(caches)


def claim(owner: str) -> None:
    """Empties the caches of all other operators in this worker: workers are used again by later stages, and what earlier ones keep would add up."""
    freed = 0
    for name, held in _caches.items():
        if name != owner:
            for c in held:
                freed += len(c)
                c.clear()
    if freed > 10_000:
        gc.collect()
        trim()


def quoted(name: str) -> str:
    """A column's name as an expression, whatever letters it has."""
    return "`" + name.replace("`", "``") + "`"


def all_of(df: DataFrame) -> list[Column]:
    """The columns of df, whatever letters their names have."""
    return [F.col(quoted(c)) for c in df.columns]


def over_arrow(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow(run, schema) for columns of any names: the interface reads a dot in a name as a field."""
    names = df.columns
    if not any(set(c) & set(".`") for c in names):
        return df.mapInArrow(run, schema)

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(b.rename_columns(names) for b in batches)

    return df.toDF(*(f"c{k}" for k in range(len(names)))).mapInArrow(renamed, schema)
