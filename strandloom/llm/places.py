"""Decisions about rows applied where the rows are read, so that long texts aren't shuffled to meet a number.

A table is read once for its ids and the input files that they stand in. Decisions (id, value) are joined to
those, which moves numbers only, and go to small files in the shared folder, in one subfolder an input file. When the table
is read again, each task takes the decisions of the input files whose rows it gets. A row's input file doesn't depend
on how files are split or on who runs the task, so lost executors and other splits change nothing.

Rows that don't come straight from files (after a shuffle, or made in the driver) have no input file. If there are any, the
table is first written to the shared folder as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm import common

FILE_IDS = 500_000  # ids in one file of decisions


def input_place() -> Column:
    """A number for the input file of a row; null where there is none."""
    return F.when(F.input_file_name() != "", F.xxhash64(F.input_file_name()))


def from_files(docs: DataFrame, found: DataFrame, tag: str) -> DataFrame:
    """docs, or their copy in files if ``found``, what was taken from docs, has a null place."""
    return docs if found.where("place IS NULL").isEmpty() else common.written(docs, tag)


def with_value(docs: DataFrame, values: DataFrame, id_col: str = "doc_id", name: str = "_value") -> DataFrame:
    """docs with the value (a whole number) of each row's id in a column of this name, which docs must not have; a null id has its value
    as any other, and rows that share an id share its value. values: one row an id (id, value), for all ids of docs; a missing one is an error."""
    spark = docs.sparkSession
    placed = lambda rows: common.written(rows.select(input_place().alias("place"), F.col(id_col).cast("long").alias("id")).distinct(), "value-places")
    ids = placed(docs)
    source = from_files(docs, ids, "value-rows")
    if source is not docs:
        docs, ids = source, placed(source)
    decided = values.select(F.col("id").alias("_id"), F.col("value").cast("long").alias("_decided"))
    folder = common.scratch(spark, "values")
    rows = ids.join(decided, F.col("id").eqNullSafe(F.col("_id"))).select("place", "id", F.col("_decided").alias("value"))
    most = ids.groupBy("place").count().agg(F.max("count")).first()[0] or 0
    salt = F.pmod(F.xxhash64("id"), F.lit(-(-most // FILE_IDS) or 1))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place, ids, found = (b.column(k).fill_null(0).to_numpy() for k in range(3))
            null = b.column(1).is_null().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]]))
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                store, path = common.open_folder(f"{folder}/{place[s]}")
                with store.open_output_stream(f"{path}/{uuid.uuid4().hex}.values", compression=None) as f:
                    f.write(np.stack([null[s:e].astype(np.int64), ids[s:e], found[s:e]]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([len(place)], pa.int64())], ["n"])

    dealt = rows.repartition(F.col("place"), salt).sortWithinPartitions("place") if most else rows
    common.written(dealt.mapInArrow(save, "n long"), "value-files")

    def decisions(place: int) -> tuple[np.ndarray, np.ndarray, int | None]:
        """(sorted ids, their values, the null id's value) of an input file."""
        from pyarrow import fs

        store, path = common.open_folder(f"{folder}/{place}")
        parts = [np.zeros((3, 0), np.int64)]
        for info in store.get_file_info(fs.FileSelector(path)):
            with store.open_input_stream(info.path, compression=None) as f:
                parts.append(np.frombuffer(f.read(), np.int64).reshape(3, -1))
        null, ids, found = np.concatenate(parts, axis=1)
        order = np.argsort(ids[null == 0], kind="stable")
        return ids[null == 0][order], found[null == 0][order], int(found[null == 1][0]) if null.any() else None

    where = [common.fresh(docs, "_place"), common.fresh(docs, "_key")]
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, known = None, None
        for b in common.slices(batches):
            files, ids = b.column(width).to_numpy(), b.column(width + 1).fill_null(0).to_numpy()
            null = b.column(width + 1).is_null().to_numpy(zero_copy_only=False)
            out = np.zeros(len(ids), np.int64)
            for p in np.unique(files).tolist():
                if p != place:
                    place, known = p, decisions(p)
                have, found, of_null = known
                mine, theirs = (files == p) & ~null, (files == p) & null
                at = np.searchsorted(have, ids[mine])
                if (theirs.any() and of_null is None) or (mine.any() and (not len(have) or at.max() == len(have) or (have[at] != ids[mine]).any())):
                    raise ValueError("an id has no value")
                out[mine] = found[at]
                out[theirs] = of_null or 0
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(out)], schema=pa.schema([*list(b.schema)[:width], pa.field(name, pa.int64())]))

    marked = docs.select("*", input_place().alias(where[0]), F.col(id_col).cast("long").alias(where[1]))
    return common.over_arrow(marked, run, docs.withColumn(name, F.lit(0).cast("long")).schema)
