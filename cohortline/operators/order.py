"""Audit of the cohort's order.

A stretch of rows of one file is summed up by its first key, its last key, its number of rows and
whether it is sorted. Two neighbouring stretches are sorted together if both are and the last key
of one is not above the first key of the next, so the summary of a file follows from those of its
splits, and that of a shard from those of its files, a few rows a file instead of its events.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_KEY = "struct<subject_id: bigint, timed: boolean, time: timestamp_ntz, code: string>"


def _key(batch: pa.RecordBatch, at: int) -> dict:
    row = {c: batch.column(c)[at].as_py() for c in ("subject_id", "time", "code")}
    return {"subject_id": row["subject_id"], "timed": row["time"] is not None, "time": row["time"], "code": row["code"]}


def _is_sorted(batch: pa.RecordBatch) -> bool:
    """By subject, time with nulls first, and code as bytes."""
    subject = batch.column("subject_id").to_numpy(zero_copy_only=False)
    time = pc.fill_null(batch.column("time").cast(pa.int64()), np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
    code = batch.column("code").cast(pa.binary())
    rises = pc.less_equal(code.slice(0, len(code) - 1), code.slice(1)).to_numpy(zero_copy_only=False)
    later = (time[:-1] < time[1:]) | ((time[:-1] == time[1:]) & rises)
    return bool(((subject[:-1] < subject[1:]) | ((subject[:-1] == subject[1:]) & later)).all())


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("split", pa.string()), ("shard", pa.int32()), ("file", pa.string()), ("start", pa.int64()),
                        ("rows", pa.int64()), ("sorted", pa.bool_()),
                        *[(n, pa.struct([("subject_id", pa.int64()), ("timed", pa.bool_()), ("time", pa.timestamp("us")),
                                         ("code", pa.string())])) for n in ("first", "last")]])
    for batch in batches:
        if not batch.num_rows:
            continue
        file = pc.dictionary_encode(batch.column("file")).indices.to_numpy(zero_copy_only=False)
        index = batch.column("index").to_numpy(zero_copy_only=False)
        # a stretch ends where another file begins or rows of a file do not follow each other
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(index) != 1)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            rows = batch.slice(start, end - start)
            yield pa.RecordBatch.from_pylist([{
                **{c: rows.column(c)[0].as_py() for c in ("split", "shard", "file")}, "start": int(index[start]),
                "rows": end - start, "sorted": _is_sorted(rows), "first": _key(rows, 0), "last": _key(rows, end - start - 1)}],
                schema=schema)


def _folded(parts: DataFrame, by: list[str], order: list) -> DataFrame:
    """Summaries of neighbours folded into one for each ``by``."""
    before = F.lag("last").over(Window.partitionBy(*by).orderBy(*order))
    fits = F.coalesce(before <= F.col("first"), F.lit(True))
    return parts.withColumn("_fits", F.col("sorted") & fits).groupBy(*by).agg(
        F.count(F.lit(1)).alias("parts"), F.sum("rows").alias("rows"), F.bool_and("_fits").alias("sorted"),
        F.min_by("first", F.struct(*order)).alias("first"), F.max_by("last", F.struct(*order)).alias("last"))


def file_order(spark: SparkSession, data_dir: str) -> DataFrame:
    """``split, shard, file, rows, sorted, first, last`` for every file of a cohort."""
    rows = spark.read.parquet(data_dir).select(
        "split", "shard", "subject_id", "time", "code", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("index"))
    parts = rows.mapInArrow(_summaries, "split string, shard int, file string, start bigint, rows bigint, sorted boolean, "
                                        f"first {_KEY}, last {_KEY}")
    return _folded(parts, ["split", "shard", "file"], [F.col("start")]).drop("parts")


def shard_order(files: DataFrame) -> DataFrame:
    """``split, shard, files, rows, sorted`` for every shard: its files are sorted, and one after
    the other they are the shard's events in order."""
    folded = _folded(files, ["split", "shard"], [F.col("first"), F.col("last"), F.col("file")])
    return folded.select("split", "shard", F.col("parts").alias("files"), "rows", "sorted")
