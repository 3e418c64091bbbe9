"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.session import checkpoint_dir

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BATCH_BYTES = 4 << 20   # a batch of 10,000 rows, Spark's own limit, holds 34 MB of texts of 3.4 KB


def col(name: str) -> Column:
    """Column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns an operator is about to add (names compare without case)."""
    taken = {n.lower() for n in names}
    return df.select(*[col(c) for c in df.columns if c.lower() not in taken])


def whole_text(name: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage ends there,
    and executors lost later cost no recomputation of what came before."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches for Python workers end at a few megabytes where the session sets no limit:
    a task's JVM builds a batch whole beside the heap, and its worker holds it whole."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(MOST_BATCH_BYTES))


def by_bytes(batches: Iterator[pa.Array], most: int) -> Iterator[pa.Array]:
    """Arrow batches of texts in parts of at most ``most`` bytes (a longer text is a part of
    its own), so that only a part at a time becomes Python objects."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, done = 0, 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(at, to - at)
            at, done = to, int(ends[to - 1])
        if not len(batch):
            yield batch
