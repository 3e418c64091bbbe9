"""Checksum audit of a file set against a SHA-256 manifest (A15, re-aimed).

Manifest lines read ``<sha256> <path>``; lines with fewer than two whitespace
separated tokens are ignored and a later line for the same path wins. A file's
manifest key is its URL path after the first three segments (``/files/<name>/
<version>/``), or its file name when nothing follows; a URL with fewer segments
has no manifest to look in. The full outer join of files and manifest classifies each key:

* ``valid`` - hashes equal: nothing to fetch;
* ``mismatch`` - hashes differ: fetch again;
* ``not_in_manifest`` - a file the manifest does not list: fetch again;
* ``no_manifest`` - a file without a key: fetch again;
* ``missing`` - a listed path with no file (our addition): fetch;
* ``manifest_unreadable`` - the manifest cannot be read: every file is fetched.

Files are hashed in tasks whatever their size: small ones as whole rows of ``binaryFile``, larger
ones from a stream, a bounded buffer at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.sources import files


def parse_manifest(lines: DataFrame, line_col: str = "value", order_col: str | None = None) -> DataFrame:
    """``key, expected_sha256`` from manifest text lines (last line per key wins)."""
    tokens = F.regexp_extract_all(F.col(line_col), F.lit(r"(\S+)"))
    parsed = lines.select(
        F.get(tokens, 1).alias("key"),
        F.get(tokens, 0).alias("expected_sha256"),
        (F.col(order_col) if order_col else F.monotonically_increasing_id()).alias("_line"),
        F.size(tokens).alias("_n"),
    ).filter(F.col("_n") >= 2)
    return parsed.groupBy("key").agg(F.max_by("expected_sha256", "_line").alias("expected_sha256"))


def manifest_key(url: Column) -> Column:
    """Path after ``scheme://host/a/b/c/``; the file name when that is empty, ``index.html`` when
    that is empty too; null for a path of fewer segments."""
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*)?(/[^?#]*)", 1)
    rest = F.regexp_extract(path, r"^/[^/]*/[^/]*/[^/]*/(.*)$", 1)
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.when(path.rlike(r"^/[^/]*/[^/]*/"), F.when(rest != "", rest).when(name != "", name).otherwise("index.html"))


def audit(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """``key, expected_sha256, actual_sha256, status, refetch`` for files ``(key,
    actual_sha256)`` against a parsed manifest ``(key, expected_sha256)``."""
    joined = files.join(manifest, "key", "full_outer")
    status = (F.when(F.col("key").isNull(), F.lit("no_manifest"))
              .when(F.col("actual_sha256").isNull(), F.lit("missing"))
              .when(F.col("expected_sha256").isNull(), F.lit("not_in_manifest"))
              .when(F.col("actual_sha256") == F.col("expected_sha256"), F.lit("valid"))
              .otherwise(F.lit("mismatch")))
    return joined.select("key", "expected_sha256", "actual_sha256", status.alias("status"),
                         (status != "valid").alias("refetch"))


# Files up to this size are rows of ``binaryFile`` (which ends at 2 GB); larger ones are streamed.
ROW_BYTES = 64 << 20
BUFFER_BYTES = 8 << 20
# Most tasks that streamed files are dealt out to.
STREAM_TASKS = 10_000


def _stream(path: str):
    """Input stream of a path as Spark names it, opened inside a task."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem().open_input_stream("/" + path[len("file:"):].lstrip("/"))
    system, inside = pyarrow.fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return system.open_input_stream(unquote(inside))


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            digest = hashlib.sha256()
            with _stream(path) as stream:
                while block := stream.read(BUFFER_BYTES):
                    digest.update(block)
            yield pa.RecordBatch.from_pydict({"path": [path], "actual_sha256": [digest.hexdigest()]})


def hash_files(spark: SparkSession, root: str) -> DataFrame:
    """``key, actual_sha256`` for every file under ``root`` (relative path as key).

    Streams are opened through the file systems of Arrow (local, HDFS, S3, GCS), so that no
    file is ever held whole; a hash is sequential, so one file is one task's work."""
    prefix = files.qualified(spark, root).rstrip("/") + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    hashed = found.filter(F.col("length") <= ROW_BYTES).select(
        "path", F.sha2(F.col("content"), 256).alias("actual_sha256"))
    large = found.filter(F.col("length") > ROW_BYTES).select("path")
    count = large.count()    # sizes come from the listing, no file is read
    if count:
        dealt = large.repartition(min(count, STREAM_TASKS))
        hashed = hashed.unionByName(dealt.mapInArrow(_streamed, "path string, actual_sha256 string"))
    rel = F.when(F.col("path").startswith(prefix), F.substr(F.col("path"), F.lit(len(prefix) + 1))).otherwise(F.col("path"))
    return hashed.select(rel.alias("key"), "actual_sha256")


def audit_directory(spark: SparkSession, root: str, manifest_path: str) -> DataFrame:
    """Audit the files under ``root`` against the manifest file at ``manifest_path``."""
    hashed = hash_files(spark, root)
    if not files.exists(spark, manifest_path):
        return hashed.select("key", F.lit(None).cast("string").alias("expected_sha256"), "actual_sha256",
                             F.lit("manifest_unreadable").alias("status"), F.lit(True).alias("refetch"))
    return audit(hashed, parse_manifest(spark.read.text(manifest_path)))
