"""File-system access for the few driver-side file operations (existence, listing,
sizes, a small text file), through Hadoop's FileSystem so any cluster store works.

Without a JVM gateway (a Spark Connect client), local paths fall back to ``os``.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    try:
        sc = spark.sparkContext
        jvm = sc._jvm  # noqa: SLF001
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p  # noqa: SLF001
    except Exception:
        return None


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def exists(spark: SparkSession, path: str) -> bool:
    h = _hadoop(spark, path)
    return bool(h[0].exists(h[1])) if h else os.path.exists(_local(path))


def qualified(spark: SparkSession, path: str) -> str:
    h = _hadoop(spark, path)
    return h[0].makeQualified(h[1]).toString() if h else "file:" + os.path.abspath(_local(path))


def entries(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """(name, is it a folder) of what lies directly in ``folder``."""
    h = _hadoop(spark, folder)
    if h:
        return [(s.getPath().getName(), bool(s.isDirectory())) for s in h[0].listStatus(h[1])]
    return [(e.name, e.is_dir()) for e in os.scandir(_local(folder))]


def size(spark: SparkSession, path: str) -> int:
    """Total bytes of a file or a folder of files."""
    h = _hadoop(spark, path)
    if h:
        return int(h[0].getContentSummary(h[1]).getLength())
    p = _local(path)
    if os.path.isfile(p):
        return os.path.getsize(p)
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(p) for f in fs)


def write_text(spark: SparkSession, path: str, text: str) -> str:
    """Write one small text file (overwriting)."""
    h = _hadoop(spark, path)
    if h:
        out = h[0].create(h[1], True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        return path
    p = _local(path)
    os.makedirs(os.path.dirname(p) or ".", exist_ok=True)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return path
