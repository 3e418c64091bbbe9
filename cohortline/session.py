"""Session settings the engine relies on, and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings every job needs (D13): wall-clock timestamps without zone
# (parsing "2021-03-14 02:30:00" must not move across a DST gap), UTC for the few
# functions that still return zoned timestamps, and adaptive execution so shuffle
# partition counts, broadcast choices and skewed joins are re-planned at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply RUNTIME_CONF to an existing session (all are runtime-settable)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "cohortline") -> SparkSession:
    """Local or cluster session with the engine's settings; UI off (no server). The number of
    shuffle partitions is the user's or Spark's own unless one is given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("COHORTLINE_DRIVER_MEMORY", "8g"))
        # checkpoint files of released DataFrames are removed from the shared folder
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conf(spark)


SHUFFLES_REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """For the length of a write: Spark removes its shuffle files as soon as it has ended, not when the
    driver happens to collect its garbage. A lost one is made anew, as after the loss of an executor."""
    before = spark.conf.get(SHUFFLES_REMOVED, None)
    spark.conf.set(SHUFFLES_REMOVED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_REMOVED)
        else:
            spark.conf.set(SHUFFLES_REMOVED, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session names none (local runs, tests) a private one is created
    and registered, so ``DataFrame.checkpoint()`` works everywhere.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's setting is the only one
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this session")
        return configured
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not current:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            current = tempfile.mkdtemp(prefix="cohortline-ckpt-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
