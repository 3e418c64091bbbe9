"""Mixing sources to target weights by Poisson replication.

A source with target weight w and n rows, in a mixture of T rows, has mean repetition rate
w T / n. Each document gets a uniform number from a seeded hash of its id and inverts the
Poisson distribution with that mean; it is exploded into that many copies, and all copies
are shuffled globally by a seeded hash of (id, copy). Every document's count depends on
its id, the seed and its source's rate alone, so reruns and lost executors change nothing.

A rate over ``STEP`` is drawn as a sum of independent Poisson numbers of at most that mean
each, so no table of the distribution has more than about 150 entries. Rates are one row per
source; they are broadcast when there are at most ``BROADCAST_SOURCES`` (a few MB), else
joined by a shuffle with a salt, so that a hot source spreads.

Defined results: a null source is a source of its own; a source without a weight, or with
weight 0, gives no rows; rows that repeat an id get the same count; a null id is an id;
texts play no part; an empty table stays empty; an input column with the name of an added
one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import col, saved, without

STEP = 32.0
BROADCAST_SOURCES = 2_000     # a row holds about 150 doubles: 2.4 MB in all
SALTS = 64
SEED = 2024
TEMPERATURE = 0.7


def source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), col(source).cast("string")), F.lit("-"))


def temperature_weights(docs: DataFrame, source: str = "source", temperature: float = TEMPERATURE) -> DataFrame:
    """(source, weight): weights in proportion to rows ** temperature."""
    return docs.groupBy(col(source).alias("source")).agg(
        F.pow(F.count("*").cast("double"), F.lit(temperature)).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, source: str = "source", rows: int | None = None) -> DataFrame:
    """(__source, __steps, __cdf): draws per document and the distribution of each draw.

    ``weights`` has columns ``source`` and ``weight`` (scaled to sum 1 over the sources that
    occur); ``rows`` is the wanted size of the mixture, by default that of ``docs``."""
    counts = docs.groupBy(source_key(source).alias("__source")).agg(F.count("*").alias("__n"))
    wanted = (
        weights.select(source_key("source").alias("__source"), F.col("weight").cast("double").alias("__w"))
        .filter("__w > 0").groupBy("__source").agg(F.sum("__w").alias("__w"))
    )
    table = counts.join(wanted, "__source")
    sums = table.agg(F.sum("__w").alias("__all"))
    total = counts.agg(F.sum("__n").alias("__rows")) if rows is None else None
    table = table.join(F.broadcast(sums))
    table = table.join(F.broadcast(total)) if rows is None else table.withColumn("__rows", F.lit(rows).cast("long"))
    mean = F.col("__w") / F.col("__all") * F.col("__rows") / F.col("__n")
    return (
        table.withColumn("__rate", mean)
        .withColumn("__steps", F.ceil(F.col("__rate") / STEP))
        .withColumn("__mu", F.col("__rate") / F.col("__steps"))
        .withColumn("__cdf", F.expr("""
            aggregate(
                sequence(1, cast(ceil(__mu + 12 * sqrt(__mu) + 30) as int)),
                named_struct('t', exp(-__mu), 'c', array(exp(-__mu))),
                (s, k) -> named_struct('t', s.t * __mu / k, 'c', array_append(s.c, element_at(s.c, -1) + s.t * __mu / k)),
                s -> s.c)"""))
        .select("__source", "__steps", "__cdf")
    )


def _uniform(key: Column) -> Column:
    """Uniform in [0, 1) from the first 52 bits of an MD5 hash."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def mix(docs: DataFrame, weights: DataFrame, source: str = "source", id_col: str = "doc_id",
        rows: int | None = None, seed: int = SEED) -> DataFrame:
    """Copies of ``docs`` in the wanted mixture, globally shuffled, plus ``copy`` (from 0) and
    ``n_copies`` (int)."""
    base = without(docs, [n for n in ("copy", "n_copies") if n not in (source, id_col)])
    keep = base.columns
    table = saved(rates(docs, weights, source, rows))
    keyed = base.withColumn("__source", source_key(source))
    if table.count() <= BROADCAST_SOURCES:
        joined = keyed.join(F.broadcast(table), "__source")
    else:
        salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = keyed.withColumn("__salt", F.pmod(F.xxhash64(col(id_col)), F.lit(SALTS)).cast("int")).join(
            salted, ["__source", "__salt"])
    key = F.coalesce(col(id_col).cast("string"), F.lit("null"))

    def draw(j: Column) -> Column:
        u = _uniform(F.concat_ws(":", F.lit(str(seed)), key, j.cast("string")))
        return F.size(F.filter("__cdf", lambda c: u >= c))

    count = F.aggregate(F.sequence(F.lit(1).cast("long"), F.col("__steps")), F.lit(0), lambda n, j: n + draw(j))
    copies = (
        joined.withColumn("n_copies", count).filter("n_copies > 0")
        .select(*[col(c) for c in keep], "n_copies")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)))
        .withColumn("__order", F.xxhash64(F.lit(seed), key, F.col("copy")))
    )
    return copies.repartition("__order").sortWithinPartitions("__order").select(
        *[col(c) for c in keep], "copy", "n_copies")
