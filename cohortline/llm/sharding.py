"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded random order; row r of n gets the fractional rank
(r - u) / n, where u in (0, 1) is drawn for the source: with one u for all, the only rows of all
sources that have one would meet in one place. Sorted by fractional rank, every stretch of the
corpus holds all sources in proportion, so cutting the order into equal pieces gives shards that
match the mixture: of any source, two shards' numbers of rows differ by little more than one.

Ranks are exact without a single-task sort. A source's rows are split by the top bits of
their hash into cells, a row's rank is the number of rows in earlier cells plus its place in
its own; the same is done with cells of fractional rank. A source with a third of all rows
so spreads over 4,096 cells. The tables of cell sizes are bounded: 4,096 rows a source, and
``RANK_CELLS`` rows in all for the second (broadcast).

Law ``rows``: shard sizes are at most one row apart.

Defined results: a null source is a source of its own; the order is drawn from the whole row, so
rows that share an id or have none spread like others; rows equal in every column each get a
place; texts play no part but for that; an empty table stays empty; an input
column with the name of an added one is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.llm.common import col, saved, without

HASH_BITS = 12             # 4,096 cells a source
RANK_CELLS = 16_384        # cells of fractional rank; their sizes are broadcast


def interleave(docs: DataFrame, n_shards: int, source: str = "source", id_col: str = "doc_id",
               seed: int = 17) -> DataFrame:
    """``docs`` plus ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in each shard)."""
    names = [n for n in ("shard", "slot") if n not in (source, id_col)]
    rows = without(docs, names)
    keep = rows.columns
    rows = rows.withColumns({
        "__source": F.coalesce(F.concat(F.lit("="), col(source).cast("string")), F.lit("-")),
        "__hash": F.xxhash64(F.lit(seed), col(id_col), *[col(c) for c in keep]),
    }).withColumn("__cell", F.shiftrightunsigned("__hash", 64 - HASH_BITS))

    by_source = Window.partitionBy("__source")
    cells = (
        rows.groupBy("__source", "__cell").agg(F.count("*").alias("__n"))
        .withColumn("__before", F.sum("__n").over(by_source.orderBy("__cell")) - F.col("__n"))
        .withColumn("__of", F.sum("__n").over(by_source))
    )
    in_cell = Window.partitionBy("__source", "__cell").orderBy("__hash")
    phase = (F.pmod(F.xxhash64(F.lit(seed), F.lit("phase"), "__source"), F.lit(1 << 20)) + 0.5) / (1 << 20)
    ranked = (
        rows.join(cells, ["__source", "__cell"])
        .withColumn("__rank", F.col("__before") + F.row_number().over(in_cell))
        .withColumn("__part", (F.col("__rank") - phase) / F.col("__of"))
        .withColumn("__slice", F.floor(F.col("__part") * RANK_CELLS))
        .select(*[col(c) for c in keep], "__source", "__rank", "__part", "__slice")
    )
    ranked = saved(ranked)
    total = Window.partitionBy(F.lit(0))  # RANK_CELLS rows at most
    slices = (
        ranked.groupBy("__slice").agg(F.count("*").alias("__n"))
        .withColumn("__before", F.sum("__n").over(total.orderBy("__slice")) - F.col("__n"))
        .withColumn("__total", F.sum("__n").over(total))
    )
    in_slice = Window.partitionBy("__slice").orderBy("__part", F.xxhash64(F.lit(seed), "__source"), "__source", "__rank")
    return (
        ranked.join(F.broadcast(slices), "__slice")
        .withColumn("__place", F.col("__before") + F.row_number().over(in_slice) - 1)
        .withColumn("shard", F.expr(f"cast(__place * {n_shards} div __total as int)"))
        .withColumn("slot", F.expr(f"__place - (cast(shard as long) * __total + {n_shards - 1}) div {n_shards}"))
        .select(*[col(c) for c in keep], "shard", "slot")
    )


def write(shards: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per shard; each file holds a stretch of slots in order."""
    part = F.expr(f"slot div {rows_per_file}")
    (shards.withColumn("__part", part).repartition("shard", "__part").sortWithinPartitions("shard", "slot")
     .drop("__part").write.partitionBy("shard").parquet(path))
