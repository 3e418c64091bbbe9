"""Exact deduplication: a two-pass Bloom filter finds possibly repeated texts; only those
rows are shuffled.

Pass 1 hashes every text to two slots of a blocked Bloom filter. Rows per slot are counted
with map-side partial sums, so only slot numbers travel; slots hit twice or more become the
bitmaps of the filter of *possibly repeated* texts. Its size is at most ``MAX_BLOCKS`` x
4 KB (128 MB), whatever the input, so it may be broadcast. Pass 2 reads the rows again: a row
whose two slots are not both set occurs once and passes straight through. The others, true
repeats and a few false alarms, are compared by SHA-256 of the text.

A filter too small for its input only raises the share of false alarms, never the result.
The counting is an aggregate with partial sums, so a hot text is one row per map task.

Defined results: a null text counts as empty, texts are equal when identical; the row with
the largest id stays. Rows that repeat both id and text are the same document: ``mark``
returns each of them, all kept or all dropped, ``dedup`` returns one. A null id is smaller
than any other. Long texts are hashed whole; an empty table stays empty; extra columns are
carried by ``dedup`` and ignored by ``mark``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import col, saved, whole_text

BLOCK_BITS = 32_768          # bits of one bitmap of Spark's bitmap functions
BITS_PER_ROW = 16            # filter bits for each row, up to MAX_BLOCKS
MAX_BLOCKS = 32_768          # at most 32,768 bitmaps of 4 KB: 128 MB


def _slots(text: Column, blocks: int) -> tuple[Column, Column, Column]:
    """Block and the two bits in it of a text's 64-bit hash."""
    h = F.xxhash64(text)
    return (
        F.pmod(h, F.lit(blocks)),
        F.pmod(F.shiftrightunsigned(h, 17), F.lit(BLOCK_BITS)),
        F.pmod(F.shiftrightunsigned(h, 37), F.lit(BLOCK_BITS)),
    )


def repeat_filter(texts: DataFrame, text: Column, blocks: int) -> DataFrame:
    """(block, bitmap): bits of the slots that two or more rows hit."""
    block, first, second = _slots(text, blocks)
    slot = F.explode(F.array_distinct(F.array(
        block * BLOCK_BITS + first, block * BLOCK_BITS + second))).alias("slot")
    return (
        texts.select(slot)
        .groupBy("slot").agg(F.count("*").alias("n"))
        .filter("n > 1")
        .groupBy(F.expr(f"slot div {BLOCK_BITS}").alias("__block"))
        .agg(F.bitmap_construct_agg(F.col("slot") % BLOCK_BITS).alias("__bitmap"))
    )


def _bit(bit: str) -> Column:
    return F.expr(f"shiftright(cast(conv(hex(substring(__bitmap, cast({bit} div 8 as int) + 1, 1)), 16, 10) as int), "
                  f"cast({bit} % 8 as int)) & 1")


def flagged(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``__repeated``: false where the text certainly occurs once."""
    rows = docs.count()
    blocks = min(MAX_BLOCKS, max(1, -(-rows * BITS_PER_ROW // BLOCK_BITS)))
    content = whole_text(text)
    bitmaps = saved(repeat_filter(docs, content, blocks))
    block, first, second = _slots(content, blocks)
    probed = docs.withColumns({"__block": block, "__first": first, "__second": second})
    return (
        probed.join(F.broadcast(bitmaps), "__block", "left")
        .withColumn("__repeated", F.coalesce((_bit("__first") == 1) & (_bit("__second") == 1), F.lit(False)))
        .drop("__block", "__first", "__second", "__bitmap")
    )


def mark(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    rows = flagged(docs.select(col(id_col).alias(id_col), col(text).alias("__text")), "__text")
    digest = F.sha2(whole_text("__text").cast("binary"), 256).alias("text_sha256")
    single = rows.filter(~F.col("__repeated")).select(
        col(id_col), col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), digest)
    # narrow rows, written once: both sides of the join below read them
    repeated = saved(rows.filter("__repeated").select(col(id_col), digest))
    groups = repeated.groupBy("text_sha256").agg(
        F.max(col(id_col)).alias("keep_id"), F.count("*").alias("group_size"))
    decided = repeated.join(groups, "text_sha256").select(
        col(id_col), "keep_id", "group_size", col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return single.unionByName(decided)


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, whole: one of each group of equal texts."""
    rows = flagged(docs, text)
    whole = F.struct(*[col(c) for c in docs.columns])
    kept = (
        rows.filter("__repeated")
        .groupBy(F.sha2(whole_text(text).cast("binary"), 256))
        .agg(F.max_by(whole, F.struct(col(id_col), F.xxhash64(*[col(c) for c in docs.columns]))).alias("__row"))
        .select("__row.*")
    )
    return rows.filter(~F.col("__repeated")).drop("__repeated").unionByName(kept)
