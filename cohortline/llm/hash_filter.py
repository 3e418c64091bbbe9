"""Rows whose 64-bit hash may be among wanted ones, found without shuffling the rows.

The wanted hashes set two bits each in bitmaps of 32,768 bits, with 16 bits for each hash up to
``MAX_BLOCKS`` bitmaps: at most 128 MB, whatever the input, so they are broadcast. A filter too
small for its input lets more rows pass; a join on the hash behind it decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import col, saved

BLOCK_BITS = 32_768     # bits of one bitmap of Spark's bitmap functions
BITS_PER_HASH = 16
MAX_BLOCKS = 32_768     # of 4 KB each


def _places(value: Column, blocks: int) -> tuple[Column, Column, Column]:
    """Block and the two bits in it of a hash."""
    return (F.pmod(value, F.lit(blocks)), F.pmod(F.shiftrightunsigned(value, 19), F.lit(BLOCK_BITS)),
            F.pmod(F.shiftrightunsigned(value, 41), F.lit(BLOCK_BITS)))


def _is_set(bit: str) -> Column:
    byte = f"cast(conv(hex(substring(__bits, cast({bit} div 8 as int) + 1, 1)), 16, 10) as int)"
    return F.expr(f"shiftright({byte}, cast({bit} % 8 as int)) & 1 = 1")


def among(rows: DataFrame, hash_col: str, wanted: DataFrame, wanted_hash: str) -> DataFrame:
    """``rows`` plus ``__among``: false where the hash is certainly none of ``wanted`` (a saved
    table: it is read twice)."""
    blocks = min(MAX_BLOCKS, max(1, -(-wanted.count() * BITS_PER_HASH // BLOCK_BITS)))
    block, first, second = _places(col(wanted_hash), blocks)
    bitmaps = saved(wanted.select(block.alias("__block"), F.explode(F.array(first, second)).alias("__bit"))
                    .groupBy("__block").agg(F.bitmap_construct_agg("__bit").alias("__bits")))
    block, first, second = _places(col(hash_col), blocks)
    probed = rows.withColumns({"__block": block, "__first": first, "__second": second})
    found = F.coalesce(_is_set("__first") & _is_set("__second"), F.lit(False))
    return (probed.join(F.broadcast(bitmaps), "__block", "left").withColumn("__among", found)
            .drop("__block", "__first", "__second", "__bits"))
