"""Equi-joins against lookup tables.

Broadcasting, shuffling and skewed keys are the optimizer's and adaptive execution's choice. One
thing neither does: in a left join, rows whose key is null can never match, but all hash into one
partition. They are salted: the join runs on ``(key, salt)`` where a null-key row gets a salt in
1..N from a hash of the row and every lookup row has salt 0. The null rows spread over the
partitions, still never match, and the input is scanned once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Partitions the null-key rows of a shuffled left join are spread over.
NULL_KEY_SPREAD = 1024
_SALT = "_null_salt"


def lookup_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """``left LEFT JOIN right USING (on)`` for a lookup ``right``."""
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    salt = F.when(F.col(on).isNull(), F.pmod(row_hash, F.lit(NULL_KEY_SPREAD)) + 1).otherwise(F.lit(0))
    # The lookup's salt is 0 but must not be foldable: Catalyst would turn
    # "salt = 0" into a filter, drop it from the join keys, and null keys would
    # hash together again. pmod(hash, 1) is 0 for every row and is not folded.
    right_salt = F.pmod(F.xxhash64(F.col(on)), F.lit(1))
    return left.withColumn(_SALT, salt).join(right.withColumn(_SALT, right_salt), [on, _SALT], "left").drop(_SALT)


def union_all(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
