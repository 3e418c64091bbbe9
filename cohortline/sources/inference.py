"""Types of columns that no schema declares (A3).

What is known of a column is the set of kinds its values have: whole numbers, other numbers,
booleans, text. Sets are merged by union, which neither order nor repetition changes, so they are
found by one aggregate over all values with partial sums: first per file, then over the files. The
type is the narrowest that holds every kind:

    nothing -> string      whole -> bigint      whole, other numbers -> double      boolean -> boolean
    anything else -> string

Digits with a leading zero are text (they are codes), as are numbers too long for 64 bits. Empty
values say nothing. Files that alone would have another type are reported as conflicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHOLE, NUMBER, BOOLEAN, TEXT = 1, 2, 4, 8

_WHOLE = r"^[+-]?(0|[1-9][0-9]{0,17})\z"
_NUMBER = r"^[+-]?((0|[1-9][0-9]*)\.[0-9]*|\.[0-9]+|(0|[1-9][0-9]*)(\.[0-9]*)?[eE][+-]?[0-9]+)\z"


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def kind(value: Column) -> Column:
    """The kind of one text value; null for an empty one."""
    return (F.when(value.isNull() | (value == ""), F.lit(None).cast("int"))
            .when(value.rlike(_WHOLE), WHOLE).when(value.rlike(_NUMBER), NUMBER)
            .when(F.lower(value).isin("true", "false"), BOOLEAN).otherwise(TEXT))


def type_of(kinds: Column) -> Column:
    """The type that holds a set of kinds."""
    return (F.when(kinds == WHOLE, "bigint").when(kinds.isin(NUMBER, WHOLE | NUMBER), "double")
            .when(kinds == BOOLEAN, "boolean").otherwise("string"))


def file_kinds(df: DataFrame) -> DataFrame:
    """``file, column, kinds`` of every text column in every file that ``df`` reads."""
    names = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not names:
        return df.sparkSession.createDataFrame([], "file string, column string, kinds int")
    # aggregates are named by position: a column's name may hold anything
    held = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *[F.coalesce(F.bit_or(kind(_col(n))), F.lit(0)).alias(f"k{i}") for i, n in enumerate(names)])
    pairs = [F.struct(F.lit(n).alias("column"), F.col(f"k{i}").alias("kinds")) for i, n in enumerate(names)]
    return held.select("file", F.inline(F.array(*pairs)))


def column_types(kinds: DataFrame) -> DataFrame:
    """``column, type`` over all files."""
    return kinds.groupBy("column").agg(F.bit_or("kinds").alias("kinds")).select("column", type_of(F.col("kinds")).alias("type"))


def conflicts(kinds: DataFrame) -> DataFrame:
    """``column, type, file, file_type`` of the files with values that alone have another type."""
    files = kinds.filter("kinds > 0").select("column", "file", type_of(F.col("kinds")).alias("file_type"))
    return files.join(column_types(kinds), "column").filter("file_type <> type").select("column", "type", "file", "file_type")


def typed(df: DataFrame) -> DataFrame:
    """``df``, a read of files, with its text columns cast to their types; empty values of columns
    that are no text become null."""
    types = {r["column"]: r["type"] for r in column_types(file_kinds(df)).collect()}    # a row a column
    return df.select(*[
        _col(c) if types.get(c, "string") == "string" else F.nullif(_col(c), F.lit("")).cast(types[c]).alias(c)
        for c in df.columns])
