"""Reading raw tables by prefix.

A table is named by a prefix such as ``hosp/admissions``; the file is the first of
``<prefix>.csv.gz``, ``<prefix>.csv``, ``<prefix>.parquet`` that exists. CSV is read
with its header and every column as text (no inference pass over the data); the
declared schema then casts columns by name, so column order in the file does not
matter and malformed numbers become null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortline.sources import csv_records, files

# Accepted suffixes in priority order.
SUFFIXES = (".csv.gz", ".csv", ".parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, path)


def resolve_prefix(spark: SparkSession, input_dir: str, prefix: str) -> tuple[str, str]:
    """(path, format) of the table ``prefix`` under ``input_dir``; FileNotFoundError if none."""
    base = input_dir.rstrip("/")
    for suffix in SUFFIXES:
        path = f"{base}/{prefix}{suffix}"
        if path_exists(spark, path):
            return path, suffix.lstrip(".")
    raise FileNotFoundError(f"no {'/'.join(SUFFIXES)} file for table {prefix!r} under {input_dir}")


def discover_prefixes(spark: SparkSession, input_dir: str) -> list[str]:
    """Every table prefix under ``input_dir``, each table once whatever its formats.

    A table is a file, or a folder of part files (as Spark writes it), whose name
    ends in one of SUFFIXES; hidden and ``_``-prefixed entries are skipped. Folders are
    looked into level by level, table folders never, however many parts they hold.
    """
    found, level = set(), [""]
    while level:
        deeper = []
        for folder in level:
            for name, is_folder in files.entries(spark, f"{input_dir.rstrip('/')}/{folder}"):
                if name.startswith((".", "_")):
                    continue
                suffix = next((s for s in SUFFIXES if name.endswith(s) and len(name) > len(s)), None)
                if suffix:
                    found.add(folder + name[: -len(suffix)])
                elif is_folder:
                    deeper.append(f"{folder}{name}/")
        level = deeper
    return sorted(found)


TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType)


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = True, add_absent: bool = True) -> DataFrame:
    """Declared columns by name with declared types; absent ones as typed nulls, or left out.

    Dates and times are declared as text, for that is what CSV holds. A file that has them typed
    keeps its type: time parsing passes it through, all else casts."""
    current_schema = df.schema  # one JVM round trip
    current_types = {f.name: f.dataType for f in current_schema.fields}
    cols = []
    for f in schema.fields:
        if f.name in current_types:
            src = F.col(f"`{f.name}`")
            current = current_types[f.name]
            if current == f.dataType:
                cols.append(src.alias(f.name))
            elif isinstance(f.dataType, T.StringType) and isinstance(current, TEMPORAL):
                # a typed file's times stay what they are, fractions of seconds included
                cols.append(src.cast("timestamp_ntz").alias(f.name) if isinstance(current, T.TimestampType)
                            else src.alias(f.name))
            elif isinstance(f.dataType, T.StringType):
                cols.append(src.cast("string").alias(f.name))
            else:
                cols.append(src.try_cast(f.dataType).alias(f.name))
        elif add_absent:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    declared = {f.name for f in schema.fields}
    extra = [F.col(f"`{c}`") for c in current_types if c not in declared] if keep_extra else []
    return df.select(*cols, *extra)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             multiline: bool = True) -> DataFrame:
    """CSV with header; ``"`` escapes ``"`` (T6). Text columns unless a schema is
    declared (cast by name). Quoted fields may
    hold newlines: a plain file is read by many tasks all the same (``csv_records``), a
    gzipped one is a task by nature. ``multiline=False`` saves the look at the quotes."""
    reader = spark.read.option("header", "true").option("escape", '"')
    if multiline and not path.endswith(".gz"):
        df = csv_records.read(spark, path)
    else:
        df = reader.option("multiLine", str(multiline).lower()).csv(path)
    return conform(df, schema) if schema is not None else df


def read_table(spark: SparkSession, input_dir: str, prefix: str, schema: T.StructType | None = None,
               columns: list[str] | None = None, add_absent: bool = True) -> DataFrame:
    """The table ``prefix`` in whichever format wins (A1); ``columns`` prunes (A5)."""
    path, fmt = resolve_prefix(spark, input_dir, prefix)
    df = spark.read.parquet(path) if fmt == "parquet" else read_csv(spark, path)
    df = conform(df, schema, add_absent=add_absent) if schema is not None else df
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df
