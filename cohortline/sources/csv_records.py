"""CSV with quoted newlines, read by many tasks (A3, A4, A10).

A record may hold newlines inside quotes, so a byte range of a file cannot know by itself whether
it starts inside a quoted field. Lines can be read from any range, though, and a line is a function
of the state before it (outside or inside quotes) to the state behind it; so is a range, by
composition. Three narrow passes over Spark's own splits of the files:

1. Per split, natively: how many lines hold a quote. Without any, every line is a record.
   Otherwise the lines with a quote (only those go to Python) give the split's function.
2. The functions are composed along each file by windows over one row a split: the state at every
   split's start. Each split then joins its lines to records from its first true record on, and
   ``from_csv`` parses them in the JVM.
3. Only if a split starts inside quotes: the records across the split's edges are put together
   from their fragments, a few rows a split.

The splits must be those of the first pass in all of them. The session's minimum split count is
pinned for that, and a split without a known state stops the job instead of losing rows.

Quotes are doubled inside quoted fields. A quote that does not start a field is text, and text
behind a closing quote runs to the next delimiter, as the CSV parser reads them. A quote left open
at the end of a file ends there. Lines end with LF or CR LF, and line ends inside quotes are kept
as they are; empty lines between records are skipped. A record must fit into a task's memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortline.session import checkpoint_dir

SPLIT_COUNT = "spark.sql.files.minPartitionNum"
SPLIT = ["__file", "__block", "__length"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in file order within each split, and the split they are in."""
    if spark.conf.get(SPLIT_COUNT, None) is None:
        spark.conf.set(SPLIT_COUNT, str(spark.sparkContext.defaultParallelism))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("__line"), F.xxhash64("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"), F.col("_metadata.file_block_length").alias("__length"))


class Quotes:
    """What a line does to the state: patterns for one delimiter."""

    def __init__(self, delimiter: str = ","):
        d = re.escape(delimiter)
        body = '(?:[^"]|"")*'
        closed = f'"(?:[^{d}"][^{d}]*)?'                       # a closing quote and what follows it in its field
        field = f'(?:"{body}{closed}|[^{d}"][^{d}]*|)'
        self.opens = f'^(?:{field}{d})*"{body}$'              # outside before, inside behind
        self.stays = f'^{body}$|^{body}{closed}{d}(?:{field}{d})*"{body}$'    # inside before and behind

    def behind(self, lines: pa.Array, inside: bool) -> tuple[np.ndarray, bool]:
        """State before every line, and the state behind the last one."""
        before = np.full(len(lines), inside)
        quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
        if not len(quoted):
            return before, inside
        texts = lines.take(pa.array(quoted))
        opens = pc.match_substring_regex(texts, self.opens).to_numpy(zero_copy_only=False)
        if not inside and not opens.any():
            return before, inside
        stays = pc.match_substring_regex(texts, self.stays).to_numpy(zero_copy_only=False)
        for at, if_outside, if_inside in zip(quoted.tolist(), opens.tolist(), stays.tolist()):
            state = if_inside if inside else if_outside
            if state != inside:
                before[at + 1:] = inside = state
        return before, inside


def _runs(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, pa.Array]]:
    """(values of ``columns``, lines) of stretches of one split, in file order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("__file", "__block")]
        cuts = np.flatnonzero((np.diff(keys[0]) != 0) | (np.diff(keys[1]) != 0)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield (tuple(batch.column(c)[start].as_py() for c in columns),
                   batch.column("__line").slice(start, end - start))


def _functions(lines: DataFrame, quotes: Quotes) -> DataFrame:
    """Per split with a quoted line: the state at its end from either state at its start, and
    whether a record that starts in it goes over several lines."""
    def scan(batches):
        split, ends, breaks = None, [False, True], False
        for key, texts in _runs(batches, SPLIT):
            if key != split:
                if split is not None:
                    yield split, ends, breaks
                split, ends, breaks = key, [False, True], False
            breaks = breaks or pc.any(pc.match_substring_regex(texts, quotes.opens)).as_py()
            ends = [quotes.behind(texts, state)[1] for state in ends]
        if split is not None:
            yield split, ends, breaks

    def rows(batches):
        for split, ends, breaks in scan(batches):
            yield pa.RecordBatch.from_pylist([dict(zip((*SPLIT, "if_out", "if_in", "breaks"), (*split, *ends, breaks)))])

    return lines.filter(F.col("__line").contains('"')).mapInArrow(
        rows, "__file bigint, __block bigint, __length bigint, if_out boolean, if_in boolean, breaks boolean")


def _states(splits: DataFrame, functions: DataFrame) -> DataFrame:
    """Every split with ``starts_in`` and ``ends_in``: inside quotes at its start and end.

    A split keeps the state, swaps it, or sets it. The state at a start is that of the last split
    before that set it (outside at the file's start), swapped as often as splits since then did."""
    known = splits.join(functions, SPLIT, "left").withColumns({
        "sets": F.when(F.col("if_out") == F.col("if_in"), F.col("if_out").cast("int")),
        "swaps": F.coalesce(F.col("if_out") & ~F.col("if_in"), F.lit(False)).cast("int")})
    order = Window.partitionBy("__file").orderBy("__block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("swapped", F.sum("swaps").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    since = (F.coalesce(F.sum("swaps").over(before), F.lit(0))
             - F.coalesce(F.last(F.when(F.col("sets").isNotNull(), F.col("swapped")), ignorenulls=True).over(before), F.lit(0)))
    state = (F.coalesce(F.last("sets", ignorenulls=True).over(before), F.lit(0)) + since) % 2 == 1
    known = known.withColumn("starts_in", state)
    after = F.lead("starts_in").over(order)
    return known.select(*SPLIT, "starts_in", F.coalesce(after, F.lit(False)).alias("ends_in"), after.isNull().alias("is_last"),
                        F.coalesce("breaks", F.lit(False)).alias("breaks"))


class _Split:
    """Records of one split as its lines come."""

    def __init__(self, quotes: Quotes, starts_in: bool):
        self.quotes, self.inside = quotes, starts_in
        self.head: list[pa.Array] = []     # lines of a record begun in a split before
        self.in_head = starts_in
        self.open: list[pa.Array] = []     # lines of a record not yet ended
        self.records = 0

    def feed(self, lines: pa.Array) -> pa.Array:
        """Records that end in these lines; those of the open one come first."""
        before, self.inside = self.quotes.behind(lines, self.inside)
        starts = np.flatnonzero(~before)
        if self.in_head:
            first = int(starts[0]) if len(starts) else len(lines)
            self.head.append(lines.slice(0, first))
            self.in_head = first == len(lines) and self.inside
            lines, starts = lines.slice(first), starts - first
        elif self.open:
            kept = pa.concat_arrays(self.open)
            lines = pa.concat_arrays([kept, lines])
            starts = np.concatenate([[0], starts + len(kept)])
        self.open = []
        if self.inside and len(starts):
            self.open = [lines.slice(int(starts[-1]))]
            lines, starts = lines.slice(0, int(starts[-1])), starts[:-1]
        self.records += len(starts)
        if len(starts) == len(lines):
            return lines
        offsets = pa.array(np.append(starts, len(lines)).astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")


def _joined(parts: list[pa.Array]) -> str:
    return "\n".join(pa.concat_arrays(parts).to_pylist())


def _whole_records(lines: DataFrame, quotes: Quotes) -> DataFrame:
    """Records that start and end in one split, header records left out."""
    def out(records):
        return pa.RecordBatch.from_arrays([records.cast(pa.string())], names=["__record"])

    def rows(batches):
        key = split = None

        def rest():
            if split is not None and split.open and key[4]:     # a quote open at the end of the file
                is_header = key[1] == 0 and not split.records
                yield out(pa.array([] if is_header else [_joined(split.open)], pa.string()))

        for now, texts in _runs(batches, [*SPLIT, "starts_in", "is_last"]):
            if now != key:
                yield from rest()
                if now[3] is None:
                    raise RuntimeError("the files or their splits changed while they were read")
                key, split = now, _Split(quotes, now[3])
            begun = split.records
            records = split.feed(texts)
            yield out(records.slice(1) if begun == 0 and key[1] == 0 and len(records) else records)
        yield from rest()

    return lines.mapInArrow(rows, "__record string")


def _fragments(lines: DataFrame, quotes: Quotes) -> DataFrame:
    """Pieces of the records that go over a split's edge."""
    def rows(batches):
        key = split = None

        def pieces():
            if split is None:
                return
            found = []
            if split.head:
                found.append({"opens": False, "header": False, "piece": _joined(split.head)})
            if split.open:
                found.append({"opens": True, "header": key[1] == 0 and not split.records, "piece": _joined(split.open)})
            for f in found:
                yield pa.RecordBatch.from_pylist([{"__file": key[0], "__block": key[1], **f}])

        for now, texts in _runs(batches, [*SPLIT, "starts_in"]):
            if now != key:
                yield from pieces()
                key, split = now, _Split(quotes, now[3])
            split.feed(texts)
        yield from pieces()

    return lines.mapInArrow(rows, "__file bigint, __block bigint, opens boolean, header boolean, piece string")


def _across(fragments: DataFrame) -> DataFrame:
    """Fragments put together: each belongs to the record opened last before it."""
    order = Window.partitionBy("__file").orderBy("__block", "opens")
    begun = F.last(F.when(F.col("opens"), F.col("__block")), ignorenulls=True).over(order)
    pieces = F.array_sort(F.collect_list(F.struct("__block", "opens", "piece")))
    return (fragments.withColumn("__begun", begun).groupBy("__file", "__begun")
            .agg(F.max("header").alias("header"), pieces.alias("pieces")).filter(~F.col("header"))
            .select(F.array_join(F.transform("pieces", lambda p: p["piece"]), "\n").alias("__record")))


def read(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """The plain CSV file or folder ``path`` with a header, every column as text, its rows those of
    a reader that takes each file whole."""
    reader = spark.read.option("header", "true").option("escape", '"').option("sep", delimiter)
    checkpoint_dir(spark)
    lines = _lines(spark, path)
    splits = lines.groupBy(*SPLIT).agg(F.sum(F.col("__line").contains('"').cast("long")).alias("quoted")).checkpoint()
    if splits.filter("quoted > 0").isEmpty():
        return reader.csv(path)
    quotes = Quotes(delimiter)
    states = _states(splits, _functions(lines, quotes)).checkpoint()
    if states.filter("breaks OR starts_in").isEmpty():
        return reader.csv(path)
    # one row a split: at most the input's bytes over the split size
    tagged = lines.join(F.broadcast(states.select(*SPLIT, "starts_in", "ends_in", "is_last")), SPLIT, "left")
    records = _whole_records(tagged, quotes)
    if not states.filter("starts_in").isEmpty():
        records = records.unionByName(_across(_fragments(tagged.filter("starts_in OR ends_in"), quotes)))
    names = reader.option("multiLine", "true").csv(path).columns
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    line = F.regexp_replace("__record", "\r\\z", "")
    parsed = F.from_csv(line, schema, {"escape": '"', "sep": delimiter, "multiLine": "true"})
    return records.filter(F.trim(line) != "").select(parsed.alias("__row")).select("__row.*")
