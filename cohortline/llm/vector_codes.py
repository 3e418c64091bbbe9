"""Compression of vectors to short codes by product quantization in integers.

A vector is scaled to integers and cut into equal consecutive parts; each part is replaced by the
number of the nearest entry of its position's codebook. Codebooks start as the vectors with the
smallest ids and are refined by rounds of assignment and averaging.

Method of the nearest-entry search: slices and bit masks. Per dimension the entries' coordinates
are sorted, and for every prefix of that order a mask of 64-bit words says which entries are in it.
A radius r selects by two binary searches the range [x - r, x + r] of each dimension; the range's
entries are the difference of two prefix masks, and the AND over the dimensions is exactly the set
of entries in the cube around x. Every entry within distance r is in the cube, so the best
candidate is the nearest entry as soon as its distance is at most r; until then r grows to the best
distance found, or doubles. The first radius comes from the codebook (later from the errors of the
round before) and has no influence on results. Distances are exact integers; of equally near
entries the one with the lower index is taken.

Spark: a round is one scan of ids and vectors. Each task sums its parts by (position, entry) and
emits at most one row for each; those are added up by a hash aggregate. The driver holds the
codebooks only: ``entries`` vectors, whatever the input's size. A lost executor costs its tasks.

Defined results: rows whose vector is null, empty, or has null or non-finite components are
dropped, as are rows whose vector's length differs from that of the row with the smallest kept id;
null ids come last among the seeds, rows of one id by their vectors. With fewer kept rows than
entries the codebook is that much smaller; an empty table stays empty. If the length is no multiple
of ``parts``, the last part is filled up with zeros. Scaled components beyond +-2^24 count as
+-2^24, so that distances stay exact in 64 bits. Repeated rows are coded alike; input columns with
the names of added ones are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import col, without

LIMIT = 1 << 24          # scaled components saturate here
BLOCK_ROWS = 4096        # rows searched at once
FAR = np.iinfo(np.int64).max
HOT_SHARE = 1000         # a label with at least 1 / HOT_SHARE of the rows is hot: at most that many are


@dataclass(frozen=True)
class Shape:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


class Slices:
    """Exact nearest-entry search in one codebook (entries x dimensions, integers)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        count, dims = entries.shape
        words = -(-count // 64)
        self.sorted = np.sort(entries, axis=0).T.copy()
        order = np.argsort(entries, axis=0, kind="stable").T
        bits = np.zeros((count, words), np.uint64)
        bits[np.arange(count), np.arange(count) // 64] = np.uint64(1) << (np.arange(count, dtype=np.uint64) % np.uint64(64))
        self.prefix = np.zeros((dims, count + 1, words), np.uint64)
        for d in range(dims):
            self.prefix[d, 1:] = np.bitwise_or.accumulate(bits[order[d]], axis=0)
        self.largest = int(np.abs(entries).max(initial=1))

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks (points x words) of the entries in the cube of half-width ``radius``."""
        mask = None
        for d, line in enumerate(self.sorted):
            low = np.searchsorted(line, points[:, d] - radius, "left")
            high = np.searchsorted(line, points[:, d] + radius, "right")
            inside = self.prefix[d][high] ^ self.prefix[d][low]
            mask = inside if mask is None else mask & inside
        return mask

    def nearest(self, points: np.ndarray, first_radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each point, and the squared distance to it."""
        index = np.zeros(len(points), np.int64)
        error = np.full(len(points), FAR)
        radius = np.full(len(points), max(1, first_radius), np.int64)
        open_rows = np.arange(len(points))
        while len(open_rows):
            x, r = points[open_rows], radius[open_rows]
            masks = self.candidates(x, r).view(np.uint8)
            allowed = np.unpackbits(masks, axis=1, bitorder="little", count=len(self.entries)).view(bool)
            used = np.flatnonzero(allowed.any(axis=0))     # entries that are a candidate of any point
            if len(used):
                squares = self._squares(x, self.entries[used])
                far = np.inf if squares.dtype == np.float64 else FAR
                squares = np.where(allowed[:, used], squares, far)
                at = squares.argmin(axis=1)
                best = squares[np.arange(len(x)), at]
                best = np.where(best == far, FAR, np.where(best == far, 0, best).astype(np.int64))
                index[open_rows], error[open_rows] = used[at], best
            else:
                best = np.full(len(x), FAR)
            settled = best <= r * r
            radius[open_rows] = np.where(best == FAR, 2 * r, np.sqrt(np.minimum(best, 1 << 62)).astype(np.int64) + 1)
            open_rows = open_rows[~settled]
        return index, error

    def _squares(self, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Exact squared distances, by doubles where their 53 bits hold every term."""
        largest = max(self.largest, int(np.abs(x).max(initial=1)))
        kind = np.float64 if 4 * x.shape[1] * largest * largest < 1 << 53 else np.int64
        a, b = x.astype(kind), entries.astype(kind)
        return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)


@dataclass(frozen=True)
class Codebooks:
    """Entries (parts x entries x dimensions) and, per part, the radius where a search begins."""

    entries: np.ndarray
    radii: tuple[int, ...]
    length: int
    scale: int

    def sha256(self) -> str:
        """Digest of all components by part, entry and position, in decimal, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def searches(self) -> list[Slices]:
        return [Slices(e) for e in self.entries]


def _split(values: np.ndarray, parts: int, scale: int) -> np.ndarray:
    """Finite vectors (rows x length) as integer parts (rows x parts x dimensions)."""
    scaled = np.clip(np.floor(values * float(scale)), -LIMIT, LIMIT).astype(np.int64)
    dims = -(-values.shape[1] // parts)
    return np.pad(scaled, ((0, 0), (0, dims * parts - values.shape[1]))).reshape(len(values), parts, dims)


def _kept(batch: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of the vectors of a batch that are not dropped."""
    sizes = pc.fill_null(pc.list_value_length(batch), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == length)
    values = batch.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    values = values.reshape(len(rows), length)
    finite = np.isfinite(values).all(axis=1)
    return rows[finite], values[finite]


def _blocks(batch: pa.Array, books: Codebooks) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(batch), BLOCK_ROWS):
        rows, values = _kept(batch.slice(at, BLOCK_ROWS), books.length)
        if len(rows):
            with np.errstate(over="ignore"):
                yield at + rows, _split(values, books.entries.shape[0], books.scale)


def usable(vector: Column) -> Column:
    """Whether a vector is kept: not null or empty, and every component finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def _doubles(name: str) -> Column:
    return col(name).cast("array<double>")


def fit(vectors: DataFrame, shape: Shape = Shape(), vec_id: str = "vec_id", vector: str = "embedding") -> Codebooks | None:
    """Codebooks of ``vectors``; None if no row is kept."""
    points = vectors.select(col(vec_id).alias("id"), _doubles(vector).alias("v"))
    seeds = points.filter(usable(F.col("v"))).orderBy(F.col("id").asc_nulls_last(), "v").limit(1).collect()
    if not seeds:
        return None
    length = len(seeds[0]["v"])
    seeds = (points.filter(usable(F.col("v")) & (F.size("v") == length))
             .orderBy(F.col("id").asc_nulls_last(), "v").limit(shape.entries).collect())
    with np.errstate(over="ignore"):
        start = _split(np.array([s["v"] for s in seeds], np.float64), shape.parts, shape.scale)
    entries = np.ascontiguousarray(start.transpose(1, 0, 2))
    books = Codebooks(entries, _first_radii(entries), length, shape.scale)
    for _ in range(shape.rounds):
        books = _improved(points.select("v"), books)
    return books


def _first_radii(entries: np.ndarray) -> tuple[int, ...]:
    """Half the middle distance of an entry to the one after it: a guess, nothing depends on it."""
    steps = np.sqrt((np.diff(entries, axis=1).astype(np.float64) ** 2).sum(axis=2))
    return tuple(int(np.median(s)) // 2 if len(s) else 1 for s in steps)


def _improved(points: DataFrame, books: Codebooks) -> Codebooks:
    """One round: all parts assigned to their nearest entries, and entries moved to the means."""
    parts, entries, dims = books.entries.shape

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = books.searches()
        total, count = np.zeros((parts, entries, dims), np.int64), np.zeros((parts, entries), np.int64)
        errors = np.zeros((parts, entries), np.float64)
        for batch in batches:
            for _, points in _blocks(batch.column(0), books):
                for p, search in enumerate(searches):
                    index, error = search.nearest(points[:, p], books.radii[p])
                    count[p] += np.bincount(index, minlength=entries)
                    errors[p] += np.bincount(index, error, minlength=entries)
                    for d in range(dims):   # doubles hold a block's sums of up to 2^24 exactly
                        total[p, :, d] += np.bincount(index, points[:, p, d], minlength=entries).astype(np.int64)
        at = np.argwhere(count > 0).astype(np.int32)
        flat = total[at[:, 0], at[:, 1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[:, 0]), pa.array(at[:, 1]), pa.array(count[at[:, 0], at[:, 1]]),
             pa.array(errors[at[:, 0], at[:, 1]]), *(pa.array(flat[:, d]) for d in range(dims))],
            names=["part", "entry", "rows", "error", *(f"s{d}" for d in range(dims))])

    schema = "part int, entry int, rows bigint, error double, " + ", ".join(f"s{d} bigint" for d in range(dims))
    totals = points.mapInArrow(sums, schema).groupBy("part", "entry").agg(
        *(F.sum(c).alias(c) for c in ("rows", "error", *(f"s{d}" for d in range(dims)))))
    moved, spent, seen = books.entries.copy(), np.zeros(parts), np.zeros(parts)
    for part, entry, rows, error, *sums_ in totals.collect():    # at most parts * entries rows
        moved[part, entry] = np.array(sums_, np.int64) // rows
        spent[part] += error
        seen[part] += rows
    # most errors are less than twice the mean one
    radii = tuple(int(np.sqrt(2 * spent[p] / max(1, seen[p]))) + 1 for p in range(parts))
    return Codebooks(moved, radii, books.length, books.scale)


def encode(vectors: DataFrame, books: Codebooks | None, vector: str = "embedding") -> DataFrame:
    """Kept rows of ``vectors`` plus ``code`` (binary, one byte a part) and ``error`` (long)."""
    out = without(vectors, [n for n in ("code", "error", "__coded") if n != vector])
    if books is None:
        none = F.lit(None)
        return out.filter(F.lit(False)).withColumns({"code": none.cast("binary"), "error": none.cast("long")})
    if books.entries.shape[1] > 256:
        raise ValueError("a code byte names at most 256 entries")

    @F.arrow_udf("struct<code: binary, error: bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        searches = books.searches()
        for batch in batches:
            codes, errors = [None] * len(batch), [None] * len(batch)
            for rows, points in _blocks(batch, books):
                found = [s.nearest(points[:, p], books.radii[p]) for p, s in enumerate(searches)]
                packed = np.stack([f[0] for f in found], axis=1).astype(np.uint8)
                sums = sum(f[1] for f in found)
                for row, code, error in zip(rows.tolist(), packed, sums.tolist()):
                    codes[row], errors[row] = code.tobytes(), error
            yield pa.StructArray.from_arrays([pa.array(codes, pa.binary()), pa.array(errors, pa.int64())],
                                             names=["code", "error"])

    coded = out.withColumn("__coded", run(_doubles(vector))).filter(F.col("__coded.code").isNotNull())
    return coded.withColumns({"code": F.col("__coded.code"), "error": F.col("__coded.error")}).drop("__coded")


def decode(coded: DataFrame, books: Codebooks, code: str = "code") -> DataFrame:
    """``coded`` plus ``decoded`` (array of double): the entries that the code names, scaled back."""
    entries = books.entries

    @F.arrow_udf("array<double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if c is None else (
                np.concatenate([entries[p, i] for p, i in enumerate(c)])[:books.length] / books.scale).tolist()
                for c in batch.to_pylist()], pa.list_(pa.float64()))

    return without(coded, ["decoded"]).withColumn("decoded", run(col(code)))


def with_sums(coded: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``coded`` plus the sum of ``value`` over its rows with an equal ``key``, nulls together.

    ``coded`` is read several times: save it first. Rows of hot keys get their sum from a
    broadcast of at most HOT_SHARE rows, so none of them is shuffled; the others join by key."""
    rows = coded.count()
    sums = coded.groupBy(col(key).alias("__key")).agg(F.sum(col(value)).alias(name), F.count(F.lit(1)).alias("__rows"))
    hot = sums.filter(F.col("__rows") * HOT_SHARE >= rows).select("__key", name, F.lit(True).alias("__hot"))
    same = col(key).eqNullSafe(F.col("__key"))
    marked = without(coded, [name, "__key", "__hot"]).join(F.broadcast(hot), same, "left")
    rest = marked.filter(F.col("__hot").isNull()).drop("__key", "__hot", name)
    cold = sums.filter(F.col("__rows") * HOT_SHARE < rows).drop("__rows")
    return marked.filter("__hot").drop("__key", "__hot").unionByName(rest.join(cold, same).drop("__key"))
