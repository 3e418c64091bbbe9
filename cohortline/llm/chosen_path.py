"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of hashes of its five-word shingles. Documents with equal sets form a
class first (one grouped minimum, so thousands of copies cost one row). Each class has a
signature of 64 minwise tokens. Method:

1. ``TREES`` independent trees: the root of tree t selects one of the 64 token positions and
   sends each class to the child of its token there. A node of at most ``LEAF`` classes is a
   leaf. A larger one selects one further position from a hash of its path, and one in
   ``SECOND`` such nodes a second one; every class follows each, down to ``DEPTH`` levels. By
   calculation no tree holds a pair of similarity 0.85 in a common node with probability
   1.6e-6, 3.5e-5, 1.4e-4, 3.3e-4, 5.6e-4, 8.1e-4 at level 0 to 5 (closer pairs less); in a group
   that goes deeper than its roots a document usually has many partners.
2. Leaves are compared exhaustively on signatures, inside sorted partitions. Classes whose
   signatures could reach the threshold, directly or in a chain, form a unit; most trees find
   the same units, which are kept once.
3. A unit's members get their texts and are compared exhaustively on the full sets. Each unit
   returns a spanning forest of its links (at most one link per member, so a group of m near
   copies never gives m squared rows); links are joined to components.
4. A node that is still too large at the last level holds near copies that no token parts. It
   is cut into blocks that all contain the node's ``PIVOTS`` pivots, which tie the blocks
   together. Afterwards its classes outside its largest component meet every block, chunk by
   chunk. No pair is capped or skipped.

Texts are shuffled only if their class has a possible partner (but for the few that a bitmap of
the wanted hashes lets pass), and ``dedup`` shuffles rows only if they may go.

Defined results: null and empty texts and texts without words have an empty set and are
linked with nothing; texts of fewer than five words are one shingle; rows that repeat an id
and text have the same component, and ``dedup`` keeps one of them; rows that repeat only the
id are judged by their own text; a null id comes after all others and is no one's copy for
being null: a component of null ids only has a null ``component_id`` and keeps one text; long
texts are taken whole, their signature is built in blocks; extra columns are
carried by ``dedup`` and ignored by ``link``; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import bounded_batches, by_bytes, col, saved, whole_text
from cohortline.llm.components import components
from cohortline.llm.hash_filter import among

SHINGLE = 5
THRESHOLD = 85             # percent of the union
TOKENS = 64                # minwise tokens of a signature
TREES, DEPTH, SECOND = 8, 6, 2
LEAF, PIVOTS = 4096, 8
POSSIBLE = 40              # equal tokens of 64 below which 0.85 is out of the question (1e-5)
BLOCK = 8_192              # shingles or pairs handled per step, at most
TILE = 512                 # sets of a unit that meet all others at once
HELD_CELLS = 1 << 22       # cells of the matrix (set, shingle) held at once
HELD_PAIRS = 1 << 18       # possible pairs of a part kept before they are merged into groups
PART_BYTES = 2 << 20       # bytes of texts that are Python objects at once (a longer one is alone)

_SCRAMBLE = np.random.default_rng(20).integers(1 << 31, size=(TOKENS, 2), dtype=np.uint32)
_XOR, _ODD = _SCRAMBLE[:, :1], (_SCRAMBLE[:, 1:] << np.uint32(1)) | np.uint32(1)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; bytes.lower changes A-Z only and
    bytes.split cuts at ASCII white space."""
    words = text.encode("utf-8").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(SHINGLE, n)
    out = h[: n - size + 1].copy()
    for k in range(1, size):
        out = (out ^ (out >> np.uint64(29))) * _PRIME + h[k: n - size + 1 + k]
    out = (out ^ (out >> np.uint64(32))) * _PRIME + np.uint64(size)
    return np.unique(out ^ (out >> np.uint64(29)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least scrambled shingle for each of 64 scrambles."""
    low = (shingles >> np.uint64(16)).astype(np.uint32)
    best = np.full(TOKENS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), BLOCK):
        np.minimum(best, ((low[None, at: at + BLOCK] ^ _XOR) * _ODD).min(axis=1), out=best)
    return best


def _described(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in by_bytes(texts, PART_BYTES):
        n, cls, sig = [], [], []
        for text in part.to_pylist():
            s = shingle_set(text)
            n.append(len(s))
            cls.append(xxhash.xxh3_128_digest(s.tobytes()))
            sig.append(signature(s).tobytes() if len(s) else b"")
        yield pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.binary())], ["n", "cls", "sig"])


def _linked(sets: list[np.ndarray]) -> np.ndarray:
    """Whether two sets are linked, for all pairs; the sizes of their intersections are held
    for ``TILE`` sets at a time."""
    m, sizes = len(sets), np.array([len(x) for x in sets])
    shingle = np.concatenate(sets)
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], np.repeat(np.arange(m, dtype=np.int32), sizes)[order]
    new = np.r_[True, shingle[1:] != shingle[:-1]]
    often = ~(new & np.r_[new[1:], True])         # a shingle of one set is in no intersection
    owner, shingle = owner[often], np.cumsum(new[often]) - 1
    step, linked = min(BLOCK, max(1, HELD_CELLS // m)), np.zeros((m, m), bool)
    for lo in range(0, m, TILE):
        hi = min(lo + TILE, m)
        common = np.zeros((hi - lo, m - lo), np.int64)
        rest = owner >= lo                        # pairs with earlier sets are known
        owner, shingle = owner[rest], shingle[rest]
        for at in range(0, int(shingle[-1]) + 1 if len(shingle) else 0, step):
            a, b = np.searchsorted(shingle, (at, at + step))
            has = np.zeros((m - lo, step), np.float32)
            has[owner[a:b] - lo, shingle[a:b] - at] = 1
            common += (has[: hi - lo] @ has.T).astype(np.int64)
        linked[lo:hi, lo:] = 100 * common >= THRESHOLD * (sizes[lo:hi, None] + sizes[None, lo:] - common)
        linked[lo:, lo:hi] = linked[lo:hi, lo:].T
    return linked


def _forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning forest of the links between full sets, all pairs compared."""
    m = len(sets)
    if m == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if 100 * common >= THRESHOLD * (len(sets[0]) + len(sets[1]) - common) else []
    linked = _linked(sets)
    seen, out = np.zeros(m, bool), []
    for root in range(m):
        if seen[root]:
            continue
        seen[root], front = True, [root]
        while front:
            x = front.pop()
            fresh = np.flatnonzero(linked[x] & ~seen)
            seen[fresh] = True
            front.extend(fresh)
            out.extend((x, int(y)) for y in fresh)
    return out


def _token(sig: str, position: Column) -> Column:
    return F.substring(F.col(sig), (position * 4 + 1).cast("int"), F.lit(4))


def _children(level: int) -> Column:
    """Nodes that a class of an oversized node goes on to: one, of every SECOND-th node two."""
    def child(j: int) -> Column:
        position = F.pmod(F.xxhash64(F.lit(level), F.lit(j), "node"), F.lit(TOKENS))
        return F.xxhash64(F.col("node"), F.lit(j), _token("sig", position))

    two = F.pmod(F.xxhash64(F.lit("second"), "node"), F.lit(SECOND)) == 0
    return F.when(two, F.array(child(0), child(1))).otherwise(F.array(child(0)))


def _grow(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves and oversized last-level nodes of all trees: (node, cls, n, sig) rows each.

    Between levels only (node, cls) rows travel; signatures join where they are read."""
    pool = classes.select("cls", "n", "sig")
    roots = F.array(*[
        F.xxhash64(F.lit(t), _token("sig", F.lit(t * TOKENS // TREES))) for t in range(TREES)])
    members = classes.select("cls", F.explode(roots).alias("node"))
    leaves = None
    for level in range(DEPTH):
        sizes = members.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1")
        sized = saved(members.join(sizes, "node").select("node", "cls", "size"))
        leaf = sized.filter(F.col("size") <= LEAF).select("node", "cls")
        leaves = leaf if leaves is None else leaves.unionByName(leaf)
        large = sized.filter(F.col("size") > LEAF).select("node", "cls")
        if level == DEPTH - 1 or large.isEmpty():
            break
        if level == 0:   # deeper levels hold no other classes
            hot = saved(large.select("cls").distinct().join(pool, "cls"))
        members = large.join(hot, "cls").select("cls", F.explode(_children(level)).alias("node"))
    return leaves.join(pool, "cls"), large.join(pool, "cls")


def _blocks(large: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Oversized nodes as groups of bounded size.

    Round 1: blocks of a node's classes, each with the node's PIVOTS pivots (the first class
    of each of PIVOTS hash slices). Round 2, with labels: the classes outside the node's
    largest component, in chunks, each chunk with each block."""
    keep = ["cls", "n", "sig"] + (["label"] if labels is not None else [])
    sizes = large.groupBy("node").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / (LEAF // 2)).cast("int")
    placed = large.join(sizes.select("node", blocks.alias("blocks")), "node").withColumn(
        "block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    if labels is None:
        pivots = (
            placed.groupBy("node", "blocks", F.pmod(F.xxhash64("cls", F.lit(1)), F.lit(PIVOTS)).alias("slice"))
            .agg(F.min(F.struct(*keep)).alias("p")).select("node", "blocks", "p.*"))
        groups = placed.select("node", "block", *keep).unionByName(pivots.select("node", every_block, *keep)).distinct()
        return groups.select(F.xxhash64("node", "block").alias("node"), *keep)
    placed = placed.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    per_label = placed.groupBy("node", "label").agg(F.count("*").alias("m"))
    main = per_label.groupBy("node").agg(F.max(F.struct("m", "label"))["label"].alias("main"),
                                         F.sum("m").alias("all"), F.max("m").alias("most"))
    main = main.filter(F.col("all") > F.col("most")).withColumn(
        "chunks", F.ceil((F.col("all") - F.col("most")) / (LEAF // 2)).cast("int"))
    placed = saved(placed.join(main.select("node", "main", "chunks"), "node"))
    every_chunk = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    outside = placed.filter("label != main").withColumn("chunk", F.pmod(F.xxhash64("cls", F.lit(2)), F.col("chunks")).cast("int"))
    groups = placed.select("node", "block", every_chunk, *keep).unionByName(
        outside.select("node", every_block, "chunk", *keep)).distinct()
    return groups.select(F.xxhash64("node", "block", "chunk").alias("node"), *keep)


def _stretches(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted rows in tables that hold each key whole."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        if rows.num_rows:
            keys = rows[key].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))   # the last key may go on
            yield rows.slice(0, cut)
            rows = rows.slice(cut)
        rest = rows
    if rest is not None:
        yield rest


def _units(nodes: DataFrame, apart: bool = False) -> DataFrame:
    """(unit, cls): groups of possibly linked classes of each node; with ``apart`` only pairs
    of different labels count."""
    columns = ["node", "cls", "n", "sig"] + (["label"] if apart else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _stretches(batches, "node"):
            for part in _parts(rows):
                yield from _node_units(part, apart)

    ordered = nodes.select(*columns).repartition("node").sortWithinPartitions("node", "cls")
    return ordered.mapInArrow(run, "unit bigint, cls binary").distinct()


def _parts(rows: pa.Table) -> Iterator[pa.Table]:
    """Rows sorted by node in parts of whole nodes, with about a leaf's pairs each at most, so
    that the possible pairs held at once don't grow with the batch."""
    node = rows["node"].to_numpy()
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(node)]
    pairs = np.cumsum((ends - starts) ** 2)
    at, done = 0, 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(pairs, done + LEAF * LEAF, side="right")))
        yield rows.slice(int(starts[at]), int(ends[to - 1] - starts[at]))
        at, done = to, int(pairs[to - 1])


def _merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least row of each row's group after the pairs (a, b) have joined groups."""
    root = root.copy()
    while True:
        x, y = root[a], root[b]
        least = np.minimum(x, y)
        if (x == y).all():
            return root
        np.minimum.at(root, x, least)
        np.minimum.at(root, y, least)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _node_units(rows: pa.Table, apart: bool) -> Iterator[pa.RecordBatch]:
    m = rows.num_rows
    if m < 2:
        return
    node, n = rows["node"].to_numpy(), rows["n"].to_numpy()
    tokens = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint32).reshape(m, TOKENS)
    label = np.unique(np.array(rows["label"].to_pylist(), object), return_inverse=True)[1] if apart else None
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    sizes = np.diff(np.r_[starts, m])
    left_in_node = np.repeat(starts + sizes, sizes) - np.arange(m)   # rows from here to the node's end
    root, paired = np.arange(m), np.zeros(m, bool)
    near, other, held = [], [], 0
    at = np.arange(m)
    for d in range(1, int(sizes.max())):
        at = at[left_in_node[at] > d]
        i = at[label[at] != label[at + d]] if apart else at
        i = i[100 * np.minimum(n[i], n[i + d]) >= THRESHOLD * np.maximum(n[i], n[i + d])]
        i = i[root[i] != root[i + d]]       # not yet known to be in one unit
        for k in range(0, len(i), BLOCK):
            a = i[k: k + BLOCK]
            a = a[(tokens[a] == tokens[a + d]).sum(axis=1) >= POSSIBLE]
            near.append(a)
            other.append(a + d)
            held += len(a)
        if near and (held >= HELD_PAIRS or d == int(sizes.max()) - 1):
            a, b = np.concatenate(near), np.concatenate(other)
            paired[a] = paired[b] = True
            root = _merged(root, a, b)
            near, other, held = [], [], 0
    member = np.flatnonzero(paired)
    if not len(member):
        return
    member = member[np.argsort(root[member], kind="stable")]
    cls = rows["cls"].combine_chunks().take(pa.array(member))
    names, group = cls.to_pylist(), root[member]
    edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    unit = np.empty(len(member), np.int64)
    for lo, hi in zip(edge[:-1], edge[1:]):   # equal members, equal unit, whatever the tree
        unit[lo:hi] = np.uint64(xxhash.xxh3_64_intdigest(b"".join(names[lo:hi]))).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(unit), cls], ["unit", "cls"])


def _links(units: DataFrame, texts: DataFrame) -> DataFrame:
    """(u, v): a spanning forest of the confirmed links in each unit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _stretches(batches, "unit"):
            unit, cls = rows["unit"].to_numpy(), rows["cls"].to_pylist()
            edge = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1], True]) if len(unit) else []
            u, v = [], []
            for lo, hi in zip(edge[:-1], edge[1:]):
                parts = by_bytes(rows["__text"].slice(lo, hi - lo).chunks, PART_BYTES)
                sets = [shingle_set(t) for part in parts for t in part.to_pylist()]
                for x, y in _forest(sets):
                    u.append(cls[lo + x])
                    v.append(cls[lo + y])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], ["u", "v"])

    ordered = units.join(texts, "cls").select("unit", "cls", "__text").repartition("unit").sortWithinPartitions("unit", "cls")
    return ordered.mapInArrow(run, "u binary, v binary").distinct()


def _texts(docs: DataFrame, wanted: DataFrame, text: str, id_col: str) -> DataFrame:
    """(cls, __text) of the first document of each wanted class."""
    rows = docs.select(col(id_col).alias("__id"), whole_text(text).alias("__text")).withColumn(
        "__hash", F.xxhash64("__text"))
    firsts = saved(wanted.select(F.col("first.id").alias("__first"), F.col("first.hash").alias("__first_hash"), "cls"))
    return among(rows, "__hash", firsts, "__first_hash").filter("__among").drop("__among").join(
        firsts, F.col("__id").eqNullSafe(F.col("__first")) & (F.col("__hash") == F.col("__first_hash"))
    ).groupBy("cls").agg(F.first("__text").alias("__text"))


def _confirmed(units: DataFrame, classes: DataFrame, docs: DataFrame, text: str, id_col: str) -> DataFrame:
    wanted = units.select("cls").distinct().join(classes, "cls")
    return saved(_links(units, _texts(docs, wanted, text, id_col)))


def _labels(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("cls"), F.col("root").alias("label"))


def link(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: id, ``text_hash`` (xxhash64), ``n_shingles``, ``component`` (label of
    the component, null without shingles), ``component_id`` (its least id, nulls last), ``kept``
    (the id is the component's least) and ``chosen`` (the row also has the least text hash of the
    component's rows with that id)."""
    bounded_batches(docs.sparkSession)
    content = whole_text(text)
    described = F.arrow_udf(_described, "struct<n: bigint, cls: binary, sig: binary>")
    rows = saved(
        docs.select(col(id_col).alias("__id"), F.xxhash64(content).alias("__hash"), described(content).alias("d"))
        .select("__id", "__hash", "d.*"))
    classes = saved(rows.filter("n > 0").groupBy("cls").agg(
        F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"),
                       F.col("__hash").alias("hash"))).alias("first"),
        F.first("n").alias("n"), F.first("sig").alias("sig")))

    leaves, large = _grow(classes)
    units = _units(leaves)
    oversized = not large.isEmpty()
    if oversized:
        units = units.unionByName(_units(_blocks(large))).distinct()
    links = _confirmed(saved(units), classes, docs, text, id_col)
    if oversized:
        more = _units(_blocks(large, _labels(links)), apart=True)
        more = _confirmed(saved(more), classes, docs, text, id_col)
        links = links.unionByName(more)
    labels = _labels(links)

    named = classes.select("cls", "first").join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    least = named.groupBy("label").agg(F.min("first").alias("least"))
    component = named.join(least, "label").select(
        "cls", F.col("label").alias("component"), F.col("least.id").alias("component_id"), F.col("least.hash").alias("__least_hash"))
    joined = rows.select("__id", "__hash", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls"))
    empty = joined.filter("n = 0").withColumns({
        "component": F.lit(None).cast("binary"), "component_id": F.col("__id"), "__least_hash": F.col("__hash")})
    full = joined.filter("n > 0").join(component, "cls")
    least_id = F.col("__id").eqNullSafe(F.col("component_id"))
    return full.unionByName(empty.select(full.columns)).select(
        F.col("__id").alias(id_col), F.col("__hash").alias("text_hash"), F.col("n").alias("n_shingles"), "component", "component_id",
        least_id.alias("kept"), (least_id & (F.col("__hash") == F.col("__least_hash"))).alias("chosen"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, whole: one of each component, the one with the least id
    (of rows with that id, the one with the least text hash), and every row without words,
    once if it repeats an id and text."""
    # equal text hashes are in one component, so id and hash name the component's row
    nameless = col(id_col).isNull() & F.col("component").isNull()
    keys = link(docs, id_col, text).groupBy(col(id_col).alias("__id"), F.col("text_hash").alias("__hash")).agg(
        F.bool_or("chosen").alias("__chosen"), F.count_if(F.col("chosen") & ~nameless).alias("__copies"))
    touched = saved(keys.filter("NOT __chosen OR __copies > 1"))
    rows = among(docs.withColumn("__text_hash", F.xxhash64(whole_text(text))), "__text_hash", touched, "__hash")
    this_row = col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text_hash") == F.col("__hash"))
    looked_up = rows.filter("__among").join(touched, this_row, "left")
    columns = [col(c) for c in docs.columns]
    return (rows.filter("NOT __among").select(*columns)
            .unionByName(looked_up.filter("__chosen IS NULL").select(*columns))
            .unionByName(looked_up.filter("__chosen").dropDuplicates([id_col, "__text_hash"]).select(*columns)))
