"""Byte-pair encoding and decoding with a public tokenizer's vocabulary.

Method: each pre-token's bytes become a doubly linked list of symbols; a priority queue
holds the merge rank of every adjacent pair. The lowest rank (leftmost on ties) is merged
first, the two new neighbour pairs are queued, and queue entries whose symbols have changed
since are skipped as stale. Decoding concatenates the vocabulary's byte strings.

Rows pass through an Arrow function batch by batch; nothing is shuffled. The vocabulary
file (a few MB) is read by the driver and broadcast, so executors need no local copy.

Defined results: a null text counts as empty and has no tokens; empty texts have none;
texts of any length are cut into blocks at places where a pre-token always starts, so the
list of pre-tokens stays bounded; repeated rows are encoded alike; an empty table stays
empty; an input column with the name of an added one is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import bounded_batches, by_bytes, whole_text, without

# The pattern of byte-level pre-tokenization.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Code points assigned after the Unicode version of the tokenizers library.
# Newer tables call them letters or numbers, that library's tables neither.
UNASSIGNED = (
    "\\u0558\\u058B-\\u058C\\u088F\\u0C5C\\u0CDC\\u208F\\u209D-\\u209F\\uA7CE-\\uA7CF\\uA7D2\\uA7D4"
    "\\uA7DD\\uA7E2\\uA7F1\\uAB6C-\\uAB6D\\U000107BB-\\U000107BF\\U00010940-\\U00010959"
    "\\U00010EC5-\\U00010EC7\\U00010ED9-\\U00010EEE\\U00011B0A\\U00011DB0-\\U00011DDB"
    "\\U00011DE0-\\U00011DE9\\U00011DF1\\U0001246F\\U00012475-\\U0001247F\\U00012550-\\U00012686"
    "\\U00016EA0-\\U00016EB8\\U00016EBB-\\U00016ED3\\U00016FF2-\\U00016FF6\\U000187F8-\\U000187FF"
    "\\U00018CD6-\\U00018CDA\\U00018D09-\\U00018D20\\U00018D80-\\U00018DF2\\U00018E00-\\U00019191"
    "\\U000191A0-\\U000191D2\\U0001B123-\\U0001B128\\U0001B168\\U0001D6A6\\U0001DF1F-\\U0001DF24"
    "\\U0001DF2B-\\U0001DF81\\U0001DF90-\\U0001DF96\\U0001DFCD-\\U0001DFFF\\U0001E6C0-\\U0001E6DE"
    "\\U0001E6E0-\\U0001E6E2\\U0001E6E4-\\U0001E6E5\\U0001E6E7-\\U0001E6ED\\U0001E6F0-\\U0001E6F4"
    "\\U0001E6FE-\\U0001E6FF\\U0002B73A-\\U0002B73F\\U0002B81E\\U0002CEA2-\\U0002CEAD"
    "\\U000323B0-\\U00033479\\U0003D000-\\U0003FC3F"
)

PART_BYTES = 4 << 20       # bytes of texts or token ids handled at once
BLOCK_CHARS = 1 << 20      # texts are pre-tokenized in blocks of about this size
CACHE_WORDS = 200_000      # encoded pre-tokens kept per worker: the sum of
CACHE_PIECES = 300_000     # these two, in one cache
CACHE_CHARS = 48           # longer ones are not kept


class _Encoded(dict):
    """Pre-token -> its token ids as little-endian uint32 bytes, filled on first use by
    ``fill``, which returns them and whether to keep them. A full half becomes the older half,
    and pieces used again move to the new one, so the frequent pieces stay."""

    def __init__(self, fill, entries: int):
        super().__init__()
        self.fill, self.half, self.older = fill, entries // 2, {}

    def __missing__(self, piece: str) -> bytes:
        packed, keep = self.older.get(piece), True
        if packed is None:
            packed, keep = self.fill(piece)
        if keep:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Decoder:
    """Decoder of one byte-level BPE vocabulary (the text of its JSON file)."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.strings = {i: bytes(byte_of[c] for c in token) for token, i in model["model"]["vocab"].items()}
        self.strings |= {t["id"]: t["content"].encode("utf-8") for t in model.get("added_tokens", [])}

    def decode(self, packed: bytes) -> str:
        """Text of packed token ids; bytes that are no UTF-8 become replacement characters."""
        ids = memoryview(packed).cast("I")
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


class Encoder:
    """Encoder of one byte-level BPE vocabulary (the text of its JSON file)."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        self.byte_ids = [vocab[c] for c in byte_alphabet()]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.ranks = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.merged = [vocab[a + b] for a, b in pairs]
        self.special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.special_pattern = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None
        self.bmp_pattern = bmp_pattern()
        self.pattern = regex.compile(PATTERN)
        known = PATTERN.replace(r"\p{L}+", f"(?:(?![{UNASSIGNED}])\\p{{L}})+").replace(
            r" ?\p{N}+", f" ?(?:(?![{UNASSIGNED}])\\p{{N}})+").replace(
            r"[^\s\p{L}\p{N}]+", f"(?:[^\\s\\p{{L}}\\p{{N}}]|[{UNASSIGNED}])+")
        self.strict_pattern = regex.compile(known)
        self.unassigned = regex.compile(f"[{UNASSIGNED}]")
        self.pre_tokens = _Encoded(self._pre_token, CACHE_WORDS + CACHE_PIECES)

    def merge(self, data: bytes) -> list[int]:
        """Token ids of one pre-token's bytes.

        ``ids``, ``before`` and ``after`` are the linked list. The queue holds ``rank * n + i``
        for the merge rank of symbol i with its right neighbour; ``current[i]`` is the last such
        entry of symbol i, and any other one is stale.
        """
        n = len(data)
        ids = [self.byte_ids[b] for b in data]
        if n == 1:
            return ids
        rank_of, merged, pop, push = self.ranks.get, self.merged, heapq.heappop, heapq.heappush
        current = [-1 if r is None else r * n + i for i, r in enumerate(map(rank_of, zip(ids, ids[1:])))]
        queue = [entry for entry in current if entry >= 0]
        current.append(-1)
        heapq.heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            entry = pop(queue)
            i = entry % n
            if current[i] != entry:
                continue
            j = after[i]
            symbol = ids[i] = merged[entry // n]
            ids[j] = current[i] = current[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = rank_of((symbol, ids[k]))
                if rank is not None:
                    entry = current[i] = rank * n + i
                    push(queue, entry)
            h = before[i]
            if h >= 0:
                rank = rank_of((ids[h], symbol))
                if rank is None:
                    current[h] = -1
                else:
                    entry = current[h] = rank * n + h
                    push(queue, entry)
        return [x for x in ids if x >= 0]

    def encode(self, text: str) -> bytes:
        """Token ids of a whole text, packed as little-endian uint32."""
        if self.special_pattern is None:
            return self._plain(text)
        parts = self.special_pattern.split(text)
        if len(parts) == 1:
            return self._plain(text)
        return b"".join(
            self.special[p].to_bytes(4, "little") if k % 2 else self._plain(p) for k, p in enumerate(parts))

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self._block, blocks(text)))

    def _block(self, block: str) -> bytes:
        return b"".join(map(self.pre_tokens.__getitem__, self._split(block)))

    def _split(self, text: str) -> list[str]:
        if not _ASTRAL.search(text):
            return self.bmp_pattern.findall(text)
        strict = self.unassigned.search("".join(set(text)))
        return (self.strict_pattern if strict else self.pattern).findall(text)

    def _pre_token(self, piece: str) -> tuple[bytes, bool]:
        return array("I", self.merge(piece.encode("utf-8"))).tobytes(), len(piece) <= CACHE_CHARS


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the rest follow from U+0100 in byte order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def bmp_pattern() -> re.Pattern:
    """``PATTERN`` for texts below U+10000, its classes listed code point by code point without
    the unassigned ones; such lists are looked up faster than properties."""
    plane = "".join(map(chr, range(0x10000)))
    letter, number, space = (
        "".join(f"\\u{ord(run[0]):04x}-\\u{ord(run[-1]):04x}" for run in regex.findall(members, plane))
        for members in (rf"(?:(?![{UNASSIGNED}])\p{{L}})+", rf"(?:(?![{UNASSIGNED}])\p{{N}})+", r"\s+"))
    return re.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]").replace(
        r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]").replace(
        r"\S", f"[^{space}]").replace(r"\s", f"[{space}]"))


_ASTRAL = re.compile("[^\0-\uffff]")
_CUT = regex.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def blocks(text: str) -> Iterator[str]:
    """Cut a long text before blanks between two letters, where a pre-token always starts."""
    at = 0
    while len(text) - at > BLOCK_CHARS:
        cut = _CUT.search(text, at + BLOCK_CHARS)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


_CODERS: dict[type, tuple[int, Encoder | Decoder]] = {}


def coder(kind: type, spec) -> Encoder | Decoder:
    """This worker's encoder or decoder of a broadcast vocabulary, built once."""
    key = hash(spec.value)
    if kind not in _CODERS or _CODERS[kind][0] != key:
        _CODERS[kind] = key, kind(spec.value)
    return _CODERS[kind][1]


def _spec(df: DataFrame, vocab_path: str):
    bounded_batches(df.sparkSession)
    with open(vocab_path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, vocab_path: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``token_ids`` (binary, little-endian uint32) and ``n_tokens`` (long)."""
    spec = _spec(docs, vocab_path)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = coder(Encoder, spec)
        for part in by_bytes(batches, PART_BYTES):
            yield pa.array([c.encode(t) for t in part.to_pylist()], pa.binary())

    out = without(docs, [n for n in ("token_ids", "n_tokens") if n != text])
    out = out.withColumn("token_ids", run(whole_text(text)))
    return out.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))


def decode(tokens: DataFrame, vocab_path: str, ids: str = "token_ids") -> DataFrame:
    """``tokens`` plus ``decoded`` (string): the vocabulary's strings, concatenated."""
    spec = _spec(tokens, vocab_path)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = coder(Decoder, spec)
        for part in by_bytes(batches, PART_BYTES):
            yield pa.array([c.decode(b) for b in part.to_pylist()], pa.string())

    return without(tokens, ["decoded"]).withColumn("decoded", run(F.coalesce(F.col(ids), F.lit(b""))))


def round_trip(docs: DataFrame, vocab_path: str, text: str = "text") -> DataFrame:
    """``docs`` plus the columns of ``encode`` and ``decode``, in one pass of each text through
    a Python worker. Both steps apart take two workers a task."""
    spec = _spec(docs, vocab_path)

    @F.arrow_udf("struct<token_ids: binary, decoded: string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = coder(Encoder, spec), coder(Decoder, spec)
        for part in by_bytes(batches, PART_BYTES):
            tokens = [encoder.encode(t) for t in part.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array(tokens, pa.binary()), pa.array([decoder.decode(b) for b in tokens], pa.string())],
                names=["token_ids", "decoded"])

    added = ("token_ids", "n_tokens", "decoded")
    out = without(docs, ["__coded", *(n for n in added if n != text)]).withColumn("__coded", run(whole_text(text)))
    ids = F.col("__coded.token_ids")
    return out.withColumns({"token_ids": ids, "n_tokens": (F.octet_length(ids) / 4).cast("long"),
                            "decoded": F.col("__coded.decoded")}).drop("__coded")


def token_array(tokens: bytes) -> list[int]:
    """Packed ids as a list."""
    return list(memoryview(tokens).cast("I"))
