"""SentencePiece encoding and decoding that keeps the way back to the source text.

Method: the text is normalised by longest-prefix replacement through the model's compiled
character map (a double-array trie), which notes for every normalised character the byte of the
source it came from. Pieces are then merged from characters by score with a priority queue over a
linked list, and each piece is projected through that alignment to its bytes of the source.
Characters outside the vocabulary become byte pieces; the last one of a character spans it, the
ones before it are empty. Decoding joins the pieces' surfaces and byte runs.

Spans are contiguous: piece i covers source bytes [piece_ends[i - 1], piece_ends[i]), the first
one starts at ``text_start`` (0 unless the model drops leading blanks); ``spans`` lists them.

Rows pass through an Arrow function batch by batch; nothing is shuffled. The parsed model (a few
MB) is broadcast, so executors need no copy of the file. A text is cut where no piece of the
vocabulary can reach across, so that each worker encodes a frequent word once; the cuts come from
the vocabulary itself, and a model that allows none has its texts encoded whole.

Defined results: a null text counts as empty and has no pieces; texts of any length are taken
whole; repeated rows are encoded alike; an empty table stays empty; an input column with the name
of an added one is replaced. Models that are not BPE, or have user-defined or unused pieces, are
refused with ValueError.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import by_bytes, whole_text, without

# Field numbers and enumeration values of the model file.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, TYPE = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MODEL_TYPE, SUFFIX_BLANK, BYTE_FALLBACK, UNKNOWN_SURFACE = 3, 24, 35, 44
CHARACTER_MAP, DUMMY_PREFIX, EXTRA_BLANKS, ESCAPE = 2, 3, 4, 5
BPE = 2

BLANK = "▁"
PART_BYTES = 4 << 20     # bytes of texts handled at once
BLOCK_CHARS = 1 << 20    # texts are cut into words in blocks of about this size
CACHE_WORDS = 300_000    # encoded words kept per worker, besides those of the batch at hand
WORD_CHARS = 48          # longer words are merged apart and not kept


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) pairs of one serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(wire) or number()
            yield key >> 3, data[at:at + size]
            at += size


@dataclass
class Model:
    """What encoding and decoding need of a model file."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    character_map: bytes = b""
    dummy_prefix: bool = True
    extra_blanks_removed: bool = True
    escape: bool = True
    byte_fallback: bool = False
    unknown_surface: str = " ⁇ "
    model_type: int = 1
    suffix_blank: bool = False

    @staticmethod
    def parse(data: bytes) -> Model:
        model = Model()
        for number, value in message(data):
            if number == PIECES:
                parts = dict(message(value))
                model.pieces.append(parts.get(PIECE, b"").decode("utf-8"))
                model.scores.append(struct.unpack("<f", parts[SCORE])[0] if SCORE in parts else 0.0)
                model.types.append(parts.get(TYPE, NORMAL))
            elif number == TRAINER:
                parts = dict(message(value))
                model.model_type = parts.get(MODEL_TYPE, 1)
                model.suffix_blank = bool(parts.get(SUFFIX_BLANK, 0))
                model.byte_fallback = bool(parts.get(BYTE_FALLBACK, 0))
                if UNKNOWN_SURFACE in parts:
                    model.unknown_surface = parts[UNKNOWN_SURFACE].decode("utf-8")
            elif number == NORMALIZER:
                parts = dict(message(value))
                model.character_map = parts.get(CHARACTER_MAP, b"")
                model.dummy_prefix = bool(parts.get(DUMMY_PREFIX, 1))
                model.extra_blanks_removed = bool(parts.get(EXTRA_BLANKS, 1))
                model.escape = bool(parts.get(ESCAPE, 1))
        return model


class CharacterMap:
    """Compiled character map: a double-array trie over UTF-8 bytes whose leaves point at
    replacement strings in the block behind it."""

    def __init__(self, data: bytes):
        size = struct.unpack_from("<I", data)[0] if data else 0
        self.units = np.frombuffer(data, "<u4", size // 4, 4).tolist() if data else []
        self.strings = data[4 + size:]
        # characters that can start a key; texts without them stay as they are
        self.first = sorted({key.decode("utf-8", "ignore")[:1] for key in self._keys()} - {""})
        self.starts = re.compile("[" + "".join(map(re.escape, self.first)) + "]") if self.first else None

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _step(self, node: int, byte: int) -> tuple[int, int | None] | None:
        """Node after ``byte`` and the place of its replacement, if a key ends there."""
        at = node ^ byte
        unit = self.units[at] if at < len(self.units) else 0
        if unit & 0x800000FF != byte:
            return None
        below = at ^ self._offset(unit)
        return below, self.units[below] & 0x7FFFFFFF if unit & 256 else None

    def _keys(self) -> Iterator[bytes]:
        open_nodes = [(self._offset(self.units[0]), b"")] if self.units else []
        while open_nodes:
            node, key = open_nodes.pop()
            for byte in range(1, 256):
                step = self._step(node, byte)
                if step:
                    # the first character decides ``starts``: deeper keys need no listing
                    if step[1] is not None:
                        yield key + bytes([byte])
                    if len(key) < 4:
                        open_nodes.append((step[0], key + bytes([byte])))

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """Bytes and replacement of the longest key that starts at byte ``at``."""
        found, node = None, self._offset(self.units[0])
        for end in range(at, len(data)):
            step = self._step(node, data[end])
            if step is None:
                break
            node, place = step
            if place is not None:
                found = end + 1 - at, place
        if found is None:
            return None
        return found[0], self.strings[found[1]:self.strings.index(b"\0", found[1])].decode("utf-8")

    def replaced(self, text: str) -> Iterator[tuple[str, int]]:
        """(replacement, bytes of the source) along a text; runs that no key touches come
        character by character too, each as it is."""
        data, at = text.encode("utf-8"), 0
        while at < len(data):
            lead = data[at]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            char = data[at:at + width].decode("utf-8")
            found = self.longest(data, at) if self.starts.match(char) else None
            size, string = found or (width, char)
            yield string, size
            at += size


class Normalizer:
    """Normalised text and, for each of its characters and its end, a byte of the source."""

    def __init__(self, model: Model):
        self.model, self.map = model, CharacterMap(model.character_map)
        self.blank = BLANK if model.escape else " "

    def plain(self, text: str, starts: bool) -> tuple[str, Sequence[int]]:
        """As ``__call__`` for a text that no key touches under a model that keeps all blanks."""
        if text.isascii():
            source = range(len(text) + 1)
        else:
            source = list(accumulate(map(len, map(str.encode, text)), initial=0))
        chars = text.replace(" ", self.blank)
        return (self.blank + chars, [0, *source]) if starts and self.model.dummy_prefix else (chars, source)

    def __call__(self, text: str, starts: bool = True) -> tuple[str, list[int]]:
        """``starts``: the text is the start of its document, where a prefix blank goes."""
        model = self.model
        squeeze = model.extra_blanks_removed
        if self.map.starts is not None and self.map.starts.search(text):
            steps = list(self.map.replaced(text))
        else:
            steps = [(c, 1 if c < "\x80" else 2 if c < "ࠀ" else 3 if c < "\U00010000" else 4) for c in text]
        at = 0
        if squeeze:
            first = 0
            while first < len(steps) and steps[first][0] == " ":
                at += steps[first][1]
                first += 1
            del steps[:first]
        if not steps:
            return "", [0]
        out, source = [], []
        if starts and model.dummy_prefix and not model.suffix_blank:
            out.append(self.blank)
            source.append(at)
        after_blank = squeeze
        for string, size in steps:
            if after_blank:
                string = string.lstrip(" ")
            if string:
                out.extend(string.replace(" ", self.blank))
                source.extend([at] * len(string))
                after_blank = squeeze and string.endswith(" ")
            at += size
        while squeeze and out and out[-1] == self.blank:
            out.pop()
            at = source.pop()
        if starts and model.dummy_prefix and model.suffix_blank:
            out.append(self.blank)
            source.append(at)
        source.append(at)
        return "".join(out), source


class MergeTable:
    """Merges many short words at once, a row of a matrix each, for vocabularies where every
    character of a piece is a piece. Words that come to a pair whose score another piece has too
    are left to the caller."""

    def __init__(self, ids: dict[str, int], ranks: dict[str, int]):
        self.id_of = np.full(0x110000, -1, np.int64)
        self.bytes_of = np.full(0x110000, 4, np.int64)
        for end, width in ((0x10000, 3), (0x800, 2), (0x80, 1)):
            self.bytes_of[:end] = width
        for piece, i in ids.items():
            if len(piece) == 1:
                self.id_of[ord(piece)] = i
        self.id_of[ord(" ")] = self.id_of[ord(BLANK)]
        self.count = max(ids.values()) + 1
        self.none = len(ranks)
        pairs = sorted((ids[p[:k]] * self.count + ids[p[k:]], ranks[p])
                       for p in ids for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids)
        self.keys, self.rank = np.array(pairs or [(-1, self.none)], np.int64).T.copy()
        self.merged = np.zeros(self.none, np.int64)
        for piece, i in ids.items():
            if len(piece) > 1:
                self.merged[ranks[piece]] = i
        times = np.bincount(np.array([ranks[p] for p in ids if len(p) > 1], np.int64), minlength=self.none + 1)
        self.tied = times > 1
        self.exact = all(c in ids for p in ids for c in p)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.count + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], self.none)

    def pieces(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """(word, its pieces as pairs of id and source bytes); words with a character that is
        no piece, or with a tie, are left out."""
        by_length: dict[int, list[str]] = {}
        for w in words if self.exact else ():
            by_length.setdefault(len(w), []).append(w)
        for n, group in by_length.items():
            points = np.frombuffer("".join(group).encode("utf-32-le"), "<u4").reshape(-1, n)
            symbols = self.id_of[points]
            rows = np.flatnonzero((symbols >= 0).all(axis=1))
            symbols = symbols[rows]
            # source byte at which each symbol ends: the alignment of these characters
            ends = np.cumsum(self.bytes_of[points[rows]], axis=1)
            ranks = self.ranks_of(symbols[:, :-1], symbols[:, 1:])
            while len(rows):
                if symbols.shape[1] > 1:
                    at = ranks.argmin(axis=1)
                    best = ranks[np.arange(len(rows)), at]
                    done = best == self.none
                else:
                    done = np.ones(len(rows), bool)
                if done.any():
                    sizes = np.diff(ends[done], axis=1, prepend=0)
                    packed = np.stack([symbols[done], sizes], axis=2).astype("<u4").tobytes()
                    width = 8 * symbols.shape[1]
                    for k, row in enumerate(rows[done].tolist()):
                        yield group[row], packed[k * width:(k + 1) * width]
                left = ~done & ~self.tied[best] if symbols.shape[1] > 1 else ~done
                if not left.all():
                    if not left.any():
                        break
                    rows, symbols, ends, ranks, at, best = (x[left] for x in (rows, symbols, ends, ranks, at, best))
                # the left symbol of the best pair takes the merged id and the right one's end
                each, width = np.arange(len(rows)), symbols.shape[1]
                symbols[each, at] = self.merged[best]
                keep = np.ones(symbols.shape, bool)
                keep[each, at + 1] = False
                symbols = symbols[keep].reshape(len(rows), width - 1)
                keep = np.ones(ends.shape, bool)
                keep[each, at] = False
                ends = ends[keep].reshape(len(rows), width - 1)
                ranks = ranks[keep[:, :-1]].reshape(len(rows), width - 2)
                inner = np.flatnonzero(at < width - 2)
                ranks[inner, at[inner]] = self.ranks_of(symbols[inner, at[inner]], symbols[inner, at[inner] + 1])
                inner = np.flatnonzero(at > 0)
                ranks[inner, at[inner] - 1] = self.ranks_of(symbols[inner, at[inner] - 1], symbols[inner, at[inner]])


class Coder:
    """Encoder and decoder of one model."""

    def __init__(self, model: Model):
        odd = {t for t in model.types} - {NORMAL, UNKNOWN, CONTROL, BYTE}
        if model.model_type != BPE or odd:
            raise ValueError("only BPE models without user-defined or unused pieces")
        self.model, self.normalize = model, Normalizer(model)
        self.ids = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t == NORMAL}
        self.unknown = model.types.index(UNKNOWN)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t == BYTE}
        # equal scores share a rank, so that the leftmost pair goes first among them
        place = {s: r for r, s in enumerate(sorted({model.scores[i] for i in self.ids.values()}, reverse=True))}
        self.ranks = {p: place[model.scores[i]] for p, i in self.ids.items()}
        self.joined = {a + b for p in self.ids for a, b in zip(p, p[1:])}    # neighbours inside a piece
        # words may be cut off before their blanks if no piece has a blank behind another character
        # and the source's blanks are those of the normalised text
        plain = not model.character_map and model.escape and not model.extra_blanks_removed and not model.suffix_blank
        self.by_word = plain and not any(p[1] == BLANK != p[0] for p in self.joined)
        kinds = {(_LETTER.match(a) is None, _LETTER.match(b) is None) for a, b in self.joined if BLANK not in (a, b)}
        self.words = _PARTS if all(a == b for a, b in kinds) else _WORDS    # also between letters and others
        self.surfaces = [self._surface(i) for i in range(len(model.pieces))]
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.controls = {i for i, t in enumerate(model.types) if t == CONTROL}
        self.known: dict[str, bytes] = {}
        if self.by_word:
            self.table = MergeTable(self.ids, self.ranks)

    # ---- encoding

    def merge(self, chars: str) -> list[str]:
        """Pieces of normalised characters: the best-scored pair first, the leftmost on ties."""
        return [piece for run in self._runs(chars) for piece in self._merge_run(run)]

    def _runs(self, chars: str) -> Iterator[str]:
        """Runs that no piece reaches out of."""
        at, joined = 0, self.joined
        for i in range(1, len(chars)):
            if chars[i - 1:i + 1] not in joined:
                yield chars[at:i]
                at = i
        yield chars[at:]

    def _merge_run(self, chars: str) -> list[str]:
        """A priority queue over a linked list of symbols. A queue entry ``rank * n + i`` is
        stale when the rank of symbol i joined with its right neighbour has changed since."""
        n, rank_of = len(chars), self.ranks.get
        symbols = list(chars)
        rank = [rank_of(a + b, -1) for a, b in zip(symbols, symbols[1:])]
        rank.append(-1)
        queue = [r * n + i for i, r in enumerate(rank) if r >= 0]
        heapq.heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            r, i = divmod(heapq.heappop(queue), n)
            if rank[i] != r:
                continue
            j = after[i]
            symbol = symbols[i] = symbols[i] + symbols[j]
            symbols[j], rank[j] = "", -1
            k = after[i] = after[j]
            rank[i] = -1
            if k < n:
                before[k] = i
                r = rank[i] = rank_of(symbol + symbols[k], -1)
                if r >= 0:
                    heapq.heappush(queue, r * n + i)
            h = before[i]
            if h >= 0:
                r = rank[h] = rank_of(symbols[h] + symbol, -1)
                if r >= 0:
                    heapq.heappush(queue, r * n + h)
        return [s for s in symbols if s]

    def _pieces(self, chars: str, source: Sequence[int]) -> bytes:
        """(id, source bytes) of every piece as pairs of little-endian uint32; character i of
        ``chars`` came from source bytes ``source[i]`` to ``source[i + 1]``."""
        out, at, after_unknown, id_of = [], 0, False, self.ids.get
        for piece in self.merge(chars):
            end, i = at + len(piece), id_of(piece)
            size = source[end] - source[at]
            at = end
            if i is not None:
                out += (i, size)
            elif self.model.byte_fallback:
                for byte in piece.encode("utf-8"):
                    out += (self.byte_ids[byte], 0)
                out[-1] = size
            elif after_unknown:
                out[-1] += size
            else:
                out += (self.unknown, size)
            after_unknown = i is None
        return struct.pack(f"<{len(out)}I", *out)

    def _word(self, word: str, starts: bool) -> bytes:
        """Pieces of a word of a model without character map."""
        chars, source = self.normalize.plain(word, starts)
        return self._pieces(chars, source)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """For each text the ids of its pieces, the source byte where each ends, and where the
        first one starts."""
        return [self._spans(*t) for t in (self._by_word(texts) if self.by_word else map(self._whole, texts))]

    @staticmethod
    def _spans(packed: bytes, start: int) -> tuple[np.ndarray, np.ndarray, int]:
        pairs = np.frombuffer(packed, "<u4").reshape(-1, 2)
        return pairs[:, 0].astype(np.int32), start + np.cumsum(pairs[:, 1], dtype=np.int64), start

    def _whole(self, text: str) -> tuple[bytes, int]:
        chars, source = self.normalize(text)
        return (self._pieces(chars, source), source[0]) if chars else (b"", source[0])

    def _by_word(self, texts: list[str]) -> Iterator[tuple[bytes, int]]:
        """Words are split and looked up; those met first in these texts are merged together."""
        lists = [[self.words.findall(block) for block in blocks(text)] for text in texts]
        wanted = set()
        for parts in lists:
            for part in parts:
                wanted.update(part)
        if len(self.known) > CACHE_WORDS:
            self.known = {w: self.known[w] for w in wanted if w in self.known}
        known = self.known
        known.update(self.table.pieces([w for w in wanted if len(w) <= WORD_CHARS and w not in known]))
        rare = {w: self._word(w, False) for w in wanted if w not in known}
        known.update((w, packed) for w, packed in rare.items() if len(w) <= WORD_CHARS)
        find = known.__getitem__ if not rare else lambda w: known[w] if w in known else rare[w]
        for parts in lists:
            packed = [b"".join(map(find, part[1:] if k == 0 else part)) for k, part in enumerate(parts)]
            yield b"".join([self._word(parts[0][0], True) if parts else b"", *packed]), 0

    # ---- decoding

    def _surface(self, i: int) -> bytes:
        kind, piece = self.model.types[i], self.model.pieces[i]
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return self.model.unknown_surface.encode("utf-8")
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return piece.replace(BLANK, " ").encode("utf-8")

    def decode(self, ids: list[int]) -> str:
        """Text of piece ids. A blank that the prefix brought is dropped; bytes of byte pieces
        that are no UTF-8 become one replacement character each."""
        model = self.model
        head, at = b"", 0
        if model.dummy_prefix or model.extra_blanks_removed:
            while at < len(ids) and not head and ids[at] not in self.byte_of:
                i, at = ids[at], at + 1
                head = self.surfaces[i]
                if model.types[i] == NORMAL and model.pieces[i].startswith(BLANK):
                    head = head[1:]
                    if not model.extra_blanks_removed:
                        break
        rest = ids[at:]
        if self.controls.isdisjoint(rest):    # a control piece has no surface, yet ends a run of bytes
            try:
                return (head + b"".join(map(self.surfaces.__getitem__, rest))).decode("utf-8")
            except UnicodeDecodeError:
                pass
        out, run = [head.decode("utf-8")], bytearray()
        for i in [*rest, None]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            out.append(_bytes_as_text(bytes(run)))
            run.clear()
            if i is not None:
                out.append(self.surfaces[i].decode("utf-8"))
        return "".join(out)


_LETTER = re.compile(r"[^\W\d_]")
_WORDS = re.compile(f"[ {BLANK}]*[^ {BLANK}]+|[ {BLANK}]+")
_PARTS = re.compile(f"[ {BLANK}]*[^\\W\\d_]+|[ {BLANK}]*(?:[^\\w {BLANK}]|[\\d_])+|[ {BLANK}]+")


def _bytes_as_text(run: bytes) -> str:
    """A run of byte pieces: whole characters, and U+FFFD for every byte that is in none."""
    out, at = [], 0
    while at < len(run):
        for width in (1, 2, 3, 4):
            try:
                out.append(run[at:at + width].decode("utf-8"))
                break
            except UnicodeDecodeError:
                continue
        else:
            width = 1
            out.append("�")
        at += width
    return "".join(out)


_CUT = re.compile(f"(?<=[^ {BLANK}]) ")


def blocks(text: str) -> Iterator[str]:
    """Parts of a text, cut before blanks that start a word."""
    at = 0
    while len(text) - at > BLOCK_CHARS:
        cut = _CUT.search(text, at + BLOCK_CHARS)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    if at < len(text):
        yield text[at:]


_CODERS: dict[str, Coder] = {}


def coder(model) -> Coder:
    """This worker's coder of a broadcast model, built once."""
    if model.id not in _CODERS:
        _CODERS.clear()
        _CODERS[model.id] = Coder(model.value)
    return _CODERS[model.id]


class _Shared:
    """A broadcast model with a key that is the same on the driver and in every worker."""

    def __init__(self, df: DataFrame, path: str):
        with open(path, "rb") as f:
            data = f.read()
        model = Model.parse(data)
        Coder(model)    # refuse here what workers could not encode
        self.broadcast = df.sparkSession.sparkContext.broadcast(model)
        self.id = hashlib.sha256(data).hexdigest()

    @property
    def value(self) -> Model:
        return self.broadcast.value


def _lists(values: list[np.ndarray], kind) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(offsets, pa.array(flat, kind))


def encode(docs: DataFrame, model_path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` plus ``piece_ids`` (array of int), ``piece_ends`` (array of long, source bytes),
    ``text_start`` (long) and ``n_tokens`` (long); with ``decoded`` also the text decoded from the
    ids again, in the same pass."""
    shared = _Shared(docs, model_path)
    fields = "ids: array<int>, ends: array<bigint>, start: bigint" + (", decoded: string" if decoded else "")

    @F.arrow_udf(f"struct<{fields}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = coder(shared)
        for part in by_bytes(batches, PART_BYTES):
            rows = c.encode(part.to_pylist())
            columns = [_lists([r[0] for r in rows], pa.int32()), _lists([r[1] for r in rows], pa.int64()),
                       pa.array([r[2] for r in rows], pa.int64())]
            if decoded:
                columns.append(pa.array([c.decode(r[0].tolist()) for r in rows], pa.string()))
            yield pa.StructArray.from_arrays(columns, names=["ids", "ends", "start", "decoded"][:len(columns)])

    added = ("piece_ids", "piece_ends", "text_start", "n_tokens", *(["decoded"] if decoded else []))
    out = without(docs, ["__pieces", *(n for n in added if n != text)]).withColumn("__pieces", run(whole_text(text)))
    columns = {"piece_ids": F.col("__pieces.ids"), "piece_ends": F.col("__pieces.ends"),
               "text_start": F.col("__pieces.start"), "n_tokens": F.size("__pieces.ids").cast("long")}
    if decoded:
        columns["decoded"] = F.col("__pieces.decoded")
    return out.withColumns(columns).drop("__pieces")


def decode(tokens: DataFrame, model_path: str, ids: str = "piece_ids") -> DataFrame:
    """``tokens`` plus ``decoded`` (string); null ids decode to the empty text."""
    shared = _Shared(tokens, model_path)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = coder(shared)
        for batch in batches:
            yield pa.array([c.decode(i or []) for i in batch.to_pylist()], pa.string())

    return without(tokens, ["decoded"]).withColumn("decoded", run(F.col(ids)))


def spans(ends: Column, start: Column) -> Column:
    """Array of (start, end) source bytes of every piece."""
    return F.transform(ends, lambda end, i: F.struct(
        F.when(i == 0, start).otherwise(F.get(ends, i - 1)).alias("start"), end.alias("end")))
