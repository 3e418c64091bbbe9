"""Quality rules from a suffix array: repeated substrings and base counts of a text.

Method: the words of a text are symbols. Prefix doubling sorts the suffixes of the word
sequence; each round splits only the suffixes that still share a prefix with another one.
The ranks of the rounds give the longest common prefix (LCP) of neighbouring suffixes. A
position whose suffix has an LCP of at least ``min_repeat`` words with a neighbour starts a
substring that occurs elsewhere in the text; the union of these stretches is the union of
all maximal repeated substrings. A text is rejected if the union covers too much of it or if
its longest repeat is too long.

Texts are judged one by one, in parts of Arrow batches of a few megabytes, so that only the
words of one part are Python objects at once; nothing is shuffled and no state outlives a part.

Defined results: a null text counts as empty; a text without words has zero counts, no
spans and ``covered`` 0; long texts are taken whole; repeated rows are judged alike; an
empty table stays empty; an input column with the name of an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import bounded_batches, by_bytes, whole_text, without

# White space between words, and the symbols that are counted.
WHITE_SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"

WINDOW = 3                   # words in a window of the base rule
MIN_WORDS = 50               # fewer words fail the base rule
MAX_REPEAT_PERCENT = 50      # more words in repeated windows fail the base rule
MIN_REPEAT = 8               # shortest repeated substring of the method's verdict, in words
MAX_COVERED = 0.30           # largest part of the words that such substrings may cover
MAX_LONGEST = 0.20           # largest part of the words that the longest one may take
BLOCK_WORDS = 400_000        # words sorted at once (a longer text is sorted alone)
PART_BYTES = 2 << 20         # bytes of text split into words at once (a longer text is split alone)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
RESULT = pa.struct([(c, pa.int64()) for c in COUNTS] + [("spans", pa.list_(SPAN))])
RESULT_DDL = ", ".join(f"{c}: bigint" for c in COUNTS) + ", spans: array<struct<start: int, end: int>>"


class _Numbers(dict):
    """Word -> number in order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def longest_repeats(symbols: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest substring that starts there and occurs
    elsewhere too: the larger LCP of its suffix with its two neighbours in suffix order."""
    n = len(symbols)
    best = np.zeros(n, np.int32)
    if n < 2:
        return best
    # rank: a suffix's place among all by its first h symbols; equal ranks share them all
    order = np.argsort(symbols, kind="stable")
    ranks = [_ranked(order, symbols[order])]
    open_at = _tied(order, ranks[0][order])
    h = 1
    ties = []          # neighbours in suffix order that were told apart in this round or stay tied
    while len(open_at):
        rank = ranks[-1]
        ahead = open_at + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1).astype(np.int64)
        # sort within each group of equal rank by the rank of what follows; groups keep their place
        key = rank[open_at].astype(np.int64) * (n + 1) + (second + 1)
        by = np.argsort(key, kind="stable")
        open_at, key = open_at[by], key[by]
        group = rank[open_at]
        same = group[1:] == group[:-1]
        apart = same & (key[1:] != key[:-1])
        ties.append((open_at[:-1][apart], open_at[1:][apart], len(ranks)))
        new = rank.copy()
        index = np.arange(len(open_at), dtype=np.int64)
        first_of_group = np.maximum.accumulate(np.where(np.r_[True, ~same], index, 0))
        first_of_key = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], index, 0))
        new[open_at] = group + (first_of_key - first_of_group).astype(np.int32)
        ranks.append(new)
        open_at = _tied(open_at, new[open_at])
        h *= 2
    # LCP of each such pair: its halves, quarters, ... from the ranks of the rounds
    for left, right, known in ties:
        lcp = np.zeros(len(left), np.int64)
        for level in range(known - 1, -1, -1):
            a, b = left + lcp, right + lcp
            inside = (a < n) & (b < n)
            equal = np.zeros(len(left), bool)
            equal[inside] = ranks[level][a[inside]] == ranks[level][b[inside]]
            lcp[equal] += 1 << level
        np.maximum.at(best, left, lcp.astype(np.int32))
        np.maximum.at(best, right, lcp.astype(np.int32))
    return best


def _ranked(order: np.ndarray, sorted_keys: np.ndarray) -> np.ndarray:
    """Rank of each position: the place of the first equal key in sorted order."""
    index = np.arange(len(order), dtype=np.int32)
    first = np.maximum.accumulate(np.where(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]], index, 0))
    rank = np.empty(len(order), np.int32)
    rank[order] = first
    return rank


def _tied(positions: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Of positions sorted by rank, those that share their rank with another one."""
    same = ranks[1:] == ranks[:-1]
    return positions[np.r_[False, same] | np.r_[same, False]]


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions inside any of the stretches."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def _line_copies(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(WHITE_SPACE)]
    return len(lines) - len(set(lines))


def judge(texts: list[str], min_repeat: int) -> pa.StructArray:
    """Counts and spans of each text."""
    words = [t.encode("utf-8").split() for t in texts]   # bytes.split: exactly WHITE_SPACE
    sizes = np.array([len(w) for w in words], np.int64)
    repeat, covered, longest = (np.zeros(len(texts), np.int64) for _ in range(3))
    span_of, span_start, span_end = [], [], []
    at = 0
    while at < len(texts):
        to, total = at, 0
        while to < len(texts) and (to == at or total + sizes[to] <= BLOCK_WORDS):
            total += sizes[to]
            to += 1
        numbers = _Numbers()
        flat = np.fromiter((numbers[w] for k in range(at, to) for w in words[k]), np.int64, int(total))
        text_of = np.repeat(np.arange(to - at), sizes[at:to])
        # a symbol is (text, word), so no suffix shares a prefix with one of another text
        best = longest_repeats(text_of * max(1, len(numbers)) + flat)
        in_window = _covered(*_stretches(best, WINDOW, fixed=WINDOW), len(best))
        in_repeat = _covered(*_stretches(best, min_repeat), len(best))
        k = to - at
        repeat[at:to] = np.bincount(text_of[in_window], minlength=k)
        covered[at:to] = np.bincount(text_of[in_repeat], minlength=k)
        np.maximum.at(longest, at + text_of, np.where(best >= min_repeat, best, 0))
        # runs of the mask, cut at text borders
        mask = np.r_[False, in_repeat, False]
        border = np.r_[True, text_of[1:] != text_of[:-1], True] if len(text_of) else np.ones(1, bool)
        begins = np.flatnonzero(mask[1:-1] & (~mask[:-2] | border[:-1]))
        ends = np.flatnonzero(mask[1:-1] & (~mask[2:] | border[1:])) + 1
        offset = np.concatenate([[0], np.cumsum(sizes[at:to])])[text_of[begins]] if len(begins) else begins
        span_of.append(at + text_of[begins])
        span_start.append(begins - offset)
        span_end.append(ends - offset)
        at = to
    per_text = np.bincount(np.concatenate(span_of), minlength=len(texts)) if span_of else np.zeros(0, int)
    spans = pa.ListArray.from_arrays(
        pa.array(np.r_[0, np.cumsum(per_text)].astype(np.int32)),
        pa.StructArray.from_arrays(
            [pa.array(np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32)) for x in (span_start, span_end)],
            fields=list(SPAN)))
    counts = [
        sizes,
        np.array([len(t) - sum(map(t.count, WHITE_SPACE)) for t in texts], np.int64),
        np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        np.array([_line_copies(t) for t in texts], np.int64),
        repeat, covered, longest,
    ]
    return pa.StructArray.from_arrays([pa.array(c) for c in counts] + [spans], fields=list(RESULT))


def _stretches(best: np.ndarray, least: int, fixed: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(best >= least)
    return starts, (np.full(len(starts), fixed, np.int64) if fixed else best[starts].astype(np.int64))


def rules(docs: DataFrame, text: str = "text", *, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
          max_longest: float = MAX_LONGEST) -> DataFrame:
    """``docs`` plus the counts, ``spans`` (words inside repeated substrings, as word
    offsets), ``base_failed`` and ``kept``."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf(RESULT_DDL_TYPE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in by_bytes(batches, PART_BYTES):
            yield judge(part.to_pylist(), min_repeat)

    added = [*COUNTS, "spans", "base_failed", "kept"]
    names = [n for n in added if n.lower() != text.lower()]
    out = without(docs, [*names, "__rules"]).withColumn("__rules", run(whole_text(text)))
    n, r = F.col("__rules.n_words"), "__rules."
    failed = (n < MIN_WORDS) | (100 * F.col(r + "n_repeat_words") > MAX_REPEAT_PERCENT * n)
    repetitive = (F.col(r + "covered_words") > max_covered * n) | (F.col(r + "longest_repeat") > max_longest * n)
    return (
        out.withColumns({c: F.col(r + c) for c in [*COUNTS, "spans"]})
        .withColumns({"base_failed": failed, "kept": ~failed & ~repetitive})
        .drop("__rules")
    )


RESULT_DDL_TYPE = f"struct<{RESULT_DDL}>"
