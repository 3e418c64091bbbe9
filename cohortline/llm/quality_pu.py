"""Quality classifier by positive-unlabelled (PU) learning.

Trusted positives are documents labelled good, everything else is unlabelled web text; no
negative label is used. With class prior p, a network g and the logistic loss l, training
minimises the non-negative risk

    p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)]),

stepping back up whenever the bracket of a batch is negative. The prior is estimated from
the two samples alone: for every threshold of a first positive-against-unlabelled
classifier, the share of unlabelled rows above it over that of positives bounds the prior,
and the least bound (with a confidence margin) is taken.

Features are statistics of the whole text (byte classes, words, lines, repetition), computed
in Arrow batches; nothing else about a document enters. Training uses at most ``SAMPLE``
positives and ``SAMPLE`` unlabelled documents, those with the smallest hashes of their ids,
collected as rows of about 60 numbers (10 MB in all). Scoring maps over all rows without a
shuffle.

Defined results: a null text counts as empty and is scored like it; long texts are taken
whole; repeated rows get equal scores; without any positive or any unlabelled row the score
is 0.5 throughout; an id with several labels is positive if all of them are; labels without a
document are ignored; extra columns are carried, with names that are added replaced; an
empty table stays empty.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import by_bytes, col, whole_text, without

SAMPLE = 15_000            # positives, and unlabelled documents, used for training at most
FOLDS, HELD_OUT = 5, 0     # documents of fold HELD_OUT never train
THRESHOLD = 0.3
PART_BYTES = 8 << 20       # bytes of text that are Python objects at once (a longer text alone)
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 40, 512, 3e-3, 1e-4
SEED = 11

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WHITE_SPACE = " \t\n\v\f\r"


def features(text: str) -> list[float]:
    """Statistics of one text."""
    data = text.encode("utf-8")
    size = max(1, len(data))
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower = int(count[65:91].sum()), int(count[97:123].sum())
    digits, high = int(count[48:58].sum()), int(count[128:].sum())
    words = data.split()
    n = max(1, len(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    distinct = len(set(words))
    most = max(Counter(words).values()) if words else 0
    ended = sum(x.rstrip().endswith((b".", b"!", b"?", b'"', b":")) for x in lines)
    rate = [float(np.log1p(1000 * count[c] / size)) for c in PUNCTUATION]
    return rate + [
        float(np.log1p(1000 * x / size)) for x in (upper, digits, high, int(count[10]), int(count[32]))
    ] + [
        upper / max(1, upper + lower), float(np.log1p(len(words))), size / n / 10, distinct / n,
        float(np.log1p(distinct)), distinct / n ** 0.8, most / n, len(set(lines)) / m, float(np.log1p(n / m)),
        ended / m, float(np.log1p(len(lines))),
    ]


N_FEATURES = len(features(""))


def _features(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in by_bytes(texts, PART_BYTES):
        yield pa.array([features(t) for t in part.to_pylist()], pa.list_(pa.float64()))


@dataclass
class Network:
    """One hidden layer on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh(np.clip((x - self.mean) / self.scale, -6, 6) @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _train(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int) -> Network:
    """Non-negative PU risk with ``prior``; without one, plain positive against unlabelled."""
    rng = np.random.default_rng(seed)
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    d = unlabelled.shape[1]
    weights = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(())]
    moment = [np.zeros_like(w) for w in weights]
    square = [np.zeros_like(w) for w in weights]
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(u))
        for at in range(0, len(u), BATCH):
            xu = u[order[at: at + BATCH]]
            xp = p[rng.integers(0, len(p), BATCH)]
            x = np.vstack([xp, xu])
            hidden = np.tanh(x @ weights[0] + weights[1])
            z = hidden @ weights[2] + weights[3]
            zp, zu = z[:len(xp)], z[len(xp):]
            # derivatives of the mean losses by each logit
            as_positive = (_sigmoid(zp) - 1) / len(zp)
            as_negative = _sigmoid(zp) / len(zp)
            of_unlabelled = _sigmoid(zu) / len(zu)
            if prior is None:
                g = np.r_[as_positive, of_unlabelled]
            else:
                bracket = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
                if bracket >= 0:
                    g = np.r_[prior * as_positive - prior * as_negative, of_unlabelled]
                else:
                    g = np.r_[prior * as_negative, -of_unlabelled]
            back = np.outer(g, weights[2]) * (1 - hidden ** 2)
            grads = [x.T @ back, back.sum(0), hidden.T @ g, g.sum()]
            step += 1
            for i, grad in enumerate(grads):
                grad = grad + DECAY * weights[i]
                moment[i] = 0.9 * moment[i] + 0.1 * grad
                square[i] = 0.999 * square[i] + 0.001 * grad ** 2
                weights[i] = weights[i] - RATE * (moment[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-8)
    return Network(mean, scale, weights)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int) -> float:
    """Least upper bound of the share of positives among the unlabelled rows; one half of each
    sample trains the first classifier, the other half is counted."""
    p0, p1, u0, u1 = positive[::2], positive[1::2], unlabelled[::2], unlabelled[1::2]
    if min(len(p1), len(u1)) < 10:
        return 0.5
    first = _train(p0, u0, None, seed)
    sp, su = np.sort(first.score(p1)), np.sort(first.score(u1))
    cuts = np.quantile(sp, np.linspace(0, 0.9, 181))
    above_p = 1 - np.searchsorted(sp, cuts) / len(sp)
    above_u = 1 - np.searchsorted(su, cuts) / len(su)
    margin = np.sqrt(np.log(20) / 2) * (len(sp) ** -0.5 + len(su) ** -0.5)
    return float(np.clip((above_u / np.maximum(above_p, 1e-9) * (1 + margin * (1 - above_p))).min(), 0.05, 0.98))


def fold(id_col: str) -> Column:
    return F.crc32(col(id_col).cast("string").cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> Network | None:
    """Network trained on the training folds, or None without positives or unlabelled rows."""
    ids = docs.select(col(id_col).alias("__id")).filter("__id is not null").distinct().filter(fold("__id") != HELD_OUT)
    good = labels.groupBy(col(id_col).alias("__id")).agg(F.min("quality").alias("__q")).filter("__q = 1").select("__id")

    def smallest(rows: DataFrame, salt: int) -> DataFrame:
        return rows.orderBy(F.xxhash64(F.lit(salt), "__id"), "__id").limit(SAMPLE)

    chosen = smallest(ids.join(good, "__id"), 1).withColumn("__positive", F.lit(True)).unionByName(
        smallest(ids.join(good, "__id", "left_anti"), 2).withColumn("__positive", F.lit(False)))
    run = F.arrow_udf(_features, "array<double>")
    rows = docs.select(col(id_col).alias("__id"), whole_text(text).alias("__text")).join(
        F.broadcast(chosen), "__id")
    # one text of each id, however many rows repeat it
    rows = rows.groupBy("__id", "__positive").agg(
        F.min_by("__text", F.struct(F.xxhash64("__text"), "__text")).alias("__text")).select(
        "__id", "__positive", run("__text").alias("x"))
    rows = sorted(rows.collect(), key=lambda r: (r["__id"], r["x"]))   # at most 2 x SAMPLE ids
    positive = np.array([r["x"] for r in rows if r["__positive"]], float).reshape(-1, N_FEATURES)
    unlabelled = np.array([r["x"] for r in rows if not r["__positive"]], float).reshape(-1, N_FEATURES)
    if not len(positive) or not len(unlabelled):
        return None
    mixing = np.random.default_rng(SEED)
    positive, unlabelled = mixing.permutation(positive), mixing.permutation(unlabelled)
    return _train(positive, unlabelled, estimated_prior(positive, unlabelled, SEED), SEED)


def score(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from THRESHOLD on)."""
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in by_bytes(texts, PART_BYTES):
            if network is None or not len(part):
                yield pa.array(np.full(len(part), 0.5))
            else:
                yield pa.array(network.score(np.array([features(t) for t in part.to_pylist()])))

    names = [n for n in ("score", "predicted") if n != text]
    return without(docs, names).withColumn("score", F.arrow_udf(run, "double")(whole_text(text))).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))
