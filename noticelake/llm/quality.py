"""Operator 7, a quality classifier by positive-unlabelled learning.

A small network scores texts by their form: shares of byte classes and of pairs of them, repeated
neighbouring words, variety and length of words. It is fitted with the non-negative unbiased risk: trusted
positives and unlabelled texts only, the negative part of the risk being what unlabelled texts hold beyond
the prior's share of positives; where that estimate falls below zero, its gradient is reversed. The class
prior is estimated from the labelled training rows; with positives alone it comes from a model that tells
labelled from unlabelled rows.

Labels are read only for rows whose crc32(id as text) mod 3 is not 1. Language, source and id are no inputs.
The fit takes at most ``max_positive`` trusted positives and ``max_unlabelled`` texts of the training part,
chosen by a hash of their id; their feature vectors, one for each id (at most a few MB), are the only rows that reach
the driver. Every document is scored from its whole text, in one pass without a shuffle.

Defined cases: null text is empty and is scored like any other; a null id is never held out; repeated label
rows count once, and an id that is labelled both ways is no label; where every
training row is labelled, their texts without the labels are the unlabelled part; of several texts of one id one is learnt from;
``score`` takes the place of a column of that name, ``keep_good`` keeps all columns, whatever their names; without any positive the score is the prior (0.5 if nothing is known); an empty table
gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticelake.llm.common import table, text_of

MAX_POSITIVE = 6000
MAX_UNLABELLED = 12_000

_MARKS, _SHOUTS = b".,;:'\"-()", b"!?"
_PIECE = 1 << 22


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """Per byte a fine class (every ASCII mark its own) and a coarse one."""
    fine, coarse = np.zeros(256, np.uint8), np.full(256, 9, np.uint8)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            fine[b], coarse[b] = 6, 5
        elif c.islower():
            fine[b], coarse[b] = 0, 0
        elif c.isupper():
            fine[b], coarse[b] = 1, 1
        elif c.isdigit():
            fine[b], coarse[b] = 2, 2
        elif c == " ":
            fine[b], coarse[b] = 3, 3
        elif c == "\n":
            fine[b], coarse[b] = 4, 4
        elif b < 33 or b == 127:
            fine[b] = 5
        else:
            fine[b], coarse[b] = 7 + sum(33 <= x < b and not chr(x).isalnum() for x in range(b)), 6 if b in _MARKS else 7 if b in _SHOUTS else 8
    return fine, coarse


_FINE, _COARSE = _byte_classes()
_N_FINE = int(_FINE.max()) + 1
N_FEATURES = _N_FINE + 100 + 6


def features(text: str) -> np.ndarray:
    """A vector of fixed length for a whole text."""
    data = np.frombuffer(text.encode(), np.uint8)
    one, two = np.zeros(_N_FINE), np.zeros(100)
    for at in range(0, len(data), _PIECE):
        part = data[at : at + _PIECE + 1]  # one more, so that pairs across the cut count
        one += np.bincount(_FINE[part[:_PIECE]], minlength=_N_FINE)
        c = _COARSE[part]
        two += np.bincount(c[:-1] * np.uint8(10) + c[1:], minlength=100)
    words = text.split()
    n, size = len(words), max(1, len(data))
    repeats = sum(map(str.__eq__, words, words[1:]))
    long = sum(len(w) > 20 for w in words)
    more = [np.log1p(n), repeats / max(1, n), len(set(words)) / max(1, n), size / max(1, n) / 10, long / max(1, n), float(n == 0)]
    return np.concatenate([np.log1p(100 * one / size), np.log1p(100 * two / size), more]).astype(np.float32)


@dataclass
class Model:
    prior: float
    weights: tuple | None = None  # mean, scale, w1, b1, w2, b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        mean, scale, w1, b1, w2, b2 = self.weights
        h = np.maximum((x - mean) / scale @ w1 + b1, 0)
        return 1 / (1 + np.exp(-np.clip(h @ w2 + b2, -30, 30)))


def _fit(positive: np.ndarray, unlabelled: np.ndarray, gradient, hidden: int = 24, updates: int = 600, batch: int = 4000, rate: float = 1e-3, decay: float = 3e-2) -> tuple:
    """Adam over batches; gradient(gp, gu) gives the risk's derivative by the outputs of both parts."""
    rng = np.random.default_rng(7)
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    xs = [((x - mean) / scale).astype(np.float32) for x in (positive, unlabelled)]
    d = positive.shape[1]
    params = [rng.normal(0, d**-0.5, (d, hidden)).astype(np.float32), np.zeros(hidden, np.float32), rng.normal(0, hidden**-0.5, hidden).astype(np.float32), np.zeros(1, np.float32)]
    m1, m2, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    steps = max(1, -(-len(unlabelled) // batch))
    for _ in range(-(-updates // steps)):
        orders = [np.array_split(rng.permutation(len(x)), steps) for x in xs]
        for ip, iu in zip(*orders, strict=True):
            if not len(ip) or not len(iu):
                continue
            x = np.vstack([xs[0][ip], xs[1][iu]])
            z = x @ params[0] + params[1]
            h = np.maximum(z, 0)
            g = np.clip(h @ params[2] + params[3], -30, 30)
            dg = np.concatenate(gradient(g[: len(ip)], g[len(ip) :])).astype(np.float32)
            dz = np.outer(dg, params[2]) * (z > 0)
            grads = [x.T @ dz + decay * params[0], dz.sum(0), h.T @ dg, dg.sum(keepdims=True)]
            t += 1
            for k, gr in enumerate(grads):
                m1[k] = 0.9 * m1[k] + 0.1 * gr
                m2[k] = 0.999 * m2[k] + 0.001 * gr * gr
                params[k] = params[k] - rate * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.999**t)) + 1e-8)
    return (mean.astype(np.float32), scale.astype(np.float32), *params)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _non_negative(prior: float):
    """Derivatives of the non-negative risk with the sigmoid loss, which is bounded and so keeps the risk's estimate steady."""

    def gradient(gp: np.ndarray, gu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sp, su = _sigmoid(gp), _sigmoid(gu)
        dp, du = sp * (1 - sp) / len(gp), su * (1 - su) / len(gu)
        if su.mean() < prior * sp.mean():
            return prior * dp, -du
        return -2 * prior * dp, du

    return gradient


def _labelled_or_not(gp: np.ndarray, gu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return -_sigmoid(-gp) / len(gp), _sigmoid(gu) / len(gu)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from positives alone: scores of a labelled-or-not model, compared."""
    model = Model(0.5, _fit(positive, unlabelled, _labelled_or_not))
    p, u = model.score(positive), model.score(unlabelled)
    return float(np.clip((u / np.maximum(1 - u, 1e-6)).mean() / (p / np.maximum(1 - p, 1e-6)).mean(), 0.05, 0.95))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model:
    if not len(positive) or not len(unlabelled):
        return Model(0.5 if prior is None else prior)
    prior = float(np.clip(estimate_prior(positive, unlabelled) if prior is None else prior, 0.02, 0.98))
    return Model(prior, _fit(positive, unlabelled, _non_negative(prior)))


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, mod 3; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3


def _sample(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """At most ``most`` of the ids, the first in the order of a hash."""
    return ids.distinct().orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(most)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> Model:
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).filter((fold(F.col("id")) != 1) & F.col("y").isNotNull())
    known = known.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("other")).filter("y = other").drop("other")
    share = known.agg(F.avg("y"), F.min("y")).first()
    prior = None if share[0] is None or share[1] == 1 else float(share[0])
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).filter(fold(F.col("id")) != 1)
    positive = _sample(known.filter("y = 1").join(texts, "id", "left_semi").select("id"), max_positive, 1).withColumn("part", F.lit(1))
    rest = texts.join(known, "id", "left_anti").select("id")
    if rest.isEmpty():
        rest = texts.select("id")  # all are labelled: their texts serve without the labels
    unlabelled = _sample(rest, max_unlabelled, 2).withColumn("part", F.lit(0))

    @F.pandas_udf("array<float>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([features(t) for t in batch], dtype=object)

    # The chosen ids have a fixed bound, so they may be broadcast to the texts.
    chosen = F.broadcast(positive.union(unlabelled))
    rows = texts.join(chosen, "id").select("id", "part", of("text").alias("x")).groupBy("id", "part").agg(F.max("x").alias("x")).toPandas().sort_values(["part", "id"], ignore_index=True)
    take = lambda part: np.vstack([np.empty((0, N_FEATURES), np.float32), *rows.loc[rows["part"] == part, "x"]])
    return fit(take(1), take(0), prior)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``score`` in 0..1; higher is better."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.vstack([np.empty((0, N_FEATURES), np.float32), *(features(t) for t in batch)])
            yield pd.Series(model.score(x).astype(np.float64))

    return docs.withColumn("score", of(text_of(text_col)))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``threshold``."""
    model = train(docs, labels)
    return score(docs.withColumn("_docs", F.struct(*(F.col(f"`{c}`") for c in docs.columns))).select("_docs", "text"), model).filter(F.col("score") >= threshold).select("_docs.*")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op7_quality_classifier": op7_quality_classifier}

#: SQL cannot fit the model; tests hold it against held-out labels.
ORACLES: dict[str, str] = {}
