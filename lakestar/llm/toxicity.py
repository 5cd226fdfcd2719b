"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; everything else is unlabelled, since a text without that label
is not known to be clean. A linear numpy classifier over words and word beginnings minimises the
class-prior-corrected risk ``pi * R_P(+) + max(0, R_U(-) - pi * R_P(-))``: where the bracket turns
negative, the step goes the other way, so that the classifier cannot profit from fitting noise.

Training data is a bounded sample: at most ``POSITIVES`` confirmed and ``UNLABELLED`` other texts, drawn by
a hash of their id from the ids that are there, one row for each. Words are counted on the executors; the
driver gets the ``FEATURES`` most telling words and each sampled text as the list of those it holds. All texts are scored where they are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, slices, staged

POSITIVES = 6_000
UNLABELLED = 12_000
FEATURES = 512
THRESHOLD = 0.7
TELLING = 4.0
LEAST_PRIOR = 1e-3
KEPT_WORDS = 200_000

_WORD = re.compile(r"[^\W\d_]+")
_STARTS = (4, 5, 6)


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings, which catch compounds and inflections."""
    return [word, *(f"{word[:n]}*" for n in _STARTS if len(word) >= n)]


def _text_features(text: str | None) -> set[str]:
    return {f for word in set(_WORD.findall((text or "").lower())) for f in features_of(word)}


def sample_training(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int) -> DataFrame:
    """Stored rows (positive, text) of the bounded sample; no label of a held-out row is looked at. Of the
    rows of a repeated id one is taken, the same in every run."""
    order = F.xxhash64("doc_id")
    known = labels.filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    there = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    toxic = known.filter("toxic = 1").join(there, "doc_id", "left_semi").orderBy(order, "doc_id").limit(positives)
    other = there.filter(~held_out()).orderBy(order, "doc_id").limit(unlabelled)
    ids = toxic.select("doc_id", F.lit(1).alias("positive")).unionByName(
        other.select("doc_id", F.lit(0).alias("positive"))
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "positive")
    return staged(rows.agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("positive", "text"), "toxic-sample")


def _telling_features(sample: DataFrame, n_pos: int, n_unl: int, limit: int) -> list[str]:
    """Features whose share among positives exceeds that among the unlabelled most significantly."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            words = list(seen[0].keys() | seen[1].keys())
            out = [pa.array(words, pa.string())]
            out += [pa.array([c[w] for w in words], pa.int64()) for c in (seen[1], seen[0])]
            for c in seen:
                c.clear()
            return pa.RecordBatch.from_arrays(out, ["feature", "in_pos", "in_unl"])

        for batch in slices(batches, 1):
            for positive, text in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                seen[positive].update(_text_features(text))
                if len(seen[0]) + len(seen[1]) > KEPT_WORDS:
                    yield flush()
        yield flush()

    counts = sample.mapInArrow(count, "feature string, in_pos bigint, in_unl bigint")
    counts = counts.groupBy("feature").agg(F.sum("in_pos").alias("p"), F.sum("in_unl").alias("u"))
    share = (F.col("p") + F.col("u")) / F.lit(n_pos + n_unl)
    spread = F.sqrt(share * (1 - share) * F.lit(1 / n_pos + 1 / n_unl) + 1e-9)
    z = (F.col("p") / n_pos - F.col("u") / n_unl) / spread
    best = counts.filter("p > 1").select("feature", z.alias("z")).filter(F.col("z") > TELLING)
    return [row.feature for row in best.orderBy(F.desc("z"), "feature").limit(limit).collect()]


def fit_nnpu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int = 400, rate: float = 0.05, l2: float = 1e-5
) -> tuple[np.ndarray, float]:
    """Weights and intercept of the non-negative risk with logistic loss (Adam, all rows a round)."""
    n, dims = len(positive), positive.shape[1]
    rows = np.vstack([positive, unlabelled]).astype(np.float32)
    w = np.zeros(dims + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros(dims + 1), np.zeros(dims + 1)
    for t in range(1, rounds + 1):
        f = rows @ w[:-1] + w[-1]
        p = 1 / (1 + np.exp(-np.clip(f, -30, 30)))  # slope of the loss as a negative; p - 1 as a positive
        soft = np.logaddexp(0, f)
        gap = soft[n:].mean() - prior * soft[:n].mean()
        as_negative = np.concatenate([-prior * p[:n] / n, p[n:] / (len(rows) - n)])
        if gap >= 0:
            slope = as_negative
            slope[:n] += prior * (p[:n] - 1) / n
        else:
            slope = -as_negative
        grad = np.append(slope @ rows, slope.sum())
        grad[:-1] += l2 * w[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    intercept: float

    def scorer(self):
        """A function text -> score that remembers which features a word has."""
        weights, known = self.weights, {}

        def score(text: str | None) -> float:
            words = set(_WORD.findall((text or "").lower()))
            if len(known) > KEPT_WORDS:
                known.clear()
            found: set[str] = set()
            for word in words:
                got = known.get(word)
                if got is None:
                    got = known[word] = tuple(f for f in features_of(word) if f in weights)
                if got:
                    found.update(got)
            f = self.intercept + sum(weights[x] for x in sorted(found))
            return float(1 / (1 + np.exp(-np.clip(f, -30, 30))))

        return score


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    features: int = FEATURES,
    prior: float | None = None,
) -> ToxicityModel:
    """``prior`` is the share of toxic documents; by default that among the labels learned from, kept
    ``LEAST_PRIOR`` away from 0 and 1, where there would be no risk to minimise.

    Features are those that more than one positive text holds, and whose share among positives is more than
    ``TELLING`` standard errors above that among the unlabelled. Without a confirmed toxic text, as in an empty
    table, or with nothing that tells them apart, every score is the prior. Of repeated rows one is learned from.
    """
    sample = sample_training(docs, labels, positives, unlabelled)
    known = labels.filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if prior is None:
        prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    prior = min(max(prior, LEAST_PRIOR), 1 - LEAST_PRIOR)
    sizes = {row.positive: row.n for row in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    names = _telling_features(sample, sizes[1], sizes[0], features) if {0, 1} <= sizes.keys() else []
    if not names:
        return ToxicityModel({}, float(np.log(prior / (1 - prior))))
    place = {name: i for i, name in enumerate(names)}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            got = [sorted(place[f] for f in _text_features(t) if f in place) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(got, pa.list_(pa.int32()))], ["positive", "features"]
            )

    rows = sample.mapInArrow(held, "positive int, features array<int>").collect()
    x = np.zeros((len(rows), len(names)), np.float32)
    for i, row in enumerate(rows):
        x[i, row.features] = 1
    is_positive = np.array([row.positive for row in rows]) == 1
    weights, intercept = fit_nnpu(x[is_positive], x[~is_positive], prior)
    return ToxicityModel(dict(zip(names, map(float, weights), strict=True)), intercept)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Returns doc_id, held_out, score and predicted of every row; null text scores as empty text, and each
    of repeated rows is scored. An empty table gives no rows."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most ``FEATURES`` weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = sent.value.scorer()
        for batch in slices(batches, 2):
            scores = [score(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"]
            )

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    scored = rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
