"""Toxicity classifier regularised by counterfactuals.

Features are the words of a text and their first letters, each present or absent.
Words are chosen by how unevenly labels share them; a logistic model is
fitted on those in numpy. Identity terms in labelled sentences are swapped for
others of their kind, and the fit is charged for the squared difference of the two
scores, so that a neutral mention of a group does not raise a score by itself.

The fit reads a bounded sample of labelled rows (``SAMPLE``, by hash of the id; all
of them if there are fewer). Scoring reads every whole text.

Edge cases: NULL and empty texts score what the intercept says. Without labelled rows
the score is next to 0; with one class only it is that class's smoothed share. NULL labels
are no labels; an id labelled several times takes its largest label. Repeated rows are
scored alike. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_row, by_batch, crc_remainder, cut, from_row, schema_of

#: Labelled rows that the fit reads, on average.
SAMPLE = 20_000
#: Words and beginnings that the model can hold.
FEATURES = 20_000
#: From this probability on a text counts as toxic.
THRESHOLD = 0.7

#: Terms for groups of people; within a line any may stand for any other.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("femmes", "hommes"),
    ("frauen", "männer"),
    ("mujeres", "hombres"),
    ("musulman", "chrétien", "juif"),
    ("musulmán", "cristiano", "judío"),
)

_LETTERS = regex.compile(r"[^\W\d_]+")
_SENTENCE = regex.compile(r"(?<=[.!?])\s+|\n")
_BEGINNINGS = (4, 5, 6, 7, 8)


def word_features(token: str) -> tuple[str, ...]:
    """The words in a token, lower case, and their beginnings."""
    found = []
    for word in _LETTERS.findall(token.lower()):
        found.append(word)
        found.extend(f"{word[:n]}*" for n in _BEGINNINGS if len(word) > n)
    return tuple(found)


def text_features(text: str | None) -> set[str]:
    return {f for token in set((text or "").split()) for f in word_features(token)}


def swaps(text: str | None, terms: tuple[tuple[str, ...], ...]) -> Iterator[tuple[str, str]]:
    """The identity term that a labelled sentence has, and each that could replace it."""
    others = {t: tuple(o for o in line if o != t) for line in terms for t in line}
    for sentence in _SENTENCE.split(text or ""):
        for word in {w for w in _LETTERS.findall(sentence.lower()) if w in others}:
            yield from ((word, other) for other in others[word])


@dataclass(frozen=True)
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    intercept: float = -np.inf

    def logit(self, features: set[str]) -> float:
        return self.intercept + sum(self.weights.get(f, 0.0) for f in features)


def fit_weights(
    rows: list[tuple[int, list[int]]],
    pairs: list[tuple[list[int], list[int]]],
    features: int,
    *,
    counterfactual: float = 1.0,
    ridge: float = 3e-6,
    steps: int = 800,
    rate: float = 0.2,
) -> tuple[np.ndarray, float]:
    """Weights and intercept by Adam: log loss, ``ridge`` times squared weights, and
    ``counterfactual`` times the mean squared difference of logits over ``pairs``."""
    labels = np.array([r[0] for r in rows], np.float64)
    at = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    idx = np.array([i for r in rows for i in r[1]], np.int64)
    pair_at = np.repeat(np.arange(len(pairs)), [len(p) + len(q) for p, q in pairs]).astype(np.int64)
    pair_idx = np.array([i for p, q in pairs for i in (*p, *q)], np.int64)
    sign = np.array([s for p, q in pairs for s in (*[1.0] * len(p), *[-1.0] * len(q))])
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    # Toxic rows are few: each counts as the root of how many clean ones there are to it.
    row_weight = np.where(labels > 0, np.sqrt(max(1.0, (1 - share) / share)), 1.0)
    row_weight /= row_weight.sum()
    params = np.zeros(features + 1)
    params[-1] = np.log(share / (1 - share))
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        logit = params[-1] + np.bincount(at, params[idx], len(rows))
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) * row_weight
        grad = np.bincount(idx, error[at], features + 1) + ridge * params
        grad[-1] = error.sum()
        if len(pairs):
            gap = np.bincount(pair_at, sign * params[pair_idx], len(pairs))
            pull = 2 * counterfactual / len(pairs) * gap[pair_at] * sign
            grad += np.bincount(pair_idx, pull, features + 1)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        params -= rate * (1 - 0.9 * step / steps) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return params[:-1], float(params[-1])


def _counted(sample: DataFrame) -> DataFrame:
    """``feature, n, n_toxic``: texts that have it, counted in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        toxic: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            names = list(n)
            out = pa.record_batch(
                [pa.array(names, pa.string()), pa.array([n[f] for f in names], pa.int64()), pa.array([toxic[f] for f in names], pa.int64())],
                ["feature", "n", "n_toxic"],
            )
            n.clear(), toxic.clear()
            return out

        for batch in batches:
            for text, label in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                found = text_features(text)
                n.update(found)
                if label:
                    toxic.update(found)
                if len(n) > 400_000:
                    yield flush()
        if n:
            yield flush()

    parts = sample.select("text", "toxic").mapInArrow(run, "feature string, n long, n_toxic long")
    return parts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))


def fit(
    labelled: DataFrame,
    *,
    sample: int = SAMPLE,
    features: int = FEATURES,
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    counterfactual: float = 1.0,
) -> Model:
    """Fit on ``text, toxic`` rows; the caller has sampled them to about ``sample``."""
    rows = cut(labelled.select("text", F.col("toxic").cast("int").alias("toxic")))
    n, n_toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n:
        return Model()
    if n_toxic in (0, n):
        share = (n_toxic + 0.5) / (n + 1)
        return Model({}, float(np.log(share / (1 - share))))
    # How far the share of toxic texts with a feature lies from the share of all,
    # in standard errors.
    base = n_toxic / n
    off = (F.col("n_toxic") - F.col("n") * base) / F.sqrt(F.col("n") * base * (1 - base))
    chosen = (
        _counted(rows)
        .where("n >= 4")
        .withColumn("off", F.abs(off))
        .where("off >= 4")
        .orderBy(F.desc("off"), "feature")
        .limit(features)
    )
    names = [r.feature for r in chosen.select("feature").collect()]
    place = {f: i for i, f in enumerate(names)}

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            held, plus, minus = [], [], []
            for text in batch[0].to_pylist():
                held.append([place[f] for f in text_features(text) if f in place])
                seen = set(swaps(text, terms))
                a = [[place[f] for f in word_features(s) if f in place] for s, _ in sorted(seen)]
                b = [[place[f] for f in word_features(o) if f in place] for _, o in sorted(seen)]
                keep = [i for i in range(len(a)) if a[i] or b[i]]
                plus.append([a[i] for i in keep])
                minus.append([b[i] for i in keep])
            return pa.record_batch(
                [batch[1], pa.array(held, pa.list_(pa.int32())), pa.array(plus, pa.list_(pa.list_(pa.int32()))), pa.array(minus, pa.list_(pa.list_(pa.int32())))],
                ["toxic", "held", "plus", "minus"],
            )

        return work

    held = by_batch(
        rows.select("text", "toxic"), make,
        "toxic int, held array<int>, plus array<array<int>>, minus array<array<int>>",
    ).collect()
    weights, intercept = fit_weights(
        [(r.toxic, r.held) for r in held],
        [(p, q) for r in held for p, q in zip(r.plus, r.minus, strict=True)],
        len(names),
        counterfactual=counterfactual,
    )
    return Model(dict(zip(names, weights.tolist(), strict=True)), intercept)


def score(docs: DataFrame, model: Model, *, threshold: float = THRESHOLD) -> DataFrame:
    """``row`` with all columns of ``docs``, then ``score`` and ``predicted``."""
    bound = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        weights, intercept = bound.value.weights, bound.value.intercept

        class Words(dict):
            """A word's features that have a weight; most have none."""

            def __missing__(self, token: str) -> tuple[str, ...]:
                found = tuple(f for f in word_features(token) if f in weights)
                if len(self) > 500_000:
                    self.clear()
                if len(token) <= 64:
                    self[token] = found
                return found

        words = Words()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = []
            for text in batch["row"].field("text").to_pylist():
                held = set().union(*filter(None, map(words.__getitem__, set((text or "").split()))))
                logit = intercept + sum(weights[f] for f in sorted(held))
                scores.append(float(1 / (1 + np.exp(-np.clip(logit, -30, 30)))))
            marks = [int(s >= threshold) for s in scores]
            columns = [batch["row"], pa.array(scores, pa.float64()), pa.array(marks, pa.int32())]
            return pa.record_batch(columns, ["row", "score", "predicted"])

        return work

    rows = docs.select(as_row(docs))
    return by_batch(rows, make, schema_of(rows, "score double, predicted int"))


def training_rows(
    docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, folds: int = 3, held: int = 1
) -> DataFrame:
    """``text, toxic`` of labelled rows outside the held-out fold, ``sample`` on
    average. Their ids and labels are as many and are sent to every task."""
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(crc_remainder(F.col("doc_id"), folds) != held)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = known.count()
    scale = 1 << 30
    if n > sample:
        known = known.where(
            F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < int(scale * sample / n)
        )
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic")


def classify(
    docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, threshold: float = THRESHOLD
) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``."""
    model = fit(training_rows(docs, labels, sample=sample), sample=sample)
    scored = score(docs.select("doc_id", "text"), model, threshold=threshold)
    return scored.select(
        "row.doc_id",
        (crc_remainder(F.col("row.doc_id"), 3) == 1).alias("held_out"),
        "score",
        "predicted",
    )


def keep_clean(
    docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, columns unchanged."""
    model = fit(training_rows(docs, labels, sample=sample), sample=sample)
    return score(docs, model, threshold=threshold).where("predicted = 0").select(from_row(docs))
