"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

An n-gram (4 to 7 characters, lower-cased, white space as one kind of space, hashed to 2^20 places) counts as present or
absent in a text, which begins and ends with a space, so that beginnings of words are n-grams of their own.  Its log-count
ratio compares how often toxic and other labelled texts have it; a logistic regression is trained on presence times
ratio.  Only the places with the strongest ratios, weighed by how often they occur, take part in the regression: a long
text has nearly every common n-gram, which says nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import fold, replace_columns, staged
from claimtide.llm.language import mark

ORDERS = range(4, 8)
BITS = 20
# Bounds of what is fitted: labelled rows, and places in the regression.
FIT_ROWS, FEATURES = 24_000, 2_048
SMOOTH, RIDGE, ROUNDS = 1.0, 0.1, 100
# A place must be in this many toxic or other texts to be a feature.
LEAST_TEXTS = 3


SPACES = str.maketrans("\t\n\v\f\r", "     ")


def places_of(text: str) -> np.ndarray:
    """All places, true where the text has an n-gram of the place."""
    seen = np.zeros(1 << BITS, dtype=bool)
    if text:
        mark(f" {text.translate(SPACES)} ", seen, ORDERS, BITS)
    return seen


class Model:
    """Selected places, their weights (regression weight times ratio) and the intercept."""

    def __init__(self, places: np.ndarray, weights: np.ndarray, bias: float):
        self.places, self.weights, self.bias = places, weights, bias

    def score(self, text: str | None) -> float:
        if not text:
            value = self.bias
        else:
            value = self.bias + float(self.weights[places_of(text)[self.places]].sum())
        return float(1 / (1 + np.exp(-np.clip(value, -500, 500))))


def sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``text, toxic`` of at most about ``rows`` labelled documents, thinned by a hash of their ids.

    A document with several labels has the greatest of them.  The thinned labels are bounded, so the documents meet
    them without being exchanged.
    """
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = known.count()
    chance = min(1.0, rows / max(1, total))
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    thinned = known.filter(drawn < chance) if chance < 1 else known
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(thinned), "doc_id").select(
        "text", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"))


def place_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Texts of each class that have a place, for all places, and the texts of each class.

    Every task adds up its own texts; the sums have at most 2^20 rows, whatever the data.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, texts = np.zeros((2, 1 << BITS), dtype=np.int64), [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                counts[toxic.as_py()] += places_of(text.as_py())
                texts[toxic.as_py()] += 1
        some = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(counts[0, some], texts[0])),
             pa.array(np.append(counts[1, some], texts[1]))], names=["place", "other", "toxic"])

    sums = rows.mapInArrow(run, "place long, other long, toxic long").groupBy("place").agg(
        F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    found = sums.filter((F.col("other") >= LEAST_TEXTS) | (F.col("toxic") >= LEAST_TEXTS) | (F.col("place") < 0)).toArrow()
    place, other, toxic = (found[c].to_numpy() for c in ("place", "other", "toxic"))
    counts = np.zeros((2, 1 << BITS), dtype=np.int64)
    inside = place >= 0
    counts[0, place[inside]], counts[1, place[inside]] = other[inside], toxic[inside]
    return counts[0], counts[1], [int(other[~inside].sum()), int(toxic[~inside].sum())]


def choose(other: np.ndarray, toxic: np.ndarray, texts: list[int], features: int) -> tuple[np.ndarray, np.ndarray]:
    """Places for the regression and their log-count ratios."""
    ratio = np.log(((toxic + SMOOTH) / (toxic.sum() + SMOOTH)) / ((other + SMOOTH) / (other.sum() + SMOOTH)))
    # Shift between the classes in general (toxic texts may be longer) is no sign of toxicity.
    share, rest = (toxic + SMOOTH) / (texts[1] + 2 * SMOOTH), (other + SMOOTH) / (texts[0] + 2 * SMOOTH)
    both = (toxic + other + SMOOTH) / (sum(texts) + 2 * SMOOTH)
    strength = (share - rest) ** 2 / (both * (1 - both)).clip(1e-9)
    strength[(other < LEAST_TEXTS) & (toxic < LEAST_TEXTS)] = 0
    best = np.lexsort((np.arange(len(strength)), -strength))[:features]
    best = np.sort(best[strength[best] > 0])
    return best, ratio[best]


def present_features(rows: DataFrame, places: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Which of the chosen places each sampled text has, and the labels."""
    shared = rows.sparkSession.sparkContext.broadcast(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.packbits(places_of(t.as_py())[shared.value]).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1)], names=["bits", "toxic"])

    table = rows.mapInArrow(run, "bits binary, toxic int").toArrow().combine_chunks()
    order = sorted(range(len(table)), key=lambda i: (table["toxic"][i].as_py(), table["bits"][i].as_py()))
    bits = [np.frombuffer(table["bits"][i].as_py(), dtype=np.uint8) for i in order]
    return bits, np.array([table["toxic"][i].as_py() for i in order], dtype=np.float64)


def regress(bits: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, ridge: float = RIDGE,
            rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Logistic regression on presence times ratio, by accelerated gradient steps over blocks of rows."""
    n, f = len(labels), len(ratio)
    packed = np.array(bits, dtype=np.uint8).reshape(n, -1)
    block = 2048

    def blocks():
        for i in range(0, n, block):
            yield i, np.unpackbits(packed[i:i + block], axis=1, count=f).astype(np.float32) * ratio.astype(np.float32)

    # The greatest curvature, by power iteration on X'X.
    v = np.ones(f + 1) / np.sqrt(f + 1)
    for _ in range(8):
        w = np.zeros(f + 1)
        for _, x in blocks():
            s = x @ v[:f].astype(np.float32) + v[f]
            w[:f] += x.T @ s
            w[f] += s.sum()
        top = np.linalg.norm(w)
        v = w / max(top, 1e-12)
    step = 1 / (0.25 * top * 1.1 + ridge)
    weight, ahead, t = np.zeros(f + 1), np.zeros(f + 1), 1.0
    rate = labels.mean().clip(1e-6, 1 - 1e-6)
    weight[f] = ahead[f] = np.log(rate / (1 - rate))
    for _ in range(rounds):
        grad = np.zeros(f + 1)
        for i, x in blocks():
            z = x @ ahead[:f].astype(np.float32) + ahead[f]
            off = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[i:i + block]
            grad[:f] += x.T @ off.astype(np.float32)
            grad[f] += off.sum()
        grad[:f] += ridge * ahead[:f]
        new = ahead - step * grad
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, weight = new + (before - 1) / t * (new - weight), new
    return weight[:f], float(weight[f])


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, features: int = FEATURES) -> Model:
    """Fit on a bounded sample of labelled documents; with one class only, every score is its share."""
    chosen = staged(sample(docs, labels, rows))
    other, toxic, texts = place_counts(chosen)
    if not min(texts):
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), 30.0 if texts[1] else -30.0)
    places, ratio = choose(other, toxic, texts, features)
    bits, marks = present_features(chosen, places)
    weight, bias = regress(bits, marks, ratio)
    return Model(places, weight * ratio, bias)


def score_texts(docs: DataFrame, model: Model, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """The columns of ``docs`` but the text, with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = replace_columns(docs, **{score: F.col("text")}).drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=batch.schema.names)

    scored = kept.mapInArrow(run, kept.drop(score).schema.add(score, "double"))
    return replace_columns(scored, **{predicted: F.when(F.col(score) >= 0.5, 1).otherwise(0)})


def classify(docs: DataFrame, labels: DataFrame, parts: int = 5, held_out: int = 0, **options) -> DataFrame:
    """Columns of ``docs`` but the text, with ``held_out``, ``score`` and ``predicted``.

    Labels (``doc_id, toxic``) are learnt only from rows whose crc32 of the id modulo ``parts`` is not ``held_out``;
    only the text goes into a score.  NULL and empty texts have no n-gram and score what the intercept gives.  NULL
    labels and ids teach nothing; without any toxic label nothing is toxic.  Repeated rows get the same score; an empty
    table gives an empty result.  Texts of any length are read whole.
    """
    inside = fold("doc_id", parts) != held_out
    model = fit_on(docs.filter(inside).select("doc_id", "text"), labels.select("doc_id", "toxic").filter(inside), **options)
    return score_texts(replace_columns(docs, held_out=~inside), model)
