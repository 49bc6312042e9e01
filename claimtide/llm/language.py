"""Language identification with blended-spectrum string kernels.

The kernel of two texts counts the character n-grams (1 to 3 characters, lower-cased) present in both, divided by the
root of the product of the numbers present in each.  Presence is kept in 2^18 hashed places.  Nystroem's method writes
every text by its kernels with a few landmark texts, K(landmarks, landmarks)^(-1/2) maps them to features, and
one-versus-rest kernel ridge regression on these gives a value for each language.

Presence, kernels and regression are all linear in the places, so the fitted model folds into one matrix, places times
languages: a batch of texts is scored by one product of its presence matrix with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimtide.llm.common import fold, replace_columns, staged

ORDERS = 3
PLACES_BITS = 18
PLACES = 1 << PLACES_BITS
# Bounds of what is fitted: labelled texts over all languages and the least of each, and landmarks.
FIT_TEXTS, LEAST_TEXTS, LANDMARKS = 2_400, 20, 256
RIDGE = 1e-3
# Characters hashed at once; longer texts go in steps that overlap.
STEP = 1 << 20
# Presence matrices are built for so many places at a time.
BATCH_CELLS = 1 << 24
UNKNOWN = "und"
# Longest piece, in characters, that ``resemblance`` scores at once; about the length of the texts models are fitted on.
PIECE = 4096
# Odd multiplier of the hash: 2^64 over the golden ratio.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)


def mark(text: str, seen: np.ndarray, orders: range = range(1, ORDERS + 1), bits: int = PLACES_BITS) -> None:
    """Set the places of all n-grams of a text; ``seen`` has 2^bits entries."""
    shift = np.uint64(64 - bits)
    longest = orders[-1]
    for start in range(0, len(text), STEP):
        points = code_points(text[start:start + STEP + longest - 1])
        code = np.zeros(len(points), dtype=np.uint64)
        for n in range(1, longest + 1):
            if len(points) < n:
                break
            # Codes of n characters from those of n - 1: 21 bits a character, so up to three are exact before hashing.
            code = code[:len(points) - n + 1] * np.uint64(1 << 21) + points[n - 1:]
            if n > 3:
                code ^= code >> np.uint64(29)
            if n in orders:
                seen[(code * MULTIPLIER) >> shift] = True


def presence(text: str) -> np.ndarray:
    seen = np.zeros(PLACES, dtype=bool)
    mark(text, seen)
    return np.flatnonzero(seen)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


# Fitting -------------------------------------------------------------------------------------------------------------

def sample(docs: DataFrame, texts: int = FIT_TEXTS) -> DataFrame:
    """A bounded sample of labelled rows, as even over languages as there are rows, chosen by a hash of id and text.

    Labels are counted first, so that each language is thinned before its rows are ranked.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("lang") != "")).select(
        "lang", "text", F.col("doc_id").cast("string").alias("doc_id"))
    counts = staged(usable.groupBy(F.col("lang").alias("known")).agg(F.count(F.lit(1)).alias("rows")))
    each = max(LEAST_TEXTS, texts // max(1, counts.count()))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    # The written counts show Spark their true size; a row that is thinned out here goes no further.
    thinned = usable.join(counts, F.col("lang") == F.col("known")).withColumn("drawn", drawn).filter(
        F.col("drawn") < 2.0 * each / F.col("rows"))
    order = Window.partitionBy("lang").orderBy("drawn", "text")
    return thinned.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= each).select("lang", "text")


def pack(present: np.ndarray) -> bytes:
    """Places as numbers or as bits, whichever is shorter: 32 KB at most, however long the text."""
    if 4 * len(present) < PLACES // 8:
        return present.astype("<i4").tobytes()
    seen = np.zeros(PLACES, dtype=bool)
    seen[present] = True
    return np.packbits(seen).tobytes()


def unpack(data: bytes) -> np.ndarray:
    if len(data) == PLACES // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(data, dtype=np.uint8)))
    return np.frombuffer(data, dtype="<i4")


class Model:
    """Languages, the places that any landmark has, and the folded matrix of these places times languages."""

    def __init__(self, languages: list[str], places: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.languages, self.places, self.weights, self.bias = languages, places, weights, bias

    def values(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Regression values of texts given by their places, one row a text, one column a language, and the shares of
        their places that any landmark has."""
        out, share = np.zeros((len(rows), len(self.languages))), np.zeros(len(rows))
        step = max(1, BATCH_CELLS // max(1, len(self.places)))
        for first in range(0, len(rows), step):
            part = rows[first:first + step]
            dense = np.zeros((len(part), len(self.places)), dtype=np.float32)
            norm = np.ones(len(part))
            for i, present in enumerate(part):
                if len(present):
                    seen = np.zeros(PLACES, dtype=bool)
                    seen[present] = True
                    dense[i] = seen[self.places]
                    norm[i] = np.sqrt(len(present))
            out[first:first + step] = (dense @ self.weights) / norm[:, None] + self.bias
            share[first:first + step] = dense.sum(axis=1) / norm ** 2
        return out, share


def fit(texts: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on texts given by their places; see ``fit_packed``."""
    return fit_packed([pack(t) for t in texts], labels, landmarks, ridge)


def fit_packed(packed: list[bytes], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on packed texts in any order: rows are sorted first, so the model doesn't depend on it.

    Texts are unpacked one at a time, landmarks aside.
    """
    order = sorted(range(len(labels)), key=lambda i: (labels[i], len(packed[i]), packed[i]))
    packed, labels = [packed[i] for i in order if len(packed[i])], [labels[i] for i in order if len(packed[i])]
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros(0, dtype=np.int64), np.zeros((0, 0), dtype=np.float32), np.zeros(0))
    rng = np.random.default_rng(11)
    chosen = []
    for lang in languages:  # landmarks are spread evenly over the languages
        own = [i for i, x in enumerate(labels) if x == lang]
        chosen += sorted(rng.permutation(own)[:max(1, landmarks // len(languages))].tolist())
    anywhere = np.zeros(PLACES, dtype=bool)
    for i in chosen:
        anywhere[unpack(packed[i])] = True
    places = np.flatnonzero(anywhere)
    where = np.full(PLACES, -1, dtype=np.int64)
    where[places] = np.arange(len(places))
    base = np.zeros((len(places), len(chosen)), dtype=np.float32)  # places times landmarks, normalised
    for j, i in enumerate(chosen):
        own = unpack(packed[i])
        base[where[own], j] = 1 / np.sqrt(len(own))
    among = (base.T @ base).astype(np.float64)
    values, vectors = np.linalg.eigh(among)
    good = values > 1e-6 * values[-1]
    half = vectors[:, good] / np.sqrt(values[good])
    kernels = np.zeros((len(packed), len(chosen)))
    for i, data in enumerate(packed):
        present = unpack(data)
        inside = where[present]
        kernels[i] = base[inside[inside >= 0]].sum(axis=0) / np.sqrt(len(present))
    features = kernels @ half
    target = np.array([[x == lang for lang in languages] for x in labels], dtype=np.float64)
    count = np.array([max(1, labels.count(lang)) for lang in languages])
    weight = 1 / count[np.array([languages.index(x) for x in labels])]  # every language weighs the same
    weight /= weight.sum()
    middle, level = weight @ features, weight @ target
    centred = features - middle
    gram = centred.T @ (centred * weight[:, None]) + ridge * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, centred.T @ ((target - level) * weight[:, None]))
    return Model(languages, places, (base @ (half @ solved)).astype(np.float32), level - middle @ solved)


def fit_on(docs: DataFrame, texts: int = FIT_TEXTS, landmarks: int = LANDMARKS) -> Model:
    """Fit on a bounded sample of ``docs`` (``text, lang``); whole texts become places on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pack(presence(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["lang", "places"])

    rows = sample(docs, texts).mapInArrow(run, "lang string, places binary").collect()
    return fit_packed([bytes(r.places) for r in rows], [r.lang for r in rows], landmarks)


# Scoring -------------------------------------------------------------------------------------------------------------

def pieces(text: str, size: int) -> list[str]:
    """The whole text in as few pieces of almost equal length as hold at most ``size`` characters each."""
    count = max(1, -(-len(text) // size))
    cuts = [len(text) * i // count for i in range(count + 1)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:])]


def resemblance(text: str, model: Model, size: int = PIECE) -> float:
    """Mean over the pieces of a text of the score that ``predict`` gives to a piece; 0 if nothing was learned.

    The score itself falls with the length of a text, as landmarks know a limited number of n-grams; the mean over
    pieces of bounded length doesn't.  Up to ``size`` characters both are the same.
    """
    if not model.languages:
        return 0.0
    parts, total = pieces(text, size), 0.0
    for first in range(0, len(parts), 256):
        found, share = model.values([presence(p) for p in parts[first:first + 256]])
        total += float((np.clip(found.max(axis=1), 0.0, 1.0) * share).sum())
    return total / len(parts)


def with_resemblance(docs: DataFrame, model: Model, name: str = "resemblance") -> DataFrame:
    """The columns of ``docs`` but the text, with the ``resemblance`` of the whole text; 0 without a letter."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = replace_columns(docs, **{name: F.col("text")}).drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() for t in batch.column(batch.num_columns - 1))
            found = [resemblance(t, shared.value) if has_letter(t) else 0.0 for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())],
                                             names=batch.schema.names)

    return kept.mapInArrow(run, kept.drop(name).schema.add(name, "double"))


def predict(docs: DataFrame, model: Model, name: str = "lang_pred", value: str = "score") -> DataFrame:
    """The columns of ``docs`` but the text, with ``lang_pred`` and ``score``, or as they are named.

    ``score`` is the regression value of the predicted language, cut to 0 and 1, times the share of the text's n-grams
    that any landmark has: a text in an unknown script scores low.  Texts that are NULL or have no letter
    are ``und`` with score 0, and so is every text if there was nothing to learn from.  Ties go to the language that
    is first in order.  Texts of any length are read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = replace_columns(docs, **{name: F.col("text"), value: F.lit(0.0)}).drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            languages, scores = [], []
            texts = batch.column(batch.num_columns - 2)
            for first in range(0, len(texts), 256):
                part = [t.as_py() for t in texts.slice(first, 256)]
                asked = [i for i, t in enumerate(part) if known.languages and has_letter(t)]
                found, share = known.values([presence(part[i]) for i in asked])
                names, values = [UNKNOWN] * len(part), [0.0] * len(part)
                for i, row, seen in zip(asked, found, share):
                    at = int(np.argmax(row))
                    names[i], values[i] = known.languages[at], float(min(1.0, max(0.0, row[at])) * seen)
                languages += names
                scores += values
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(languages, pa.string()), pa.array(scores)],
                                             names=batch.schema.names)

    return kept.mapInArrow(run, kept.schema)


def identify(docs: DataFrame, parts: int = 4, held_out: int = 2, **options) -> DataFrame:
    """Columns of ``docs`` but the text, with ``held_out``, ``lang_pred`` and ``score``; see ``predict``.

    Learns from rows whose crc32 of the id modulo ``parts`` is not ``held_out``, with text and language given.  Only
    the text goes into a prediction.  Repeated rows and ids get the same result; an empty table gives an empty one.
    """
    inside = fold("doc_id", parts) != held_out
    model = fit_on(docs.filter(inside).select("doc_id", "text", "lang"), **options)
    return predict(replace_columns(docs, held_out=~inside), model)
