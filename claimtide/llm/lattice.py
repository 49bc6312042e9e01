"""Document probabilities under a subword unigram model, summed over all segmentations.

The pieces are those of an existing public vocabulary, and its order gives them their first scores.  The scores are then
fitted to the training texts by one round of expectation maximisation over the distinct words, each weighed by its count.
A word, led by a space, is a lattice of pieces; the forward recursion, in log space, adds up the probabilities of all its
segmentations.  It depends on what stands before a place only, so words in sorted order share what they begin with.  No piece spans two words, so a text's marginal probability is the product of its words' and of the end's.

Words are counted once over the whole corpus.  A document is scored by the most frequent words, a table of fixed size
that every task holds, and by a join for all the others.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from math import exp, log, log10

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide.llm.common import fold, free_name, replace_columns, staged, words_of

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
ROUNDS = 1
# Words that every task holds; those of more bytes are held by their digest.
HEAD_WORDS, HEAD_BYTES = 100_000, 64
# Distinct words that a task gathers before it passes their counts on.
GATHERED = 200_000
# Expected counts are summed as whole multiples of 1/1024: the sum doesn't depend on its order.
UNIT = 1024
# Words of at most so many bytes have probabilities far above the smallest double.
SHORT = 24
LN10 = log(10)


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """Pieces in order of rank that can occur in a lower-cased word led by a space, and every single byte."""
    pieces = []
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                pieces.append(base64.b64decode(line.split()[0]))
    usable = [p for p in pieces if p == p.lower() and (len(p) == 1 or p[1:].split() == [p[1:]])]
    known = set(usable)
    return usable + [bytes([b]) for b in range(256) if bytes([b]) not in known]


def first_scores(pieces: list[bytes]) -> dict[bytes, float]:
    """Natural log probabilities that fall with the rank as 1 / (rank + 100)."""
    total = sum(1 / (r + 100) for r in range(len(pieces)))
    return {p: -log((r + 100) * total) for r, p in enumerate(pieces)}


def with_prefixes(scores: dict[bytes, float]) -> dict[bytes, float | None]:
    """The scores, and None for every beginning of a piece that is no piece itself."""
    table: dict[bytes, float | None] = dict(scores)
    for p in scores:
        for n in range(1, len(p)):
            table.setdefault(p[:n], None)
    return table


def arcs(word: bytes, table: dict[bytes, float | None]) -> Iterator[tuple[int, int, bytes, float]]:
    n = len(word)
    for i in range(n):
        for j in range(i + 1, n + 1):
            piece = word[i:j]
            score = table.get(piece, False)
            if score is False:
                break
            if score is not None:
                yield i, j, piece, score


def log_sum(values: list[float]) -> float:
    if len(values) == 1:
        return values[0]
    top = max(values)
    return top + log(sum([exp(v - top) for v in values]))


def with_suffixes(scores: dict[bytes, float]) -> dict[bytes, float | None]:
    """The scores, and None for every end of a piece that is no piece itself."""
    table: dict[bytes, float | None] = dict(scores)
    for p in scores:
        for n in range(1, len(p)):
            table.setdefault(p[n:], None)
    return table


def forward(words: Iterable[bytes], table: dict[bytes, float | None]) -> Iterator[float]:
    """Natural log of the probability of each word, led by a space, over all its segmentations.

    ``table`` comes from ``with_suffixes``.  Sums at places that a word has in common with the one before are taken over.
    """
    get, before, reached = table.get, b"", [0.0]
    for word in words:
        surface = b" " + word
        same = 0
        for x, y in zip(before, surface):
            if x != y:
                break
            same += 1
        del reached[same + 1:]
        for j in range(same + 1, len(surface) + 1):
            incoming = []
            for i in range(j - 1, -1, -1):
                score = get(surface[i:j], False)
                if score is False:
                    break
                if score is not None:
                    incoming.append(reached[i] + score)
            if len(incoming) == 1:
                reached.append(incoming[0])
            else:
                top = max(incoming)
                reached.append(top + log(sum([exp(v - top) for v in incoming])))
        before = surface
        yield reached[-1]


def expected(word: bytes, table: dict[bytes, float | None]) -> dict[bytes, float]:
    """Expected number of each piece in the segmentations of a word, by forward and backward sums."""
    surface = b" " + word
    n, found = len(surface), list(arcs(surface, table))
    ahead: list[list[float]] = [[] for _ in range(n + 1)]
    ahead[0] = [0.0]
    alpha = [0.0] * (n + 1)
    done = -1
    for i, j, _, score in found:  # arcs come in order of their start
        while done < i:
            done += 1
            alpha[done] = log_sum(ahead[done])
        ahead[j].append(alpha[i] + score)
    total = log_sum(ahead[n])
    back: list[list[float]] = [[] for _ in range(n + 1)]
    back[n] = [0.0]
    beta = [0.0] * (n + 1)
    done = n + 1
    counts: dict[bytes, float] = {}
    for i, j, piece, score in reversed(found):
        while done > i + 1:
            done -= 1
            beta[done] = log_sum(back[done])
        back[i].append(score + beta[j])
        counts[piece] = counts.get(piece, 0.0) + exp(alpha[i] + score + beta[j] - total)
    return counts


def add_expected(word: bytes, count: int, pieces: dict[bytes, tuple | None], sums: list[int]) -> None:
    """Add the expected pieces of a short word, ``count`` times, to ``sums``: as ``expected``, but in probabilities.

    ``pieces`` has the probability and number of every piece and None for every other beginning of one.
    """
    surface = b" " + word
    n, get, found = len(surface), pieces.get, []
    alpha = [0.0] * (n + 1)
    alpha[0] = 1.0
    for i in range(n):
        reached = alpha[i]
        for j in range(i + 1, n + 1):
            piece = get(surface[i:j], False)
            if piece is False:
                break
            if piece is not None:
                alpha[j] += reached * piece[0]
                found.append((i, j, piece))
    beta = [0.0] * (n + 1)
    beta[n] = count * UNIT / alpha[n]
    for i, j, (chance, number) in reversed(found):
        onward = chance * beta[j]
        beta[i] += onward
        sums[number] += round(alpha[i] * onward)


# Corpus counts -------------------------------------------------------------------------------------------------------

def word_table(docs: DataFrame) -> DataFrame:
    """``word, count, total``: every word with its count in training texts and in all; ``docs`` has ``text, trains``.

    The end of a text is the empty word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def passed_on() -> pa.RecordBatch:
            names = list(dict.fromkeys([*counts[0], *counts[1]]))
            rows = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array([counts[1][w] for w in names], pa.int64()),
                 pa.array([counts[0][w] + counts[1][w] for w in names], pa.int64())], names=["word", "count", "total"])
            for c in counts:
                c.clear()
            return rows

        for batch in batches:
            for text, trains in zip(batch.column(0), batch.column(1)):
                own = counts[trains.as_py()]
                own.update(words_of(text.as_py()))
                own[b""] += 1
                if len(own) > GATHERED:
                    yield passed_on()
        yield passed_on()

    rows = docs.select("text", "trains").mapInArrow(run, "word binary, count long, total long")
    return rows.groupBy("word").agg(F.sum("count").alias("count"), F.sum("total").alias("total"))


def fit_scores(words: DataFrame, pieces: list[bytes], ends: int, rounds: int = ROUNDS) -> tuple[dict[bytes, float], float]:
    """Log probabilities of the pieces and of the end after some rounds of expectation maximisation.

    Each round goes over all distinct training words; what comes back has one row per piece.  Every piece keeps one
    expected occurrence more, so that each text has a probability.
    """
    spark, scores = words.sparkSession, first_scores(pieces)
    end = -log(10.0)
    trained = words.filter((F.col("count") > 0) & (F.length("word") > 0)).select("word", "count")
    number = {p: i for i, p in enumerate(pieces)}
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((scores, number))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, numbers = with_prefixes(shared.value[0]), shared.value[1]
            chances = {p: None if x is None else (exp(x), numbers[p]) for p, x in table.items()}
            sums = [0] * len(numbers)
            for batch in batches:
                for word, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if len(word) <= SHORT:
                        add_expected(word, count, chances, sums)
                    else:
                        for piece, share in expected(word, table).items():
                            sums[numbers[piece]] += round(share * count * UNIT)
            some = [i for i, units in enumerate(sums) if units]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([sums[i] for i in some], pa.int64())],
                                             names=["piece", "units"])

        found = trained.mapInArrow(run, "piece long, units long").groupBy("piece").agg(F.sum("units").alias("units")).collect()
        counts = [1.0] * len(pieces)
        for r in found:
            counts[r.piece] += r.units / UNIT
        total = sum(counts) + max(1, ends)
        scores = {p: log(c / total) for p, c in zip(pieces, counts)}
        end = log(max(1, ends) / total)
        shared.unpersist()
    return scores, end


def scored_words(words: DataFrame, scores: dict[bytes, float], end: float) -> DataFrame:
    """``word, count, total, lattice``: with the log10 marginal probability of every word and of the end."""
    shared = words.sparkSession.sparkContext.broadcast(scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = with_suffixes(shared.value)
        for batch in batches:
            own = batch.column(0).to_pylist()
            sums = forward([w for w in own if w], table)
            found = [(next(sums) if w else end) / LN10 for w in own]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "lattice"])

    ordered = words.select("word", "count", "total").sortWithinPartitions("word")
    return ordered.mapInArrow(run, "word binary, count long, total long, lattice double")


# Documents -----------------------------------------------------------------------------------------------------------

class Totals:
    """Training tokens and distinct training words, with the base and the model's probability of a word."""

    def __init__(self, tokens: int, distinct: int):
        self.tokens, self.distinct = tokens, distinct

    def base(self, count: int) -> float:
        return log10((count + 1) / (self.tokens + self.distinct + 1))


def held_key(word: bytes) -> bytes:
    """The word, or a space and the digest of a long one: the table of held words has a fixed size then."""
    return word if len(word) <= HEAD_BYTES else b" " + hashlib.md5(word).digest()


def held_words(words: DataFrame, totals: Totals, head_words: int) -> dict[bytes, tuple[int, float, float]]:
    """Whether known, base and score of the most frequent words, under their ``held_key``."""
    digest = F.concat(F.lit(b" "), F.unhex(F.md5("word")))
    key = F.when(F.length("word") <= HEAD_BYTES, F.col("word")).otherwise(digest)
    head = words.orderBy(F.desc("total"), "word").limit(head_words).select(key.alias("key"), "count", "score")
    return {bytes(r.key): (int(r["count"] > 0), totals.base(r["count"]), r.score) for r in head.toLocalIterator()}


def score_documents(docs: DataFrame, words: DataFrame, totals: Totals, head_words: int = HEAD_WORDS) -> DataFrame:
    """Columns of ``docs`` but the text, with ``n_tokens, n_known, base_score, score``."""
    shared = docs.sparkSession.sparkContext.broadcast(held_words(words, totals, head_words))
    text = free_name(docs, "_text")
    kept = replace_columns(docs, **{text: F.col("text")}).drop("text")
    names = [free_name(kept, n) for n in ("_row", "_tokens", "_known", "_base", "_score", "_words", "_counts")]
    row_, tokens, known_, base_, score_, words_, counts_ = names
    more = [free_name(kept, n) for n in ("_more_known", "_more_base", "_more_score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, row = shared.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            for text in batch.column(batch.num_columns - 1):
                counts = Counter(words_of(text.as_py()))
                counts[b""] = 1
                known, base, score, rare, often = 0, 0.0, 0.0, [], []
                for w, n in counts.items():
                    found = held.get(w) if len(w) <= HEAD_BYTES else held.get(held_key(w))
                    if found is not None:
                        known += n * found[0]
                        base += n * found[1]
                        score += n * found[2]
                    else:
                        rare.append(w)
                        often.append(n)
                for c, v in zip(columns, (row, sum(counts.values()), known, base, score, rare, often)):
                    c.append(v)
                row += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                                             names=[*batch.schema.names[:-1], *names])

    schema = kept.drop(text).schema
    for name, kind in zip(names, ("long", "long", "long", "double", "double", T.ArrayType(T.BinaryType()),
                                 T.ArrayType(T.LongType()))):
        schema = schema.add(name, kind)
    rows = staged(kept.mapInArrow(run, schema))
    rare = rows.select(row_, F.explode(F.arrays_zip(F.col(words_).alias("w"), F.col(counts_).alias("n"))).alias("e")).select(
        row_, F.col("e.w").alias("word"), F.col("e.n").alias("n"))
    base = F.log10((F.col("count") + 1) / F.lit(float(totals.tokens + totals.distinct + 1)))
    sums = rare.join(words, "word").groupBy(row_).agg(
        F.sum(F.when(F.col("count") > 0, F.col("n")).otherwise(0)).alias(more[0]),
        F.sum(F.col("n") * base).alias(more[1]), F.sum(F.col("n") * F.col("score")).alias(more[2]))
    both = rows.drop(words_, counts_).join(sums, row_, "left")
    none = F.lit(0.0)
    return replace_columns(
        both, n_tokens=F.col(tokens), n_known=F.col(known_) + F.coalesce(more[0], F.lit(0)),
        base_score=F.col(base_) + F.coalesce(more[1], none),
        score=F.col(score_) + F.coalesce(more[2], none)).drop(row_, tokens, known_, base_, score_, *more)


def add_scores(words: DataFrame, totals: Totals) -> DataFrame:
    """``word, count, total, score``: the lattice with one more arc for each training word, over all of it.

    That arc has the word's share of the training tokens.  It gets the part N / (N + V) of the whole probability (N
    tokens, V distinct words: Witten and Bell's estimate of what is not new), the pieces get the rest.
    """
    n, v = totals.tokens, totals.distinct
    new = v / (n + v) if n else 1.0
    known = F.log10((1 - new) * F.col("count") / F.lit(float(max(1, n))) + new * F.pow(F.lit(10.0), F.col("lattice")))
    fresh = F.lit(log10(new) if new else 0.0) + F.col("lattice")
    return words.select("word", "count", "total", F.when(F.col("count") > 0, known).otherwise(fresh).alias("score"))


def score_corpus(docs: DataFrame, vocabulary: str = VOCABULARY, parts: int = 7, held_out: int = 2,
                 rounds: int = ROUNDS, head_words: int = HEAD_WORDS) -> DataFrame:
    """Columns of ``docs`` but the text, with the log10 probability of every whole text.

    Adds ``held_out, n_tokens, n_known, train_tokens, base_score, score``.  Tokens are the words, lower-cased A-Z, and
    one end.  Counts come from rows whose crc32 of the id modulo ``parts`` is not ``held_out``.  ``base_score`` adds one
    to every count; ``score`` is the lattice's marginal probability (see ``add_scores``).

    A NULL text is empty: its one token is the end.  Words of any bytes and any length have a score, as every byte is a
    piece.  Repeated rows count, and are scored, each by itself.  Without training rows the first scores of the pieces
    hold.  An empty table gives an empty result.
    """
    inside = fold("doc_id", parts) != held_out
    words = staged(word_table(docs.select("text", inside.alias("trains"))))
    row = words.agg(F.sum("count").alias("n"), F.count(F.when(F.col("count") > 0, 1)).alias("v"),
                    F.sum(F.when(F.length("word") == 0, F.col("count"))).alias("ends")).first()
    totals = Totals(row.n or 0, row.v)
    scores, end = fit_scores(words, read_vocabulary(vocabulary), row.ends or 0, rounds)
    scored = staged(add_scores(scored_words(words, scores, end), totals))
    found = score_documents(replace_columns(docs, held_out=~inside), scored, totals, head_words)
    return replace_columns(found, train_tokens=F.lit(totals.tokens).cast("long"))
