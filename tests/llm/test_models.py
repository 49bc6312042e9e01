"""Language identification, toxicity and the language model."""

import base64
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimtide.llm import language, lattice, toxicity
from claimtide.llm.common import words_of

SF = "/root/testdata/sf0.01"


def crc(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


# Language ------------------------------------------------------------------------------------------------------------

def grams(text):
    low = text.lower()
    return {low[i:i + n] for n in (1, 2, 3) for i in range(len(low) - n + 1)}


def place(gram, bits=language.PLACES_BITS):
    code = 0
    for n, c in enumerate(gram, 1):
        code = (code * 2 ** 21 + ord(c) + 1) % 2 ** 64
        if n > 3:
            code ^= code >> 29
    return code * 0x9E3779B97F4A7C15 % 2 ** 64 >> 64 - bits


@pytest.mark.parametrize("text", ["Éa", "The cat.\n", "日本語", "a" * 50, "\U0001F600 x"])
def test_places_are_those_of_the_grams(text):
    assert set(language.presence(text).tolist()) == {place(g) for g in grams(text)}


def test_long_texts_are_read_whole(monkeypatch):
    text = "abc déf " * 500 + "zq"
    whole = language.presence(text)
    monkeypatch.setattr(language, "STEP", 7)
    assert (language.presence(text) == whole).all()


def test_kernel_machine_equals_the_direct_form():
    """The folded matrix gives what kernels, Nystroem features and ridge regression give step by step."""
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcde" if i % 2 else "defgh"), 40)) for i in range(40)]
    labels = ["x" if i % 2 else "y" for i in range(40)]
    rows = [language.presence(t) for t in texts]
    model = language.fit(rows, labels, landmarks=40)  # every text is a landmark: Nystroem is exact
    sets = [set(r.tolist()) for r in rows]
    kernel = np.array([[len(a & b) / math.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    mid = kernel - kernel.mean(axis=0)
    centred = mid - mid.mean(axis=1)[:, None]
    target = np.array([[x == "x", x == "y"] for x in labels], dtype=float)
    dual = np.linalg.solve(centred / 40 + language.RIDGE * np.eye(40), (target - target.mean(axis=0)) / 40)
    direct = centred @ dual + target.mean(axis=0)
    assert np.abs(model.values(rows)[0] - direct).max() < 2e-3


@pytest.mark.parametrize("table", ["ugly", "clashing"])
def test_language_of_ugly_documents(request, table):
    docs = request.getfixturevalue(table)
    rows, source = language.identify(docs).collect(), docs.collect()
    assert Counter((r.doc_id, r.held_out) for r in rows) == Counter((r.doc_id, crc(r.doc_id, 4) == 2) for r in source)
    learned = {r.lang for r in source if r.lang and r.text is not None and crc(r.doc_id, 4) != 2}
    lettered = {r.doc_id for r in source if r.doc_id is not None and language.has_letter(r.text)}
    for r in rows:
        assert 0 <= r.score <= 1 and (r.lang_pred in learned or r.lang_pred == "und")
        if r.doc_id in (3, 4, 5, 6):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id in lettered:
            assert r.lang_pred != "und"


def test_language_without_anything_to_learn(spark, nothing):
    assert language.identify(nothing).count() == 0
    rows = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify(rows).collect()] == [("und", 0.0)]


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.identify(docs.select("doc_id", "text", "lang")).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(known) and np.mean([r.lang_pred == known[r.doc_id] for r in held]) > 0.98
    again = language.identify(docs.select("doc_id", "text", "lang").repartition(5)).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in rows}


# Toxicity ------------------------------------------------------------------------------------------------------------

def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert len(rows) == docs.count() and all(r.held_out == (crc(i, 5) == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    held = [(rows[r.doc_id].predicted, r.toxic) for r in labels.collect() if rows[r.doc_id].held_out]
    assert np.mean([p for p, t in held if t]) > 0.6 and np.mean([p for p, t in held if not t]) < 0.03


def test_labels_teach_and_ids_do_not(spark):
    texts = [(i, ("kind words here " if i % 2 else "vile scum words ") + f"and more {i % 7}") for i in range(200)]
    docs = spark.createDataFrame(texts + [(None, "vile scum words"), (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)] + [(None, 1), (3, None), (5, 0)], "doc_id long, toxic int")
    rows = toxicity.classify(docs.withColumn("Score", F.lit("mine")), labels).collect()
    for r in rows:
        if r.doc_id is None or r.doc_id < 200:
            assert r.predicted == (r.doc_id is None or r.doc_id % 2 == 0)
    empty = {r.doc_id: r.score for r in rows if r.doc_id in (900, 901)}
    assert empty[900] == empty[901]


def test_toxicity_of_ugly_documents(ugly, clashing, nothing, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    some = spark.createDataFrame([(1, 1), (2, 0), (7, 0), (9, None)], "doc_id long, toxic int")
    assert toxicity.classify(nothing, none).count() == 0
    for docs in (ugly, clashing):
        assert {r.predicted for r in toxicity.classify(docs, none).collect()} == {0}
        rows = toxicity.classify(docs, some).collect()
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())


def test_features_are_those_of_the_grams():
    text = "Vile\tSCUM, été"
    low = " vile scum, été "
    want = {place(low[i:i + n], toxicity.BITS) for n in range(4, 8) for i in range(len(low) - n + 1)}
    assert set(np.flatnonzero(toxicity.places_of(text)).tolist()) == want


def test_regression_by_brute_force():
    """Newton steps on the penalised likelihood, one text after the other, lead to the same weights."""
    rng = np.random.default_rng(4)
    present = rng.random((60, 5)) < 0.4
    ratio = np.array([1.5, -0.7, 0.3, 2.0, -1.1])
    labels = (present @ ratio + rng.normal(size=60) > 0.8).astype(float)
    weight, bias = toxicity.regress([np.packbits(row) for row in present], labels, ratio, rounds=3000)
    found = np.zeros(6)
    for _ in range(50):
        slope, bend = np.append(toxicity.RIDGE * found[:5], 0.0), np.diag([toxicity.RIDGE] * 5 + [0.0])
        for row, label in zip(present, labels):
            x = np.append(row * ratio, 1.0)
            chance = 1 / (1 + math.exp(-x @ found))
            slope += (chance - label) * x
            bend += chance * (1 - chance) * np.outer(x, x)
        found -= np.linalg.solve(bend, slope)
    assert np.allclose(weight, found[:5], atol=2e-3) and abs(bias - found[5]) < 2e-3


def test_scores_by_brute_force(spark):
    """Scores of the query's own fit, made from the grams of whole texts one by one."""
    texts = [(i, ("kind words here " if i % 2 else "vile scum words ") + f"and more {i % 7}") for i in range(120)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)], "doc_id long, toxic int")
    inside = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    model = toxicity.fit_on(docs.filter(inside), labels.filter(inside))
    weights = dict(zip(model.places.tolist(), model.weights.tolist()))
    for r in toxicity.classify(docs, labels).collect():
        low = f" {texts[r.doc_id][1]} "
        found = {place(low[i:i + n], toxicity.BITS) for n in range(4, 8) for i in range(len(low) - n + 1)}
        want = 1 / (1 + math.exp(-model.bias - sum(weights.get(p, 0.0) for p in found)))
        assert abs(r.score - want) < 1e-6 and r.predicted == (r.score >= 0.5)


def test_log_count_ratios():
    other, toxic = np.array([9, 0, 5, 2]), np.array([1, 6, 5, 0])
    places, ratio = toxicity.choose(other, toxic, [10, 10], 2)
    want = np.log((toxic + 1) / (toxic.sum() + 1) / ((other + 1) / (other.sum() + 1)))
    assert places.tolist() == [0, 1] and np.allclose(ratio, want[:2])


# Language model ------------------------------------------------------------------------------------------------------

def all_ways(surface, scores):
    if not surface:
        return 1.0
    return sum(math.exp(scores[surface[:n]]) * all_ways(surface[n:], scores)
               for n in range(1, len(surface) + 1) if surface[:n] in scores)


def test_forward_sums_all_segmentations():
    pieces = lattice.read_vocabulary()
    scores = lattice.first_scores(pieces)
    assert abs(sum(map(math.exp, scores.values())) - 1) < 1e-9 and {bytes([b]) for b in range(256)} <= set(pieces)
    table = lattice.with_prefixes(scores)
    some = (b"the", b"thntionti", "éèan".encode(), b"\xff\x00", b"x", b"th", b"then", b"then", b"thena", b"a")
    for word, found in zip(some, lattice.forward(some, lattice.with_suffixes(scores)), strict=True):
        assert abs(found - math.log(all_ways(b" " + word, scores))) < 1e-9
        counts = lattice.expected(word, table)
        assert abs(sum(len(p) * n for p, n in counts.items()) - len(word) - 1) < 1e-9
        numbers = {p: i for i, p in enumerate(pieces)}
        sums = [0] * len(pieces)
        lattice.add_expected(word, 1000, {p: x and (math.exp(x), numbers[p]) for p, x in table.items()}, sums)
        assert all(abs(sums[numbers[p]] / lattice.UNIT / 1000 - n) < 1e-5 for p, n in counts.items())
    assert next(lattice.forward([b"qz" * 30_000], lattice.with_suffixes(scores))) < -10_000


def test_every_piece_of_the_vocabulary_that_fits_is_used():
    with open(lattice.VOCABULARY, "rb") as lines:
        given = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    usable = {p for p in given if p == p.lower() and not set(p[1:]) & set(b" \t\n\r\v\f")}
    assert usable <= set(lattice.read_vocabulary()) and max(map(len, usable)) > 24


def test_scores_of_whole_documents_are_sums_over_all_segmentations(spark):
    texts = ["The cat sat on the mat", "the CAT, the dog", "", None, "on on on", "a new word: zyx", "cats dogmat"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string")
    training = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 7 != 2)
    counts = Counter(w for r in training.collect() for w in [*words_of(r.text), b""])
    n, v = sum(counts.values()), len(counts)
    words = lattice.word_table(training.select("text", F.lit(True).alias("trains")))
    scores, end = lattice.fit_scores(words, lattice.read_vocabulary(), counts[b""])

    def word_score(w):
        pieces = all_ways(b" " + w, scores) if w else math.exp(end)
        return math.log10((n * counts[w] / n + v * pieces) / (n + v))

    for r in lattice.score_corpus(docs, head_words=4).collect():
        want = sum(word_score(w) for w in [*words_of(texts[r.doc_id % len(texts)]), b""])
        assert abs(r.score - want) < 1e-6, r


def test_one_round_of_fitting_by_brute_force(spark):
    """Expected pieces by going through all segmentations, one added to each, give the fitted scores."""
    docs = spark.createDataFrame([("the cat the mat",), ("cat then",)], "text string")
    pieces = lattice.read_vocabulary()
    first, wanted = lattice.first_scores(pieces), Counter()
    for w, count in Counter(b"the cat the mat cat then".split()).items():
        surface, ways = b" " + w, []
        for cuts in range(1 << (len(surface) - 1)):
            edges = [0, *[i + 1 for i in range(len(surface) - 1) if cuts >> i & 1], len(surface)]
            parts = [surface[a:b] for a, b in zip(edges, edges[1:])]
            if all(p in first for p in parts):
                ways.append((math.exp(sum(first[p] for p in parts)), parts))
        total = sum(x for x, _ in ways)
        for x, parts in ways:
            for p in parts:
                wanted[p] += count * x / total
    scores, end = lattice.fit_scores(lattice.word_table(docs.select("text", F.lit(True).alias("trains"))), pieces, 2)
    whole = sum(1 + wanted[p] for p in pieces) + 2
    assert all(abs(math.exp(scores[p]) - (1 + wanted[p]) / whole) < 1e-3 / whole for p in pieces)
    assert abs(math.exp(end) - 2 / whole) < 1e-3 / whole


def test_long_frequent_words_are_held(spark):
    docs = spark.createDataFrame([(i, "-" * 70 + " x") for i in range(50)], "doc_id long, text string")
    words = lattice.word_table(docs.select("text", F.lit(True).alias("trains"))).withColumn("score", F.lit(-1.0))
    held = lattice.held_words(words, lattice.Totals(150, 3), 10)
    assert lattice.held_key(b"-" * 70) in held and b"x" in held and max(map(len, held)) <= lattice.HEAD_BYTES
    clash = docs.select("*", *[F.lit(1).alias(c) for c in ("_row", "_tokens", "_known", "_base", "_words", "_counts", "_more_base")])
    assert [r.score for r in lattice.score_corpus(clash).collect()] == [r.score for r in lattice.score_corpus(docs).collect()]


def check_scores(docs, rows):
    source = docs.collect()
    counts, ends = Counter(), 0
    for r in source:
        if crc(r.doc_id, 7) != 2:
            counts.update(words_of(r.text))
            ends += 1
    counts[b""] = ends
    n, v = sum(counts.values()), len([c for c in counts.values() if c])
    want = Counter()
    for r in source:
        tokens = words_of(r.text) + [b""]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        want[r.doc_id, crc(r.doc_id, 7) == 2, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 3)] += 1
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3)) for r in rows)
    assert got == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


@pytest.mark.parametrize("table,head", [("ugly", 100_000), ("clashing", 3), ("documents", 500)])
def test_document_scores(request, table, head):
    docs = request.getfixturevalue(table)
    few = lattice.score_corpus(docs, head_words=head).collect()
    check_scores(docs, few)
    if head == 500:  # the held table and the join give the same scores
        many = {r.doc_id: r.score for r in lattice.score_corpus(docs).collect()}
        assert all(abs(many[r.doc_id] - r.score) < 1e-6 * abs(r.score) for r in few)


def test_word_scores_form_a_distribution(spark):
    """The scores of all known words and of the end leave room for what is not known."""
    docs = spark.createDataFrame([(i, "a b b c c c dd" * (i % 3)) for i in range(20)], "doc_id long, text string")
    words = lattice.word_table(docs.select("text", F.lit(True).alias("trains")))
    row = words.agg(F.sum("count"), F.count("word")).first()
    scores, end = lattice.fit_scores(words, lattice.read_vocabulary(), 20)
    rows = lattice.add_scores(lattice.scored_words(words, scores, end), lattice.Totals(row[0], row[1])).collect()
    total = sum(10 ** r.score for r in rows)
    assert 0.6 < total < 1 and abs(sum(map(math.exp, scores.values())) + math.exp(end) - 1) < 1e-9


def test_no_texts(spark, nothing):
    assert lattice.score_corpus(nothing).count() == 0
    held = spark.range(100).filter(F.crc32(F.col("id").cast("string")) % 7 == 2).select(
        F.col("id").alias("doc_id"), F.lit("only held out").alias("text"))
    rows = lattice.score_corpus(held).collect()
    assert rows and all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and r.score < 0 for r in rows)
