"""Phrase mining against counts of all phrases."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimtide.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least=30, covered=80, kept=2000):
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in range(1, 5):
                own.update(zip(*[w[i:] for i in range(n)]))
    out = []
    for lang, own in counts.items():
        longest = Counter()
        for p, a in own.items():
            if a >= least and len(p) > 2:
                for n in range(2, len(p)):
                    for i in range(len(p) - n + 1):
                        longest[p[i:i + n]] = max(longest[p[i:i + n]], a)
        scored = []
        for p, a in own.items():
            if len(p) > 1 and a >= least and 100 * longest[p] < covered * a:
                score, _, left, right = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]])
                                            for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, words[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(scored)[:kept], 1)]
    return sorted(out)


def found(docs, **options):
    rows = phrases.mine_phrases(docs, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r) for r in rows.collect())


def pairs(docs):
    return [(r.lang, r.text) for r in docs.select("lang", "text").collect()]


def test_documents(documents):
    assert found(documents, least=5, kept=300) == expected(pairs(documents), 5, kept=300)


def test_small_stripes_merge_to_the_same(documents):
    assert found(documents, least=5, gathered=500) == expected(pairs(documents), 5)


def texts_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(["x"] * len(rows)), pa.array([t.encode() for _, t in rows], pa.binary())],
                                      names=["lang", "text"])


def test_counts_in_small_steps(documents, monkeypatch):
    """One task's phrases, counted in small steps over parts of texts, are those of the whole texts."""
    monkeypatch.setattr(phrases, "AT_ONCE", 100)
    monkeypatch.setattr(phrases, "WAITING", 300)
    rows = pairs(documents)[:60]
    want = [Counter() for _ in range(4)]
    for _, text in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text.translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in range(4):
                want[n].update(" ".join(p) for p in zip(*[w[i:] for i in range(n + 1)]))
    sieve = phrases.Sieve()
    for size in range(4):
        words = phrases.Words("x")
        own = phrases.Gathered(words, size) if size else phrases.GatheredWords(words)
        for _, part, starts in phrases.words_by_language(iter([texts_batch(rows)])):
            numbers, hashes = words.look_up(part)
            assert own.add(numbers, hashes, sieve, starts)
        totals, longer = Counter(), Counter()
        for r in own.stripes(sieve)[0].to_pylist():
            assert r["size"] == size and (r["part"] == 0 or size == 0)
            totals[r["prefix"].decode()] += r["total"]
            longer.update({(r["prefix"] + b" " + w).decode().strip(): n for w, n in zip(r["nexts"], r["counts"])})
        assert longer == want[size] and (totals == want[size - 1] if size else totals[""] == sum(want[0].values()))


def test_too_many_words_for_their_numbers(monkeypatch):
    monkeypatch.setattr(phrases, "NUMBERS", 8)
    words = phrases.Words("x")
    own, sieve = phrases.Gathered(words, 1), phrases.Sieve()
    assert own.add(*words.look_up([b"a", b"b", b"c", b"d"]), sieve, 4) and own.add(*words.look_up([b"b", b"a"]), sieve, 2)
    assert not own.add(*words.look_up([b"e", b"f", b"g", b"h"]), sieve, 4) and own.long == [0, 1, 2, 3, 4]


def test_bitmaps_keep_every_frequent_phrase_and_few_others(spark):
    known = [("en", f"w{i} v{i}") for i in range(3000)]
    bits, bitmap = phrases.bitmap_of(spark.createDataFrame(known, "lang string, phrase string"))
    assert len(bitmap) == 1 << (bits - 3)
    words = phrases.Words("en")
    for texts, low, high in ((known, 3000, 3000), ([("en", f"w{i} v{i + 1}") for i in range(3000)], 0, 300)):
        _, hashes = words.look_up([w for _, t in texts for w in (*t.encode().split(), b".")])
        assert int(hashes[1][0]) == phrases.hash_of("en", texts[0][1].encode())
        at = phrases.places(hashes[1][::3], bits)
        assert low <= int(((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).sum()) <= high


def test_blocks_merge_elementwise(spark, monkeypatch):
    def batch(*rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), phrases.KINDS)], schema=phrases.SCHEMA)
    rows = [("fr", b"b", 1, 0, 2, [b"x"], [1]), ("en", b"a", 1, 0, 5, [b"x", b"y"], [2, 3]), ("en", b"a", 1, 1, 0, [b"q"], [1]),
            ("en", b"a", 1, 0, 4, [b"y", b"z"], [1, 1]), ("fr", b"a", 1, 0, 7, [], []), ("fr", b"b", 1, 0, 2, [b"x"], [1])]
    want = [("en", b"a", 0, 9, {b"x": 2, b"y": 4}), ("en", b"a", 1, 0, {}), ("fr", b"a", 0, 7, {}), ("fr", b"b", 0, 4, {b"x": 2})]
    got = phrases.merge_rows(pa.Table.from_batches([batch(*rows)]), 2).to_pylist()
    assert [(r["lang"], r["prefix"], r["part"], r["total"], dict(zip(r["nexts"], r["counts"]))) for r in got] == want
    whole = batch(*rows)
    hashes = np.arange(6, dtype=np.uint64) << np.uint64(20)
    packed = phrases.blocks(whole, hashes, 2)
    assert packed.column(0).to_pylist() == [0, 1] and phrases.unpacked(packed.column(1)[1].as_py()).num_rows == 3
    sent = [(7, phrases.blocks(batch(r), np.zeros(1, dtype=np.uint64), 1).column(1)[0].as_py()) for r in rows]
    merged = phrases.merged_stripes(spark.createDataFrame(sent, "bucket long, block binary"), 2).collect()
    assert sorted((r.lang, bytes(r.prefix), r.part, r.total, {bytes(w): n for w, n in zip(r.nexts, r.counts)}) for r in merged) == [
        w for w in want if w[2] == 0]


def test_full_bitmaps_change_nothing(documents, monkeypatch):
    """Bitmaps with all bits set keep nothing out; the result is the same."""
    wanted = expected(pairs(documents), 10)
    monkeypatch.setattr(phrases, "bitmap_of", lambda known: (16, np.full(1 << 13, 255, dtype=np.uint8)))
    assert found(documents, least=10) == wanted


def test_ugly_texts(spark, ugly, clashing, nothing):
    extra = spark.createDataFrame([(None, "A b\tc. a  b c, É é\x1cx a b"), ("und", "a b c a b c a b c"), ("x", "...;"), ("y", " ")],
                                  "lang string, text string")
    docs = ugly.select("lang", "text").unionByName(extra)
    assert found(docs, least=2) == expected(pairs(docs), 2)
    assert found(clashing, least=2) == expected(pairs(ugly), 2)
    assert found(nothing) == []


def test_repeated_words_and_overlaps(spark):
    docs = spark.createDataFrame([("en", "no " * 50), ("en", "yes no yes no " * 20)], "lang string, text string")
    assert found(docs, least=3) == expected(pairs(docs), 3)


def test_products_past_64_bits(spark):
    """Counts as large as ten million million: the score stays exact."""
    big = 9_999_999_999_999
    rows = [("en", b"", 0, 0, 4 * big, [], []), ("en", b"a", 1, 0, big, [b"b"], [big - 1]), ("en", b"b", 1, 0, big + 7, [], []),
            ("en", b"a b", 2, 0, big - 1, [], [])]
    merged = spark.createDataFrame(rows, phrases.STRIPES)
    (row,) = phrases.score_phrases(merged).collect()
    assert (row.phrase, row.a, row.l, row.r) == ("a b", big - 1, big, big + 7)
    assert row.score == 2_000_000 * (big - 1) // (2 * big + 7)


def test_one_prefix_is_striped_in_parts(spark, monkeypatch):
    docs = spark.createDataFrame([("en", " ".join(f"the w{i}." for i in range(500)))], "lang string, text string").withColumn(
        "text", F.col("text").cast("binary"))
    monkeypatch.setattr(phrases, "PART_ROWS", 40)
    hot = phrases.hot_prefixes(spark.createDataFrame([("en", "the", 500), ("en", "w1", 40)], "lang string, phrase string, a long"))
    assert hot == {phrases.hash_of("en", b"the"): 16}
    found = phrases.gathered_stripes(docs, phrases.Sieve(hot=hot), 1, 8).collect()
    rows = [r for f in found for r in phrases.unpacked(bytes(f.block)).to_pylist()]
    own = [r for r in rows if r["prefix"] == b"the"]
    assert len(own) == 16 and sum(r["total"] for r in own) == 500 and sum(len(r["nexts"]) for r in own) == 500
    assert all(r["part"] == 0 for r in rows if r["prefix"] != b"the") and len({f.bucket for f in found}) == 8


@pytest.mark.parametrize("text", [b"", b"a", b"A,b", b"x\ty\x0bz"])
def test_words_and_stops(text):
    got = [[w.decode() for w in p.split(b" ") if w] for p in b" ".join(phrases.words_and_stops(text)).split(b".")]
    want = [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0a-\x0d]", text.decode().translate(LOWER))]
    assert [p for p in got if p] == [p for p in want if p]
