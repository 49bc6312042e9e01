import itertools
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimtide.llm import mixing, packing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def padding(cells, bounds):
    return sum(n * min(b for b in bounds if b >= longest) - t for longest, n, t in cells)


def test_bounds_are_optimal():
    rng = random.Random(3)
    for _ in range(200):
        lengths = sorted(rng.sample(range(60), rng.randint(1, 9)))
        cells = [(x, n, n * x) for x in lengths for n in [rng.randint(1, 6)]]
        k = rng.randint(1, 5)
        found = packing.best_bounds(cells, k)
        choices = itertools.combinations(lengths[:-1], min(k, len(cells)) - 1)
        assert padding(cells, found) == min(padding(cells, [*c, lengths[-1]]) for c in choices)
    assert packing.best_bounds([], 4) == []


def test_histogram_cells_are_few_and_ordered(spark):
    rows = spark.range(0, 4_000_000, 13).select("id", packing.histogram_cell(F.col("id")).alias("cell")).toPandas()
    assert rows.cell.is_monotonic_increasing and rows.cell.max() < 16_384 + 49 * 128
    wide = rows[rows.id > 16_384].groupby("cell").id.agg(["min", "max"])
    assert ((wide["max"] - wide["min"]) / wide["max"]).max() < 1 / 120


def test_long_lengths_get_exact_bounds(spark):
    """Six lengths above 16,384 and 16 buckets pad nothing; many long lengths are as good as the exact programme."""
    few = [n for n, k in ((16_400, 500), (16_500, 500), (33_000, 400), (33_200, 400), (66_000, 300), (66_400, 300))
           for _ in range(k)]
    rng = random.Random(1)
    many = [rng.randint(20_000, 90_000) for _ in range(300)]
    for lengths in (few, many):
        docs = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, n long")
        rows = packing.pack_documents(docs, length=F.col("n")).select("bound", "padding").collect()
        cells = [(n, k, n * k) for n, k in sorted(Counter(lengths).items())]
        assert sum(r.padding for r in rows) == padding(cells, packing.best_bounds(cells, 16))
        assert {r.bound for r in rows} == set(packing.best_bounds(cells, 16))
    assert padding([(n, 1, n) for n in few], packing.best_bounds([(n, k, n * k) for n, k in sorted(Counter(few).items())], 16)) == 0


@pytest.mark.parametrize("table", ["ugly", "clashing", "documents"])
def test_batches(request, table):
    docs = request.getfixturevalue(table)
    rows = packing.pack_documents(docs, buckets=4, batch_tokens=300).collect()
    assert Counter((r.doc_id, r.length) for r in rows) == Counter((r.doc_id, size(r.text)) for r in docs.collect())
    batches = defaultdict(list)
    for r in rows:
        assert r.padding == r.bound - r.length >= 0
        batches[r.bucket, r.batch].append(r)
    for (bucket, batch), members in batches.items():
        holds = max(1, 300 // max(1, members[0].bound))
        last = max(b for k, b in batches if k == bucket)
        assert sorted(r.place for r in members) == list(range(len(members))) and len(members) <= holds
        assert len(members) == holds or batch == last


def test_nothing_to_pack_or_mix(nothing):
    assert packing.pack_documents(nothing).count() == 0
    assert mixing.plan_mix(nothing).count() == 0 and mixing.mix_documents(nothing).count() == 0


def test_targets():
    assert mixing.targets([100, 100, 100]) == [Fraction(1500, 8), Fraction(600, 8), Fraction(300, 8)]
    found = mixing.targets([1, 100, 400, 0])
    assert found[0] == 3 and found[3] == 0 and sum(found) == 501
    assert all(t <= 3 * s for t, s in zip(found, [1, 100, 400, 0]))
    assert mixing.targets([0, 0]) == [0, 0] and mixing.targets([]) == []


def test_split_quotas():
    blocks = [500, 3, 0, 1200]
    table = mixing.split_quotas(blocks, 7, 5)
    assert table.sum(axis=0).tolist() == blocks and np.ptp(table.sum(axis=1)) <= 1
    assert (table == mixing.split_quotas(blocks, 7, 5)).all()
    # Each share is near its expectation, as in a dealt deck.
    assert abs(table[:, 0] - 500 / 7).max() < 30


@pytest.mark.parametrize("table", ["ugly", "clashing", "documents"])
def test_mix(request, table):
    docs = request.getfixturevalue(table)
    plan = mixing.plan_mix(docs, shards=5, block_words=64).collect()
    source = docs.collect()
    assert Counter((r.doc_id, r["size"], r.source) for r in plan) == Counter((r.doc_id, size(r.text), r.source) for r in source)
    totals = Counter()
    for r in source:
        totals[r.source] += size(r.text)
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(order, mixing.targets([totals[s] for s in order])))
    taken = Counter()
    for r in plan:
        assert r.source_size == totals[r.source] and abs(r.target - wanted[r.source]) < 1e-6
        assert len(r.shards) <= 3 and all(0 <= s < 5 for s in r.shards)
        taken[r.source] += len(r.shards) * r["size"]
    for s in order:
        largest = max(size(r.text) for r in source if r.source == s)
        assert abs(taken[s] - wanted[s]) <= largest / 2 + 1
    again = mixing.plan_mix(docs.repartition(3), shards=5, block_words=64).collect()
    key = lambda rows: Counter((r.row_key, tuple(r.shards)) for r in rows)
    assert key(again) == key(plan)
    plan = mixing.plan_mix(docs, shards=5, block_words=64, key=tuple(docs.columns)).collect()
    mix = mixing.mix_documents(docs, shards=5, block_words=64)
    assert {c.lower() for c in docs.columns} | {"shard", "mix_order"} == {c.lower() for c in mix.columns}
    rows = mix.collect()
    assert Counter((r.doc_id, r.text, r.source) for r in rows) == Counter(
        {k: n for k, n in _copies(plan, source, docs.columns).items() if n})
    assert Counter(r.shard for r in rows) == Counter(s for r in plan for s in r.shards)


@pytest.mark.parametrize("doc_id, long, weights", [(-2, 300_000, (1, 5)), (-1, 100_000, (3, 11))])
def test_one_document_far_larger_than_the_gap(spark, doc_id, long, weights):
    """Short documents fill what a very long one would leave open or overshoot, and are dealt over all shards."""
    rows = [(i, "a " * (50 + i % 100), "big") for i in range(2_000)]
    rows += [(doc_id, "b " * long, "big"), (-3, "c " * 400_000, "small")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_mix(docs, shards=5, block_words=64, weights=weights).collect()
    taken = sum(len(r.shards) * r["size"] for r in plan if r.source == "big")
    assert abs(taken - next(r.target for r in plan if r.source == "big")) <= 50
    assert len({s for r in plan if r.source == "big" for s in r.shards}) == 5


def _copies(plan, source, columns):
    """Times that each id, text and source is taken, over the rows that differ anywhere."""
    import hashlib
    drawn, out = Counter(), Counter()
    for r in plan:
        drawn[r.row_key] += len(r.shards)
    for r in {tuple(r): r for r in source}.values():
        values = ["-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in columns]
        out[r.doc_id, r.text, r.source] += drawn[hashlib.md5("".join(values).encode()).hexdigest()]
    return out


def test_rows_that_differ_anywhere_are_rows_of_their_own(spark):
    """NULL against empty, strokes inside values, and other columns: every copy has the columns of its own row."""
    rows = [(1, "same text " * 3, None, "x", 1), (1, "same text " * 3, "", "y", 2), (2, "y z y z y z", "a|x", "en", 3),
            (2, "x|y z y z y z", "a", "en", 4),
            (3, "one two", "s", "en", 5), (3, "one two", "s", "fr", 6), (3, "one two", "s", None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, mine int")
    mixed = mixing.mix_documents(docs, shards=2, block_words=1, weights=(1,)).collect()
    assert {r.mine for r in mixed} == {1, 2, 3, 4, 5, 6, 7}
    assert {tuple(r[:5]) for r in mixed} == set(rows)
    plan = mixing.plan_mix(docs, shards=2, block_words=1, weights=(1,), key=tuple(docs.columns)).collect()
    assert len({r.row_key for r in plan}) == 7 and len(mixed) == sum(len(r.shards) for r in plan)
