import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from claimtide.llm import simhash
from claimtide.llm.components import components


def print_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def roots_of(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def links_of(prints):
    values = np.array(prints, dtype=np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= 3):
            yield prints[i], prints[i + 1 + int(j)]


@pytest.mark.parametrize("table", ["ugly", "clashing", "documents"])
def test_groups(request, table):
    docs = request.getfixturevalue(table)
    source, rows = docs.collect(), simhash.group_near_duplicates(docs).collect()
    prints = {r.text: print_of(r.text) for r in source if len(r.text or "") < 200_000}
    got = Counter((r.doc_id, r.fp % 2 ** 64) for r in rows)
    assert not Counter((r.doc_id, prints[r.text]) for r in source if r.text in prints) - got and sum(got.values()) == len(source)
    distinct = sorted({r.fp % 2 ** 64 for r in rows})
    root = roots_of(distinct, links_of(distinct))
    least = {}
    for r in rows:
        at = root[r.fp % 2 ** 64]
        least[at] = min((x for x in (least.get(at), r.doc_id) if x is not None), default=None)
    assert all(r.component_id == least[root[r.fp % 2 ** 64]] for r in rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = Counter(root[simhash.fingerprint(r.text)] for r in kept.collect())
    assert set(groups) == set(least) and set(groups.values()) == {1}


def test_empty(nothing):
    assert simhash.group_near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


def test_close_pairs_tiles_and_chains(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(12):  # chains of single steps, dense clouds and lone prints
        at = rng.getrandbits(64)
        for _ in range(60):
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            prints.add(at)
        prints |= {at ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(40)}
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - 2 ** 64 if p >= 2 ** 63 else p,) for p in prints], "fp long")
    root = roots_of(prints, links_of(prints))
    for tile in (4096, 16):
        links = simhash.near_links(frame, tile=tile).collect()
        pairs = [(r.a % 2 ** 64, r.b % 2 ** 64) for r in links]
        assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
        assert roots_of(prints, pairs) == root


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1400)]
    odd = [(5000, 5000), (6001, 6000), (6000, 6001), (None, 7)]
    edges = path + star + odd
    random.Random(1).shuffle(edges)
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    found = {r.node: r.root for r in rows if r.node != r.root}
    assert found == {**{i: 0 for i in range(1, 201)}, **{i: 1000 for i in range(1001, 1400)}, 6001: 6000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_spark_hash_is_the_reference_hash(spark):
    texts = ["", "a b c", "é à ü", "x" * 1000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()
    assert all(r.h % 2 ** 64 == xxhash.xxh64_intdigest(r.t.encode(), 42) for r in rows)
