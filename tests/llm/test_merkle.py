"""The Merkle manifest against trees built node by node."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from claimtide.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(hashes, fan):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + fan]) for i in range(0, len(out[-1]), fan)])
    return out


def way(tree, at, fan):
    """Siblings before and after the node of each level."""
    for level in tree[:-1]:
        first = at - at % fan
        run = level[first:first + fan]
        yield "".join(run[:at - first]), "".join(run[at - first + 1:])
        at //= fan


def expected(rows, fan=2):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root, verified) of rows in the order of the fields."""
    groups = {}
    for row in rows:
        doc_id, source, lang, n_chars, text = (row[c] for c in merkle.FIELDS)
        struck = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        shown = n_chars + struck if n_chars is not None else None
        leaf = digest(*map(framed, (doc_id, source, lang, n_chars, text)))
        groups.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, doc_id,
                                            digest(*map(framed, (doc_id, source, lang, shown, text)))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fan) for g in names}
    top = levels([trees[g][-1][0] for g in names], fan)
    out = []
    for place, g in enumerate(names):
        for at, (*_, leaf, doc_id, shown) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = [*way(trees[g], at, fan), *way(top, place, fan)]
            root = shown
            for left, right in steps:
                root = digest(left, root, right)
            out.append((doc_id, leaf, trees[g][-1][0], top[-1][0], digest(*[a + b for a, b in steps]), root, root == top[-1][0]))
    return sorted(out, key=repr)


def found(docs, **options):
    out = merkle.verify_documents(docs, **options).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("steps")), 256), "folded_root", "verified")
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("fan, depth", [(2, 3), (3, 2)])
def test_blocks_make_the_same_tree(documents, fan, depth):
    assert found(documents, fan=fan, depth=depth) == expected(documents.collect(), fan)


def test_nulls_ties_repeats_and_long_texts(ugly, clashing):
    rows = ugly.collect()
    assert found(ugly) == expected(rows)
    assert found(clashing) == expected(rows)


def test_nothing_and_one_row(nothing, ugly):
    assert found(nothing) == []
    one = ugly.filter("doc_id = 4")
    (row,) = found(one)
    assert row[1] == row[2] == row[3] and row[4] == digest()


def test_many_rows_alike_fill_more_than_one_block(spark):
    docs = spark.range(300).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same").alias("text"),
                                   F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"),
                                   F.lit(4).cast("long").alias("n_chars"))
    assert found(docs, depth=4) == expected(docs.collect())


def test_large_groups_are_dealt_in_blocks(documents):
    placed = merkle.numbered(documents.select(F.lit("+all").alias("label"), "doc_id", F.sha2("text", 256).alias("hash")),
                             [F.col("doc_id")])
    assert sorted(r.pos for r in placed.collect()) == list(range(documents.count()))
    climbs, roots = merkle.tree(placed, depth=3)
    assert len(climbs) > 1 and roots.count() == 1
    assert climbs[0].groupBy("label", "block").count().agg(F.max("count")).first()[0] == 8
