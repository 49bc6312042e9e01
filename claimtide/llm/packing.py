"""Packing documents into length buckets of least padding.

Every document is padded to the upper bound of its bucket.  The bounds come from a dynamic programme over all distinct
lengths, so no other choice of as many bounds pads less.  Inside a bucket documents follow each other in
hash order and are cut into batches that hold the same number of padded tokens, the token budget.
"""

from __future__ import annotations

from array import array

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import free_name, repeat_rows, running_total, word_count

BUCKETS = 16
BATCH_TOKENS = 65_536
# Up to here each length is a cell of ``histogram_cell``; above, its cells are 1/128 of a power of two wide, at most
# 16,384 + 49 * 128 whatever the data.  Bounds don't come from these cells, as those on a cell's longest length pad more.
EXACT_UPTO = 16_384


def histogram_cell(length: Column) -> Column:
    power = F.length(F.bin(length)) - 1
    wide = F.lit(EXACT_UPTO) + (power - 14) * 128 + F.floor(length / F.pow(F.lit(2.0), power - 7)).cast("long") - 127
    return F.when(length <= EXACT_UPTO, length).otherwise(wide).cast("long")


def best_bounds(cells: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Bounds of least padding for cells ``(longest length, documents, tokens)``, sorted by length.

    cost(k, j) = min over i < j of cost(k-1, i) + longest_j * (docs_j - docs_i) - (tokens_j - tokens_i), with docs and
    tokens summed up to a cell.  For fixed k the terms are lines in longest_j whose slopes fall with i, so a lower hull
    with a moving pointer finds every minimum in linear time.  Of equal choices the earliest split is taken.
    """
    longest = [c[0] for c in cells]
    docs, tokens = [0], [0]
    for _, n, t in cells:
        docs.append(docs[-1] + n)
        tokens.append(tokens[-1] + t)
    n, buckets = len(cells), min(buckets, len(cells))
    if not n:
        return []
    cost = [longest[j - 1] * docs[j] - tokens[j] if j else 0 for j in range(n + 1)]
    choice = [array("q", [0]) * (n + 1)]
    for k in range(2, buckets + 1):
        hull: list[tuple[int, int, int]] = []
        at, new, pick = 0, [0] * (n + 1), array("q", [0]) * (n + 1)
        for j in range(k, n + 1):
            i = j - 1
            line = (-docs[i], cost[i] + tokens[i], i)
            while len(hull) >= 2 and _needless(hull[-2], hull[-1], line):
                hull.pop()
            hull.append(line)
            at = min(at, len(hull) - 1)
            x = longest[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                at += 1
            new[j] = hull[at][0] * x + hull[at][1] + x * docs[j] - tokens[j]
            pick[j] = hull[at][2]
        cost = new
        choice.append(pick)
    bounds, j = [], n
    for k in range(buckets, 0, -1):
        bounds.append(longest[j - 1])
        j = choice[k - 1][j]
    return bounds[::-1]


def _needless(a, b, c) -> bool:
    """Whether line ``b`` is nowhere below both its neighbours; slopes fall from ``a`` to ``c``."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def length_bounds(lengths: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Bounds for the column ``length``; one row per distinct length reaches the driver.

    D distinct lengths need at least D * (D - 1) / 2 words, so they are few: under 100,000 for 5 * 10^9 words.
    """
    found = lengths.groupBy("length").agg(F.count(F.lit(1)).alias("docs")).collect()
    return best_bounds(sorted((r.length, r.docs, r.length * r.docs) for r in found), buckets)


def pack_documents(docs: DataFrame, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS,
                   length: Column | None = None) -> DataFrame:
    """Bucket, batch and place of every document.

    Returns ``doc_id, length, bucket, bound, batch, place, padding``.  ``length`` is the number of words unless given.
    A batch of bucket b holds max(1, batch_tokens // bound) documents, the last batch of a bucket perhaps fewer; a
    document above the budget is a batch of its own.  Batches are numbered from 0 in each bucket.

    NULL and empty texts have length 0 and are packed like others; NULL ids too.  Rows equal in id and length are
    counted before they are exchanged and take adjacent places.  Fewer lengths than buckets give one bucket each.  An
    empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select("doc_id", (word_count("text") if length is None else length).cast("long").alias("length"))
    bounds = length_bounds(rows, buckets)
    copies, order, copy = (free_name(rows, n) for n in ("_copies", "_order", "_copy"))
    limits = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    distinct = rows.groupBy("doc_id", "length").agg(F.count(F.lit(1)).alias(copies))
    bucket = F.size(F.filter(limits, lambda b: b < F.col("length")))
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("length").cast("string")))
    placed = distinct.withColumn("bucket", bucket).withColumn(order, key)
    numbered = running_total(placed, ["bucket"], order, copies, "slot", ("doc_id", "length"))
    each = repeat_rows(numbered, copies, copy).withColumn("bound", F.get(limits, F.col("bucket")))
    slot = F.col("slot") + F.col(copy)
    holds = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(batch_tokens) / F.greatest(F.col("bound"), F.lit(1).cast("long"))))
    return each.select("doc_id", "length", "bucket", "bound", F.floor(slot / holds).alias("batch"),
                       (slot % holds).cast("int").alias("place"), (F.col("bound") - F.col("length")).alias("padding"))
