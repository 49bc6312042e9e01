"""Mixing sources to target weights by a splitting tree over exact block quotas.

Each source is a stream: its documents in hash order, pass after pass until its target is reached.  The stream is cut
into blocks of equal words, and the blocks are permuted.  A binary tree over the output shards parts the exact number
of blocks of every source: at each node a multivariate hypergeometric draw decides how many of them go left, as if
the blocks had been dealt from one shuffled deck.  A leaf, one shard, so holds an interval of every source's permuted
blocks: intervals are disjoint, and their union is the whole mix.  Inside a shard rows follow a second hash.

Only one row per source ever reaches the driver; the sources of a mix are few (``MAX_SOURCES`` bounds them).
"""

from __future__ import annotations

from fractions import Fraction
from math import gcd

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimtide.llm.common import (framed, free_name, repeat_rows, replace_columns, running_total, staged,
                                  word_count)

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
MAX_SOURCES = 100_000
# numpy's hypergeometric draws hold fewer than this many blocks; longer mixes get larger blocks.
MAX_BLOCKS = 10 ** 9
# Single documents that may follow the last one that fits; where they leave a source far off, ``_fill`` goes on.
EXTRA = 3
KEY = ("doc_id", "source", "text")


def whole_key(columns) -> Column:
    """md5 of the columns' values; only rows alike in all of them, NULL and empty text apart, share it."""
    return F.md5(F.concat(*[framed(F.col(f"`{c}`")) for c in columns]))


# Facts of all sources up to this size go to every executor.
BROADCAST_BYTES = 16 << 20


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEAT) -> list[Fraction]:
    """Share of all words for each source, in order; no target exceeds ``most`` times its source's size.

    What a capped source can't take is shared by weight among the others, until none is above its cap.
    """
    rest, found = Fraction(sum(sizes)), [Fraction(0)] * len(sizes)
    left = list(range(len(sizes)))
    while left:
        unit = rest / sum(weights[i % len(weights)] for i in left)
        over = [i for i in left if unit * weights[i % len(weights)] > most * sizes[i]]
        if not over:
            for i in left:
                found[i] = unit * weights[i % len(weights)]
            break
        for i in over:
            found[i] = Fraction(most * sizes[i])
            rest -= found[i]
        left = [i for i in left if i not in set(over)]
    return found


def split_quotas(blocks: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (columns) for each shard (rows): exact column sums, row sums at most one apart."""
    total, table = sum(blocks), np.zeros((shards, len(blocks)), dtype=np.int64)
    upto = [total * k // shards for k in range(shards + 1)]
    nodes = [(0, shards, np.array(blocks, dtype=np.int64))]
    while nodes:
        low, high, quota = nodes.pop()
        if high - low == 1:
            table[low] = quota
            continue
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(quota, upto[middle] - upto[low], method="marginals")
        nodes += [(low, middle, left), (middle, high, quota - left)]
    return table


def _sources(rows: DataFrame) -> list:
    found = rows.groupBy("source").agg(F.sum("size").alias("total")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    return sorted(found, key=lambda r: (r.source is None, r.source or ""))


def _by_source(rows: DataFrame, facts: list[tuple], schema: str) -> DataFrame:
    """``rows`` with the facts of their source; the first field of a fact is the source's name.

    The facts, one row per source, are broadcast if their size, known here, is small: then a source with a third of
    all rows isn't brought to one task.
    """
    size = sum(64 + len(str(f[0] or "")) + sum(8 * len(x) for x in f if isinstance(x, list)) for f in facts)
    frame = rows.sparkSession.createDataFrame(facts, f"_name string, {schema}")
    frame = F.broadcast(frame) if size <= BROADCAST_BYTES else frame
    return rows.join(frame, F.col("source").eqNullSafe(F.col("_name"))).drop("_name")


def _nearest_documents(beyond: DataFrame, short: dict) -> dict[str | None, list[tuple[int, int]]]:
    """Up to ``EXTRA`` documents (position, size) of each source, each the nearest in size to what is then missing.

    A document is taken only where it brings the source nearer to its target, and none is taken twice.
    """
    found = {s: [] for s in short}
    for _ in range(EXTRA):
        open_ = [(s, float(n), [pos for pos, _ in found[s]]) for s, n in short.items() if n > 0]
        if not open_:
            break
        off = F.abs(F.col("size") - F.col("short"))
        best = (_by_source(beyond, open_, "short double, had array<long>")
                .filter((off < F.col("short")) & ~F.array_contains("had", F.col("pos")))
                .groupBy("source").agg(F.min(F.struct(off.alias("off"), "pos", "size")).alias("best")).collect())
        short = {s: 0 for s in short} | {r.source: short[r.source] - r.best.size for r in best}
        for r in best:
            found[r.source].append((r.best.pos, r.best.size))
    return found


def _far_off(beyond: DataFrame, short: dict, extra: dict) -> dict:
    """What is missing, for sources that ``extra`` leaves further off than a mean document that could have filled it."""
    off = {s: abs(n - sum(size for _, size in extra[s])) for s, n in short.items()}
    asked = [(s, float(n)) for s, n in short.items() if n > 0 and off[s] >= 1]
    if not asked:
        return {}
    fit = (_by_source(beyond, asked, "short double").filter(F.col("size") <= F.col("short"))
           .groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")).collect())
    return {r.source: short[r.source] for r in fit if off[r.source] * r.docs > r.words}


def _fill(beyond: DataFrame, short: dict) -> tuple[dict, dict]:
    """Fills what each source of ``short`` misses with all documents that still fit, larger size classes first.

    In a class the documents are taken in hash order while they fit, and then the first of the others that does; after
    it none of the class fits.  At last the smallest document too large for the rest follows, if that comes nearer.
    ``beyond`` has the words before a document in its class as ``ahead``.  Returns for each source the words by class
    ``{class: (start, filled)}`` and the single documents ``(position, size, start)``, where ``start`` is the words
    filled before; and what is missing then.
    """
    rest, ranges, single = dict(short), {s: {} for s in short}, {s: [] for s in short}
    start = {s: 0 for s in short}

    def open_sources():
        return [(s, float(n)) for s, n in rest.items() if n >= 1]

    found = _by_source(beyond, open_sources(), "short double").filter(F.col("size") <= F.col("short"))
    for c in sorted((r.kind for r in found.select("kind").distinct().collect()), reverse=True):
        asked = open_sources()
        if not asked:
            break
        own = _by_source(beyond.filter(F.col("kind") == c), asked, "short double")
        end = {r.source: r.filled for r in own.filter(F.col("ahead") + F.col("size") <= F.col("short"))
               .groupBy("source").agg(F.max(F.col("ahead") + F.col("size")).alias("filled")).collect()}
        for s, n in end.items():
            ranges[s][c] = (start[s], n)
            start[s], rest[s] = start[s] + n, rest[s] - n
        asked = [(s, float(rest[s]), end.get(s, 0)) for s, _ in asked if rest[s] >= 1 << c]
        if not asked:
            continue
        late = _by_source(beyond.filter(F.col("kind") == c), asked, "short double, filled long")
        for r in late.filter((F.col("ahead") >= F.col("filled")) & (F.col("size") <= F.col("short"))).groupBy(
                "source").agg(F.min(F.struct("pos", "size")).alias("best")).collect():
            single[r.source].append((r.best.pos, r.best.size, start[r.source]))
            start[r.source], rest[r.source] = start[r.source] + r.best.size, rest[r.source] - r.best.size
    asked = [(s, float(n)) for s, n in rest.items() if n > 0]
    if asked:
        had = [(s, n, [pos for pos, *_ in single[s]], [ranges[s].get(c, (0, 0))[1] for c in range(64)]) for s, n in asked]
        over = _by_source(beyond, had, "short double, had array<long>, filled array<long>").filter(
            (F.col("size") > F.col("short")) & (F.col("size") < 2 * F.col("short"))
            & ~F.array_contains("had", F.col("pos")) & (F.col("ahead") >= F.get("filled", F.col("kind"))))
        for r in over.groupBy("source").agg(F.min(F.struct("size", "pos")).alias("best")).collect():
            single[r.source].append((r.best.pos, r.best.size, start[r.source]))
            rest[r.source] -= r.best.size
    return {s: (ranges[s], single[s]) for s in short}, rest


def _with_fills(placed: DataFrame, further: Column, short: dict, extra: dict) -> tuple[DataFrame, dict, dict]:
    """``placed`` with ``kind`` and ``ahead``, the single documents and the ranges by class that each source takes.

    ``kind`` is the power of two at or below the size of a document that a source's fill may take, -1 for others.
    """
    single, ranges = {s: [(pos, n, 0) for pos, n in extra[s]] for s in short}, {s: {} for s in short}
    far = _far_off(placed.filter(further), short, extra)
    if not far:
        return placed.withColumns({"kind": F.lit(-1), "ahead": F.lit(0).cast("long")}), single, ranges
    marked = _by_source(placed, [(s, s in far) for s in short], "far boolean")
    kind = F.when(F.col("far") & further, F.length(F.bin("size")) - 1).otherwise(-1)
    placed = staged(running_total(marked.withColumn("kind", kind).drop("far"), ["source", "kind"], "row_key", "size",
                                  "ahead", ("doc_id",)))
    ways, rest = _fill(placed.filter("kind >= 0"), far)
    for s in far:
        if abs(rest[s]) < abs(short[s] - sum(n for _, n in extra[s])):
            ranges[s], single[s] = ways[s]
    return placed, single, ranges


def plan_mix(docs: DataFrame, shards: int = 8, block_words: int = 4096, seed: int = 17,
             weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEAT, key: tuple[str, ...] = KEY) -> DataFrame:
    """Where every document goes: ``doc_id, source, size, row_key, source_size, target, shards``.

    ``shards`` has one shard for each time the document is taken, at most ``most``.  A source takes whole passes over
    its documents, then documents in hash order as long as they fit, then up to three further documents, each nearest
    in size to what is still missing, if that brings it nearer.  If these leave the source further off than the mean
    of the documents that could have filled the gap, all documents that still fit are taken in their place, larger size
    classes first and in hash order in a class, and one that overshoots only if it comes nearer; of both ways the
    nearer one counts.  ``row_key`` is the md5 of the values of ``key``: id, source and text unless told otherwise.

    NULL texts and texts without words have size 0; NULL is a source of its own, last in order.  Rows equal in
    the key are separate documents of the stream.  A NULL id takes part like any other.  A source without
    words has target 0.  An empty table gives an empty plan.
    """
    rows = staged(docs.select("doc_id", "source", word_count("text").alias("size"), whole_key(key).alias("row_key")))
    sources = _sources(rows)
    wanted = targets([r.total for r in sources], weights, most)
    info = []
    for r, target in zip(sources, wanted):
        full = int(target // r.total) if r.total else 0
        info.append((r.source, r.total, float(target), full, float(target - full * r.total)))
    placed = staged(_by_source(running_total(rows, ["source"], "row_key", "size", "pos", ("doc_id",)), info,
                               "source_size long, target double, passes long, missing double"))

    fits = F.col("pos") + F.col("size") <= F.col("missing")
    end = {r.source: r.filled or 0 for r in placed.groupBy("source").agg(
        F.max(F.when(fits, F.col("pos") + F.col("size"))).alias("filled")).collect()}
    short = {s: missing - end.get(s, 0) for s, _, _, _, missing in info}
    further = ~fits & (F.col("size") > 0)
    extra = _nearest_documents(placed.filter(further), short)
    placed, extra, ranges = _with_fills(placed, further, short, extra)
    extra_words = {s: sum(n for _, n, _ in extra[s]) + sum(n for _, n in ranges[s].values()) for s in short}
    taken = [full * total + end.get(s, 0) + extra_words[s] for s, total, _, full, _ in info]
    while sum(t // block_words + 1 for t in taken) >= MAX_BLOCKS:
        block_words *= 2
    blocks = [t // block_words + 1 for t in taken]
    upto = np.cumsum(split_quotas(blocks, shards, seed), axis=0) if blocks else []
    drawn = []
    for i, (name, *_) in enumerate(info):
        step = max(1, blocks[i] * 618 // 1000)
        while gcd(step, blocks[i]) != 1:
            step += 1
        last = max(ranges[name], default=-1) + 1
        drawn.append((name, end.get(name, 0), blocks[i], step, [int(row[i]) for row in upto],
                      [pos for pos, _, _ in extra[name]], [at for _, _, at in extra[name]],
                      [ranges[name].get(c, (0, 0))[0] for c in range(last)],
                      [ranges[name].get(c, (0, 0))[1] for c in range(last)]))
    planned = _by_source(placed, drawn, "filled long, blocks long, step long, upto array<long>, extra array<long>, "
                         "extra_at array<long>, range_at array<long>, range_words array<long>")
    ranged = F.coalesce(F.col("ahead") + F.col("size") <= F.get("range_words", F.col("kind")), F.lit(False))
    alone = (F.col("size") > 0) & F.array_contains("extra", F.col("pos"))
    once_more = fits | ranged | alone
    behind = (F.when(ranged, F.get("range_at", F.col("kind")) + F.col("ahead"))
              .when(alone, F.get("extra_at", (F.array_position("extra", F.col("pos")) - 1).cast("int"))).otherwise(0))

    def shard(time):
        """The shard that drew the block in which this pass over the document begins."""
        start = F.when(time < F.col("passes"), time * F.col("source_size") + F.col("pos")).otherwise(
            F.col("passes") * F.col("source_size") + F.least("pos", "filled") + behind)
        block = (F.floor(start / F.lit(block_words)) * F.col("step")) % F.col("blocks")
        return F.size(F.filter(F.col("upto"), lambda end_of: end_of <= block))

    times = F.col("passes") + F.when(once_more & (F.col("passes") < most), 1).otherwise(0)
    draws = F.when(times > 0, F.transform(F.sequence(F.lit(0).cast("long"), times - 1), shard)).otherwise(
        F.array().cast("array<int>"))
    return planned.select("doc_id", "source", "size", "row_key", "source_size", "target", draws.alias("shards"))


def mix_documents(docs: DataFrame, shards: int = 8, names: tuple[str, str] = ("shard", "mix_order"),
                  **options) -> DataFrame:
    """The mix itself: rows of ``docs``, repeated as often as taken, with ``shard`` and ``mix_order`` (or as named).

    Rows are arranged by shard and, inside a shard, by a hash of document and repeat; a large shard covers several
    partitions.  Input columns with the names of added ones are replaced.  Rows that differ in any column, be it a NULL
    against an empty text, are planned apart, and each copy has the columns of its own row; rows alike in all of them
    are exchangeable.  Other cases as in ``plan_mix``.
    """
    plan = plan_mix(docs, shards, key=tuple(docs.columns), **options)
    key, rows, drawn, nth, when = (free_name(docs, n) for n in ("_row_key", "_rows", "_drawn", "_nth", "_when"))
    # All but repeated rows are alone under their key, so nothing unbounded is gathered for them; of repeated rows
    # only counts by shard are, which are as many as there are shards.
    counts = plan.select("row_key", F.explode("shards").alias("shard"), "size").groupBy("row_key", "shard").agg(
        F.count(F.lit(1)).alias(rows))
    by_key = counts.select(F.col("row_key").alias(key), F.col("shard").alias(drawn), rows)
    single = docs.withColumn(key, whole_key(docs.columns))
    first = single.withColumn(nth, F.row_number().over(Window.partitionBy(key).orderBy(key))).filter(F.col(nth) == 1)
    mixed = repeat_rows(first.join(by_key, key), rows, when)
    order = F.md5(F.concat_ws("|", F.col(key), F.col(drawn).cast("string"), F.col(when).cast("string")))
    named = replace_columns(mixed, **dict(zip(names, (F.col(drawn), order)))).drop(key, rows, drawn, nth, when)
    return named.repartitionByRange(*names).sortWithinPartitions(*names)
