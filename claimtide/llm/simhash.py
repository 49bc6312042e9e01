"""Near-duplicates by SimHash: fingerprints, pigeonhole blocks, exact Hamming distance, components.

Two fingerprints that differ in at most ``distance`` bits, cut into ``distance + 3`` pieces, agree in at least three
pieces.  Every fingerprint is therefore filed under each choice of three pieces (20 keys of about 32 bits for distance
3), and only fingerprints that share a key are compared.  Equal fingerprints are one node before that, so copies cost
nothing.  A key with very many fingerprints is dealt out in tiles, and pairs of tiles are compared by separate tasks.
Each task returns links that connect what it found connected, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimtide.llm.common import free_name, replace_columns, row_key, staged, words_of
from claimtide.llm.components import components

WORDS = 3
DISTANCE = 3
SEED = 42
TILE = 4096
# Shingles whose bits are counted at once.
STEP = 8192


def fingerprint(text: str | None, width: int = WORDS) -> int:
    """64 bits, each 1 if it is set in more than half the hashes of the shingles; 0 for a text without words."""
    words = words_of(text)
    if not words:
        return 0
    count = max(1, len(words) - width + 1)
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0] + [e + 1 for e in ends[:-1]]
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, dtype=np.int64)
    view = memoryview(joined)
    for low in range(0, count, STEP):
        high = min(count, low + STEP)
        last = ends[low + width - 1:high + width - 1] if len(words) >= width else ends[-1:]
        hashes = np.array([digest(view[i:j], SEED) for i, j in zip(starts[low:high], last)], dtype="<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = (2 * set_bits > count).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str = "fingerprint", text: str = "text", width: int = WORDS) -> DataFrame:
    """All columns but the text, with the fingerprint as a long of the same bits."""
    kept = replace_columns(docs, **{name: F.col(f"`{text}`")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), width) for t in batch.column(batch.num_columns - 1)], dtype=np.uint64)
            columns = [*batch.columns[:-1], pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    schema = kept.drop(name).schema.add(name, "long")
    return kept.mapInArrow(run, schema)


def block_keys(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp`` once for each choice of three pieces, with the choice and the bits of its pieces as ``key``."""
    pieces = distance + 3
    cuts = [64 * i // pieces for i in range(pieces + 1)]
    masks = []
    for choice in combinations(range(pieces), 3):
        mask = sum(((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in choice)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
                        for i, m in enumerate(masks)])
    return prints.select("fp", F.explode(choices).alias("k")).select("k.choice", "k.key", "fp")


def candidate_tiles(keys: DataFrame, tile: int = TILE) -> DataFrame:
    """Rows of keys with at least two fingerprints, filed under pairs of tiles ``low, high`` of bounded size."""
    sizes = keys.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    rows = keys.join(sizes, ["choice", "key"]).withColumn("tiles", tiles)
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return rows.select("choice", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")


def linked(groups: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``distance`` bits inside groups (equal adjacent numbers) that connect all that is connected there.

    Compares each fingerprint with the one d places on, for growing d; pairs that earlier links connect are left out.
    """
    n = len(groups)
    starts = np.concatenate([[0], np.flatnonzero(np.diff(groups)) + 1]) if n else np.zeros(0, dtype=np.int64)
    lengths = np.diff(np.append(starts, n))
    first, end = np.repeat(starts, lengths), np.repeat(starts + lengths, lengths)
    label, alive, d, one, two = np.arange(n), np.arange(n), 1, [], []
    while len(alive := alive[end[alive] - alive > d]):
        other = alive + d
        near = np.bitwise_count(prints[alive] ^ prints[other]) <= distance
        near &= label[alive] != label[other]
        for i, j in zip(alive[near].tolist(), other[near].tolist()):
            a, b = sorted((label[i], label[j]))
            if a != b:
                part = label[first[i]:end[i]]
                part[part == b] = a
                one.append(i)
                two.append(j)
        d += 1
    return np.array(one, dtype=np.int64), np.array(two, dtype=np.int64)


def near_links(prints: DataFrame, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp`` (not NULL) that connect all within ``distance`` bits."""
    tiles = candidate_tiles(block_keys(prints, distance), tile)
    order = ["choice", "key", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def links(columns: list[np.ndarray]) -> pa.RecordBatch:
            change = np.zeros(len(columns[0]), dtype=bool)
            for c in columns[:4]:
                change[1:] |= c[1:] != c[:-1]
            prints_ = columns[4]
            i, j = linked(np.cumsum(change), prints_.view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(prints_[i]), pa.array(prints_[j])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                columns = [np.concatenate([a, b]) for a, b in zip(rest, columns)]
            # The last group may go on in the next batch; a group has at most two tiles.
            same = np.ones(len(columns[0]), dtype=bool)
            for c in columns[:4]:
                same &= c == c[-1]
            cut = len(same) - int(same.sum())
            rest = [c[cut:] for c in columns]
            if cut:
                yield links([c[:cut] for c in columns])
        if rest is not None:
            yield links(rest)

    dealt = tiles.repartition(*order).sortWithinPartitions(*order)
    return dealt.select(*order, "fp").mapInArrow(run, "a long, b long").distinct()


def group_near_duplicates(docs: DataFrame, width: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, row_key, fp, component_id, keeper`` for every document.

    Documents are linked if their fingerprints differ in at most ``distance`` bits; ``component_id`` is the smallest
    doc_id reachable over links.  ``row_key`` is the md5 of id and text, ``keeper`` that of the one document of the
    group to keep: the one with the smallest id, of equal ids the smallest key; NULL ids last.

    NULL, empty and blank texts have fingerprint 0 and are linked like others.  A NULL id takes part, but is no
    component id unless the group has no other.  Repeated rows stay repeated.  A text with fewer words than a shingle
    is one shingle.  An empty table gives an empty result; other columns are ignored.
    """
    prints = staged(with_fingerprint(docs.select("doc_id", row_key("doc_id", "text").alias("row_key"), "text"), "fp",
                                     width=width))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first")
    classes = staged(prints.groupBy("fp").agg(first))
    roots = components(near_links(classes.select("fp"), distance))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    table = rooted.select("fp", "root").join(heads, "root").select(F.col("fp").alias("_fp"), "head")
    return prints.join(table, F.col("fp") == F.col("_fp")).select(
        "doc_id", "row_key", "fp", F.col("head.doc_id").alias("component_id"), F.col("head.row_key").alias("keeper"))


def keep_one(docs: DataFrame, width: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` with one document of each group; of rows equal in id and text one stays.

    The texts are exchanged once, by their key, to meet the keys that stay.
    """
    groups = group_near_duplicates(docs, width, distance)
    key, other, nth = (free_name(docs, n) for n in ("_key", "_kept", "_nth"))
    kept = groups.filter(F.col("keeper") == F.col("row_key")).select(F.col("row_key").alias(other)).distinct()
    found = docs.withColumn(key, row_key("doc_id", "text")).join(kept, F.col(key) == F.col(other), "left_semi")
    once = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return found.withColumn(nth, once).filter(F.col(nth) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
