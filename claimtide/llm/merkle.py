"""Merkle manifest of a table: a tree of hashes per group, and a tree of the groups' roots above them.

Rows are numbered inside their group in the order of a key.  A run is ``fan`` consecutive nodes of a level, and its
parent is the hash of their hashes; a level's last run may be shorter, and even one node alone gets a parent while its
group has more than one.  Levels are climbed in blocks of ``fan ** DEPTH`` nodes.  Inside a block one window, ordered by
place, serves all levels: the row of a node's first leaf stands for the node, lag and lead columns at the fixed offsets
of the level, masked by the node's slot and by the run's length, supply its siblings, and rows of first children hash
the parent.  The heads of all blocks are the nodes of the next climb.

A group of any size is therefore many small windows, a climb exchanges its nodes once, and each climb has a
``fan ** DEPTH``-th of the rows of the one before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimtide.llm.common import framed, staged

FAN = 2
# Levels climbed in one exchange; a window then holds at most FAN ** DEPTH rows.
DEPTH = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_hash(values: Sequence[Column]) -> Column:
    return digest(*[framed(v) for v in values])


def group_label(group: Column) -> Column:
    """The group as text that is never NULL; labels are in the order of the groups, NULL first and bytewise."""
    return F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), group.cast("string")))


def numbered(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``rows`` with their place ``pos`` (from 0) in the group ``label`` and the group's size ``nodes``, as longs.

    Rows are dealt out by ranges of the label and the order, so that one group may fill many tasks.  Rows alike in both
    are told apart by the place they were read from, and may then part at any range.  The table is written before its
    ranges are counted, so that a task that runs again can't number other rows.
    """
    turn = F.xxhash64("_read").alias("_turn")
    read = rows.select("*", F.monotonically_increasing_id().alias("_read")).select("*", turn)
    keys = [F.col("label"), *order, F.col("_turn")]
    dealt = read.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    written = staged(dealt.select(*rows.columns, F.shiftright("_at", 33).alias("_range"),
                                  F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")))
    counted = written.groupBy("label", "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy("label")
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # A window here has a row for each range that a group touches, and the written table shows Spark its true size.
    starts = staged(counted.select("label", "_range", (F.coalesce(F.sum("_rows").over(before), F.lit(0))
                                                       - F.col("_first")).alias("_start"),
                                   F.sum("_rows").over(group).alias("nodes")))
    return (written.join(starts, ["label", "_range"]).withColumn("pos", F.col("_at") + F.col("_start"))
            .select(*rows.columns, "pos", "nodes"))


def _fewer(nodes: Column, times: int, fan: int) -> Column:
    """Nodes that are left after ``times`` levels."""
    size = fan ** times
    return F.expr(f"(nodes + {size - 1}) div {size}") if times else nodes


def climb(nodes: DataFrame, below: int, depth: int, fan: int = FAN) -> DataFrame:
    """``nodes`` with ``block``, the ``steps`` of each node up to its block's head, and ``top``, set in the head's row.

    ``nodes`` has ``label, pos, nodes, hash`` and more: the nodes that are left after ``below`` levels, with the number
    of the group's leaves.  A step has the siblings' hashes before (``left``) and after (``right``) the node, joined;
    both are empty where a node is alone in its run.  Levels above the group's root have no step.
    """
    size = fan ** depth
    hashed = nodes.select("*", F.expr(f"pos div {size}").alias("block"), F.col("hash").alias("_h0"))
    block = Window.partitionBy("label", "block").orderBy("pos")
    counts = [_fewer(F.col("nodes"), below + level, fan) > 1 for level in range(depth)]
    for level in range(depth):
        apart, name = fan ** level, f"_h{level}"
        near = hashed.select("*", *[f(name, i * apart).over(block).alias(f"{side}{i}") for i in range(1, fan)
                                    for f, side in ((F.lag, "_lag"), (F.lead, "_lead"))])
        number = F.expr(f"pos div {apart}")
        slot = number % fan
        run = F.least(F.lit(fan).cast("long"), _fewer(F.col("nodes"), below + level, fan) - (number - slot))
        left = F.concat_ws("", *[F.when(slot >= i, F.col(f"_lag{i}")) for i in range(fan - 1, 0, -1)])
        right = F.concat_ws("", *[F.when(slot + i < run, F.col(f"_lead{i}")) for i in range(1, fan)])
        # The row of a node's first leaf stands for the node, that of a run's first child hashes the parent.
        step = F.when(F.col("pos") % apart == 0, F.struct(left.alias("left"), right.alias("right")))
        parent = F.when(F.col("pos") % (apart * fan) == 0,
                        F.when(counts[level], digest(F.col(name), right)).otherwise(F.col(name)))
        hashed = near.select(*[c for c in hashed.columns if c != name], step.alias(f"_step{level}"),
                             parent.alias(f"_h{level + 1}"))
    upto = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = [F.when(counts[i], F.last(f"_step{i}", ignorenulls=True).over(upto)) for i in range(depth)]
    return hashed.select(*nodes.columns, "block", F.col(f"_h{depth}").alias("top"),
                         F.array_compact(F.array(*filled)).alias("steps"))


def tree(nodes: DataFrame, fan: int = FAN, depth: int = DEPTH) -> tuple[list[DataFrame], DataFrame]:
    """All climbs, lowest first, and ``label, hash`` of every group's root, written."""
    most = nodes.agg(F.max("nodes").alias("most")).first().most or 0
    levels = 1
    while fan ** levels < most:
        levels += 1
    climbs = []
    for below in range(0, levels, depth):
        climbs.append(climb(nodes, below, min(depth, levels - below), fan))
        nodes = staged(climbs[-1].filter(F.col("top").isNotNull()).select(
            "label", F.col("block").alias("pos"), "nodes", F.col("top").alias("hash")))
    return climbs, nodes.select("label", "hash")


def with_steps(climbs: list[DataFrame], above: DataFrame) -> DataFrame:
    """The nodes of the lowest climb with all ``steps`` up to the root of the whole and the columns of ``above``.

    ``above`` has ``label``, its ``steps`` above the group's root, and more.  Each climb meets the heads of its own
    blocks, so a large group is no hot key.
    """
    more = [c for c in above.columns if c not in ("label", "steps")]
    found = above.withColumn("pos", F.lit(0).cast("long"))
    for climbed in reversed(climbs):
        heads = found.select("label", F.col("pos").alias("block"), F.col("steps").alias("_upper"), *more)
        found = climbed.join(heads, ["label", "block"]).drop("block", "top").withColumn(
            "steps", F.concat("steps", "_upper")).drop("_upper")
        if climbed is not climbs[0]:
            found = staged(found.select("label", "pos", "steps", *more))
    return found


def proof(steps: Column) -> Column:
    """The siblings' hashes, level by level and left to right, as one text."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings on its way up lead to."""
    return F.aggregate(steps, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def build_manifest(rows: DataFrame, group: str, key: str, fields: Sequence[str] = FIELDS,
                   keep: dict[str, Column] | None = None, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """``key, leaf, steps, subroot, root`` for every row, and the columns ``keep``.

    A leaf is the hash of the row's ``fields``.  Per group, leaves stand in the order of ``key`` (NULL first; equal keys
    by leaf, and leaves that are equal too are alike).  Subroots in the order of the groups (NULL first, bytewise) are
    the leaves of the tree above.  ``steps`` leads from the leaf to the root: see ``proof`` and ``folded``.

    A NULL group is a group of its own, apart from the empty text.  Repeated rows are leaves of their own.  A group of
    one row has its leaf as subroot.  An empty table gives an empty result; other columns of ``rows`` are ignored.
    ``keep`` may not name ``label, pos, nodes, hash, block, top, steps, subroot, root, leaf`` or begin with ``_``.
    """
    keep = keep or {}
    named = [F.col(f"`{f}`") for f in fields]
    leaves = staged(rows.select(F.col(f"`{key}`").alias("_key"), group_label(F.col(f"`{group}`")).alias("label"),
                                leaf_hash(named).alias("hash"), *[c.alias(n) for n, c in keep.items()]))
    placed = numbered(leaves, [F.col("_key").asc_nulls_first(), F.col("hash")])
    climbs, subroots = tree(placed, fan, depth)
    inner = subroots.select(F.lit("").alias("label"), F.col("label").alias("_group"), "hash")
    tops, roots = tree(numbered(inner, [F.col("_group")]), fan, depth)
    whole = roots.select("label", F.col("hash").alias("root"), F.array().cast(
        "array<struct<left:string,right:string>>").alias("steps"))
    above = with_steps(tops, whole).select(
        F.col("_group").alias("label"), F.col("hash").alias("subroot"), "root", "steps")
    found = with_steps(climbs, staged(above))
    return found.select(F.col("_key").alias(key), F.col("hash").alias("leaf"), "steps", "subroot", "root", *keep)


def verify_documents(docs: DataFrame, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """The manifest of ``docs`` by language, folded again for every document after some of them were tampered with.

    Returns ``doc_id, leaf, steps, subroot, root, folded_root, verified``.  Tampered are those whose id as decimal text
    has a crc32 that 7 divides; tampering adds 1 to ``n_chars``, so where that is NULL, nothing changes.  A row without
    an id is not tampered with.  See ``build_manifest`` for ties, NULLs and empty tables.
    """
    struck = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = F.col("n_chars").cast("decimal(20,0)") + struck.cast("int")
    shown = leaf_hash([more if f == "n_chars" else F.col(f"`{f}`") for f in FIELDS])
    found = build_manifest(docs, "lang", "doc_id", keep={"shown": shown}, fan=fan, depth=depth)
    again = found.withColumn("folded_root", folded(F.col("shown"), F.col("steps"))).drop("shown")
    return again.withColumn("verified", F.col("folded_root") == F.col("root"))
