"""Sharding by jump consistent hashing, with built-in functions only.

The jump (Lamping and Veach) walks a linear congruential generator seeded by the key: the walk visits the shard counts
at which the key would have moved and stops at the last one below the wanted count.  No ring or table is kept, and
when a shard is appended the only rows that move are those that move into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import free_name, repeat_rows, replace_columns, running_total

# Multiplier of the generator and the unsigned 64-bit range.
MULTIPLIER = "2862933555777941757"
RANGE = "18446744073709551616"
FIRST_STEPS = 64


def key_state(key: Column, kind: str) -> Column:
    """The key as an unsigned 64-bit number: whole numbers are themselves, other types by hash, NULL is 0."""
    number = key.cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(key)
    wide = F.coalesce(number, F.lit(0).cast("long")).cast("decimal(20,0)")
    return F.when(wide < 0, wide + F.lit(RANGE).cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")


def next_state(state: Column) -> Column:
    """One step of the generator modulo 2^64; the product has at most 38 digits, so decimals hold it exactly."""
    product = state.cast("decimal(20,0)") * F.lit(MULTIPLIER).cast("decimal(19,0)")
    return ((product + F.lit(1).cast("decimal(1,0)")) % F.lit(RANGE).cast("decimal(20,0)")).cast("decimal(20,0)")


def _walk(state: Column, shards: int, steps: int) -> Column:
    """State, last shard and next jump after at most ``steps`` jumps."""
    start = F.struct(state.alias("s"), F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def jump(acc: Column, _: Column) -> Column:
        s = next_state(acc["s"])
        top = F.floor(s / F.lit(2 ** 33).cast("decimal(20,0)")).cast("long") + 1
        j = F.floor((acc["j"] + 1).cast("double") * (F.lit(float(2 ** 31)) / top.cast("double"))).cast("long")
        return F.when(acc["j"] < shards, F.struct(s.alias("s"), acc["j"].alias("b"), j.alias("j"))).otherwise(acc)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, jump)


def jump_shard(key: Column, kind: str, shards: int) -> Column:
    """Shard 0 to ``shards`` - 1 of a key.

    A walk to n shards has at most n jumps and log(n) on average, so the long walk is only taken by a key whose first
    64 jumps have not reached the end.
    """
    state = key_state(key, kind)
    short = _walk(state, shards, min(shards, FIRST_STEPS))
    if shards <= FIRST_STEPS:
        return short["b"].cast("int")
    return F.when(short["j"] >= shards, short["b"]).otherwise(_walk(state, shards, shards)["b"]).cast("int")


def assign_shards(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """Every row with its shard, without any exchange.  An input column called ``name`` is replaced."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    return replace_columns(df, **{name: jump_shard(F.col(f"`{key}`"), dict(df.dtypes)[key], shards)})


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard and place in the shard of every document, and its shard with one more.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; size is the UTF-8 length plus 1 (NULL: 1)
    and the crc of a NULL text is 0.  Law ``key``: the key and the number of shards decide, so equal keys share a
    shard and equal texts under other keys need not.  A NULL key counts as 0.  Rows equal in key and text are
    counted before anything is exchanged and take adjacent slots, so a repeated row is no hot group.  Slots are
    gapless from 0 in each shard and follow the generator's next state, which spreads them.  An empty table gives
    an empty result; other columns are ignored.
    """
    kind = dict(docs.dtypes)[key]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"))
    copies, order, copy = (free_name(rows, n) for n in ("_copies", "_order", "_copy"))
    distinct = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias(copies))
    state = key_state(F.col("doc_id"), kind)
    placed = distinct.select("*", jump_shard(F.col("doc_id"), kind, shards).alias("shard"),
                             jump_shard(F.col("doc_id"), kind, shards + 1).alias("grown_shard"),
                             F.lpad(F.lower(F.hex(_signed(next_state(state)))), 16, "0").alias(order))
    numbered = running_total(placed, ["shard"], order, copies, "slot", ("doc_id", "size", "text_crc32"))
    return (repeat_rows(numbered, copies, copy)
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("slot") + F.col(copy)).alias("slot"), "grown_shard"))


def _signed(state: Column) -> Column:
    """An unsigned 64-bit number as the long with the same bits."""
    half, whole = F.lit("9223372036854775808").cast("decimal(20,0)"), F.lit(RANGE).cast("decimal(20,0)")
    return F.when(state >= half, state - whole).otherwise(state).cast("decimal(20,0)").cast("long")
