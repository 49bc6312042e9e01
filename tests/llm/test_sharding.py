import zlib
from collections import Counter

from pyspark.sql import functions as F

from claimtide.llm import sharding


def jump(key, shards):
    """The published loop on unsigned 64-bit numbers."""
    key, b, j = key % 2 ** 64, -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % 2 ** 64
        j = int(float(b + 1) * (float(2 ** 31) / float((key >> 33) + 1)))
    return b


def test_jump_equals_the_loop(spark):
    keys = spark.range(-300, 300).select((F.col("id") * 30_744_573_456_182_586).alias("k"))
    for shards in (1, 2, 8, 9, 150):
        assert all(r.shard == jump(r.k, shards) for r in sharding.assign_shards(keys, "k", shards).collect())


def test_long_walks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_STEPS", 2)
    keys = spark.range(500).withColumnRenamed("id", "k")
    assert all(r.shard == jump(r.k, 40) for r in sharding.assign_shards(keys, "k", 40).collect())


def test_growing_moves_rows_only_into_the_new_shard(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "k")
    both = sharding.assign_shards(sharding.assign_shards(keys, "k", 10, "old"), "k", 11, "new").collect()
    moved = [r for r in both if r.old != r.new]
    assert all(r.new == 10 for r in moved) and 0.07 < len(moved) / len(both) < 0.11


def test_text_keys_and_clashing_names(clashing):
    rows = sharding.assign_shards(clashing, "text", 4, "shard")
    assert rows.columns.count("shard") == 1 and "Shard" not in rows.columns
    assert all(0 <= r.shard < 4 for r in rows.collect())


def test_ugly_documents(ugly, clashing, nothing):
    for docs in (ugly, clashing):
        rows = sharding.shard_documents(docs, 3).collect()
        source = docs.collect()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
            (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in source)
        for r in rows:
            assert (r.shard, r.grown_shard, r.law) == (jump(r.doc_id or 0, 3), jump(r.doc_id or 0, 4), "key")
        for shard in {r.shard for r in rows}:
            slots = sorted(r.slot for r in rows if r.shard == shard)
            assert slots == list(range(len(slots)))
    assert sharding.shard_documents(nothing, 3).count() == 0


def test_repeated_rows_are_counted_before_they_move(spark):
    docs = spark.range(9000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.shard_documents(docs, 8)
    assert sorted(r.slot for r in rows.collect()) == list(range(9000))


def test_no_python_in_the_plan(documents):
    plan = sharding.shard_documents(documents, 8)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
