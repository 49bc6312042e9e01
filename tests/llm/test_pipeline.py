import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimtide.llm import language, mixing, packing, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "toxicity", "near_duplicates", "mix", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.toxic}
    labelled = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.staged(stage(spark, before, SF))
        if name != "packing":
            assert after.columns == docs.columns
        kept[name] = Counter(r.doc_id for r in after.select("doc_id").collect())
        frames = before
        before = after
        if name == "near_duplicates":
            groups = {r.component_id for r in simhash.group_near_duplicates(frames).collect()}
            assert set(kept[name]) == groups and set(kept[name].values()) == {1}
        if name == "mix":
            plan = mixing.plan_mix(frames).collect()
            assert kept[name] == Counter({r.doc_id: len(r.shards) for r in plan if r.shards})
        if name == "packing":
            assert kept[name] == kept["mix"] and set(after.columns) == set(packing.pack_documents(frames).columns)
    every = {r.doc_id for r in docs.select("doc_id").collect()}
    assert set(kept["language"]) == every
    gone = every - set(kept["toxicity"])
    assert len(gone & toxic) >= 0.5 * len(toxic) and not gone & (labelled - toxic)


def test_odd_documents(spark, ugly, clashing, nothing):
    for docs in (ugly, clashing, nothing):
        before = docs
        for name, stage in corpus_pipeline.STAGES:
            before = corpus_pipeline.staged(stage(spark, before, SF))
            if name != "packing":
                assert before.columns == docs.columns
        assert before.count() >= 0
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, ugly, SF).collect()}
    assert not kept & {3, 4, 5, 6} and {1, 2, 9} <= kept


def test_unknown_script_is_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    strange = spark.createDataFrame([(10 ** 6, "日本語のテキストです。漢字と仮名。" * 5, None)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs.unionByName(strange), SF).collect()}
    assert 10 ** 6 not in kept and len(kept) == docs.count()


@pytest.mark.parametrize("share", [0, 0.02])
def test_very_long_clean_texts_stay(spark, share):
    """Clean texts of several MB, also with random ids among the words, stay; as long a text in no language goes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rng, signs = random.Random(5), "abcdefghijklmnopqrstuvwxyz0123456789"
    mixed = []
    for lang in ("de", "en", "es", "fr"):
        words = " ".join(r.text for r in docs.filter(F.col("lang") == lang).orderBy("doc_id").collect() if r.text).split()
        words = words * (3_000_000 // len(" ".join(words)) + 1)
        mixed.append(" ".join(w + " " + "".join(rng.choices(signs, k=10)) if rng.random() < share else w for w in words))
    mixed.append("".join(rng.choices(signs, k=3_000_000)))
    added = spark.createDataFrame([(10 ** 6 + i, t, None) for i, t in enumerate(mixed)], docs.schema)
    kept = corpus_pipeline.identify_language(spark, docs.unionByName(added), SF).select("doc_id").collect()
    assert {r.doc_id for r in kept if r.doc_id >= 10 ** 6} == {10 ** 6 + i for i in range(4)}
    assert len(kept) == docs.count() + 4


def test_run_is_the_chain(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "length", "bucket", "bound", "batch", "place", "padding"] and rows.count() > 100
    assert language and toxicity
