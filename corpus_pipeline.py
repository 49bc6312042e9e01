"""A training corpus from raw documents: language, toxicity, near-duplicates, mix, batches.

Each stage takes (spark, docs, sf_dir) and reads all that the stage before it kept; ``run`` writes every result as a
Parquet table in the shared folder and reads it back as the next stage's documents.  All stages but the last return
the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtide.llm import language, mixing, packing, simhash, toxicity
from claimtide.llm.common import fold, free_name, staged

# A text whose pieces have less than this value on average looks like none of the learned languages.
LEAST_LANGUAGE = 0.2

# The rows can't be stated in SQL: three stages apply models that are fitted here, and one draws blocks at random.
ORACLE_SQL = None


def _documents(df: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """Rows of ``df`` with the columns of ``docs``; ``text`` is the column that carried the text past a scorer."""
    return df.select(*[F.col(f"`{text}`").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that resemble no learned language, however long they are."""
    text, score = (free_name(docs, n) for n in ("text_kept", "lang_value"))
    model = language.fit_on(docs.filter(fold("doc_id", 4) != 2))
    judged = language.with_resemblance(docs.select("*", F.col("text").alias(text)), model, score)
    return _documents(judged.filter(F.col(score) >= LEAST_LANGUAGE), docs, text)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, fitted on the labels of those that came in, marks as toxic."""
    text, score, toxic = (free_name(docs, n) for n in ("text_kept", "toxic_score", "toxic_found"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold("doc_id", 5) != 0)
    model = toxicity.fit_on(docs, labels)
    judged = toxicity.score_texts(docs.select("*", F.col("text").alias(text)), model, score, toxic)
    return _documents(judged.filter(F.col(toxic) == 0), docs, text)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents of each source up to its target, some more than once, in the order of the mix."""
    return mixing.mix_documents(docs, names=(free_name(docs, "mix_shard"), free_name(docs, "mix_order"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and place of every document of the mix."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for all documents of a data folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
