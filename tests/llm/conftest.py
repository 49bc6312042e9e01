import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
LONG = "lorem ipsum dolor " * 20_000

# Ids, texts, languages and sources that are missing, empty, repeated, very long or equal.
UGLY = [
    (1, "The cat sat on the mat and looked at the dog.", "en", "a", 45),
    (2, "The cat sat on the mat and looked at the dog.", "en", "b", 45),
    (2, "The cat sat on the mat and looked at the dog.", "en", "b", 45),
    (2, "another text under the same id", "en", None, 30),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \t\n\r\v\f ", "fr", "", 7),
    (6, "12345 !!! ...", None, "a", 13),
    (7, LONG, "la", "c", len(LONG)),
    (8, "x" * 100_000, "la", "c", 100_000),
    (None, "no id here", "en", "a", 10),
    (None, "no id here either", "en", None, 17),
    (None, None, "en", "a", None),
    (9, "Éléphant à la plage, où l'été brûle", "fr", "é", 35),
    (10, "日本語のテキスト 漢字", "ja", "日", 11),
    (-11, "word", "en", "a", 4),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("fingerprint", "score", "Shard", "size", "length", "held_out", "lang_pred", "predicted", "pos", "row_key",
            "component_id", "taken", "_text", "mix_order", "slot", "bucket", "key", "_key", "toxic", "word", "count")


@pytest.fixture(scope="session")
def ugly(spark):
    return spark.createDataFrame(UGLY, SCHEMA)


@pytest.fixture(scope="session")
def clashing(ugly):
    from pyspark.sql import functions as F
    return ugly.select("*", *[F.lit("mine").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection
