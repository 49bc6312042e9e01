"""Every registered query of the subpackage: columns, all rows, SQL where there is some."""

import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from claimtide.llm import queries
from compare import compare


SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
            "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op2": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op4": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op5": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int",
            "slot": "bigint", "grown_shard": "int"},
    "op8": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op9": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op10": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string",
             "refers_to": "bigint"},
    "op11": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string",
             "folded_root": "string", "verified": "boolean"},
    "op12": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint",
             "n": "bigint", "score": "bigint"},
    "op13": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
}


def test_one_query_per_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(entry.oracle_sql()) and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns(spark, name):
    types = dict(queries.QUERIES[name](spark, SF).dtypes)
    wanted = COLUMNS.get(name.split("_")[0], {})
    assert {c: types.get(c) for c in wanted} == wanted


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql(spark, con, name):
    assert compare(queries.QUERIES[name](spark, SF), con, queries.ORACLE[name]) == []
