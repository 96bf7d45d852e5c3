"""Registered corpus queries agree with their SQL, or have their contract's columns and one row per row."""

import os

import pytest

from fathomframe.llm import queries
from tests.oracle import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
COLUMNS = {
    "op2_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op3_suffix_array_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op6_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op9_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op10_minhash_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_rows_and_columns(spark, name):
    out = queries.QUERIES[name](spark, SF)
    assert set(COLUMNS[name]) <= set(out.columns)
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
