"""Registered queries: names, columns, and the SQL of those that have one."""

import os

import pytest

import __spark_entry__ as driver
import compare
from punctua.llm.queries import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")

COLUMNS = {
    "op2_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op3_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op4_near_duplicates": ["doc_id", "n_shingles", "component_id", "kept"],
    "op5_quality": ["doc_id", "log_weight", "key", "kept", "sampled", "filter_weight"],
    "op6_token_codes": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op7_near_vectors": ["vec_id", "n_links", "component_id", "kept"],
    "op9_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                           "n_near"],
    "op10_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op13_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"],
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    frame = driver.queries()[name](spark, FOLDER)
    assert compare.differences(frame, compare.connect(FOLDER), SQL[name]) == []


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_rows_and_columns(spark, name):
    frame = driver.queries()[name](spark, FOLDER)
    table = "embeddings" if name.startswith("op7") else "documents"
    assert frame.columns == COLUMNS[name]
    assert frame.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_all_are_registered():
    assert set(QUERIES) == set(SQL) | set(COLUMNS) and len(QUERIES) == 13
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
