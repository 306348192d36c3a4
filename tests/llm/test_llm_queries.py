import os
import re

import pytest

import __spark_entry__ as entry_point
from compare import TABLES, connect, differences
from quarrylake.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

COLUMNS = {
    1: "page_id payload_bytes payload_digest record_type refers_to",
    3: "doc_id piece start length ids_crc32 sequence_id offset",
    4: "query_id rank vec_id score",
    5: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    6: "doc_id n_words n_base first_word last_word base_labels labels score",
    7: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    8: "doc_id held_out score predicted",
    9: "doc_id n_shingles component_id kept",
    10: "doc_id n_words n_removed kept_sha256",
    11: "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    12: "doc_id n_shingles component_id",
    13: "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


def number(name):
    return int(re.match(r"op(\d+)_", name)[1])


def test_every_operator_is_registered_once():
    assert sorted(map(number, QUERIES)) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    assert differences(spark, connect(SF_DIR), QUERIES[name], SQL[name], SF_DIR) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, tmp_path, name):
    for table in TABLES:
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    got = QUERIES[name](spark, str(tmp_path))
    assert got.columns[:len(COLUMNS.get(number(name), "").split())] == COLUMNS.get(number(name), "").split()
    assert got.collect() == []
