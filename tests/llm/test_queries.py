"""Queries that SQL can express, in another engine; all others run and return what their contract names."""

import duckdb
import pytest

from tests.conftest import SMALL
from tests.test_queries import table
from txnmart.llm.duckdb_sql import ORACLE
from txnmart.llm.queries import QUERIES

COLUMNS = {
    "op1_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op2_personal_data": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op3_language_model": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op4_nearest": "query_id rank vec_id score",
    "op5_simhash": "doc_id fingerprint component_id",
    "op6_best_fit": "doc_id source piece start length bin offset",
    "op7_url_filter": "page_id host path rule verdict",
    "op8_toxicity": "doc_id held_out score predicted",
    "op9_html_text": "page_id url text n_chars",
    "op10_mix_sources": "doc_id size source_size target taken",
    "op11_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op12_byte_pairs": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op13_lexical_search": "item_id rank doc_id score",
}


def test_one_query_per_operator():
    assert set(QUERIES) == set(COLUMNS) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, name):
    df = QUERIES[name](spark, str(SMALL))
    assert set(COLUMNS[name].split()) <= set(df.columns)
    assert df.limit(1).collect()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equivalent(spark, name):
    con = duckdb.connect()
    for view in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SMALL}/{view}.parquet'")
    df = QUERIES[name](spark, str(SMALL))
    result = con.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, df.collect()) == table(columns, result.fetchall())
