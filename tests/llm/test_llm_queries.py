"""The registered queries over the smallest tables."""

import os

import pytest

from dimflow.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

#: Columns that each query has at least, and the table it answers for row by row.
CONTRACT = {
    "op1_html_blocks": ("page_id url text n_chars", "pages"),
    "op2_url_filter": ("page_id host path rule verdict", "pages"),
    "op3_mixing": ("doc_id source block slot", "documents"),
    "op4_surrogates": ("doc_id text n_entities", "documents"),
    "op5_chat_format": ("conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars", None),
    "op6_suffix_dedup": ("doc_id n_bytes n_removed n_spans kept_sha256", "documents"),
    "op7_decontamination": ("doc_id item_id distance", None),
    "op8_ngram_join": ("doc_id n_shingles component_id", "documents"),
    "op9_token_counts": ("doc_id n_tokens", "documents"),
    "op10_quality_rules": ("doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "documents"),
    "op11_periodic_runs": ("doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256", "documents"),
    "op12_prefix_trie": ("conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256", None),
    "op13_token_files": ("doc_id start n_tokens ids_crc32", "documents"),
}


def test_one_query_for_each_operator():
    assert set(QUERIES) == set(CONTRACT)


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_query(spark, name):
    columns, table = CONTRACT[name]
    df = QUERIES[name](spark, FOLDER)
    assert set(columns.split()) <= set(df.columns)
    n = df.count()
    assert n == (spark.read.parquet(f"{FOLDER}/{table}.parquet").count() if table else n) and n > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_gives_the_same_rows(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = con.execute(SQL[name])
    names = [x[0] for x in want.description]
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in df.select(*names).collect()))) == sorted(map(repr, want.fetchall()))
