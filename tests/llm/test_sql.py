"""Queries that SQL can express, against their SQL at the smallest size."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tillflow.llm import queries
from tools.check_oracle import TABLES, digest


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF_SMALL}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    rows, want = [tuple(r) for r in df.collect()], cur.fetchall()
    assert sorted(df.columns) == sorted(cols) and len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(cols, want)[0]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_returns_its_contract_columns(spark, name):
    contract = {
        "op1": {"doc_id", "class_id"}, "op2": {"doc_id", "n_words", "base_failed", "kept"},
        "op3": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}, "op4": {"doc_id", "held_out", "lang_pred", "score"},
        "op5": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
        "op6": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
        "op7": {"doc_id", "n_lines", "n_dropped", "kept_sha256"}, "op8": {"page_id", "url", "text", "n_chars"},
        "op9": {"doc_id", "held_out", "score", "predicted"}, "op10": {"vec_id", "n_links", "component_id", "kept"},
        "op11": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"}, "op12": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
        "op13": {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"}}
    df = entry.queries()[name](spark, SF_SMALL)
    assert contract[name.split("_")[0]] <= set(df.columns)
    assert df.count() > 0 or name == "op11_phrases"  # in so few texts no phrase may occur 100 times
