"""Registered queries against their DuckDB oracles on the smallest scale."""

import math
import os

import duckdb
import pytest

from conftest import SF001

import __spark_entry__ as entry_mod
from quarry.sources.tables import TABLES

FAST = ["corpus_count", "doc_catalog", "term_catalog", "postings", "boolean_search", "vb_postings", "gamma_postings",
        "index_size", "field_tf", "bm25f", "min_window", "rank_window", "ndcg_per_query", "features10", "pair_hinge",
        "signal_file_scores", "ranked_file", "search_stream", "query_file_search"]
NAMES = sorted(entry_mod.oracle_sql()) if os.environ.get("QUARRY_FULL") else FAST


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["query_id", "ndcg"]
    assert all(0 <= r["ndcg"] <= 1 + 1e-12 for r in rows)


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF001)
    rel = con.sql(entry_mod.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, df.collect()) == _rows(rel.columns, rel.fetchall())
