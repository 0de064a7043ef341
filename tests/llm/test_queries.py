"""Registered queries against their SQL, and the registry itself."""

import re

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from shelfmill.llm.registry import LLM_QUERIES, LLM_SQL

SMALL = "/root/testdata/sf0.001"


def test_registry():
    numbers = sorted(int(m[1]) for m in map(re.compile(r"op(\d+)_").match, LLM_QUERIES) if m)
    assert numbers == list(range(1, 14))
    assert set(LLM_QUERIES) <= set(entry_point.queries())
    assert LLM_QUERIES["pipeline"] is corpus_pipeline.run
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "decontamination", "pii", "byte_bpe"]


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_agrees_with_sql(spark, name):
    tables = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        tables.sql(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    df = LLM_QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    twin = tables.sql(f"select {', '.join(columns)} from ({LLM_SQL[name]})")
    assert sorted(map(str, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(str, twin.fetchall()))
