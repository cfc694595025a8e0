import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@needs_data
def test_entry(spark):
    row = entry.entry(spark).first()
    assert row["total_docs_seen"] == row["kept_docs"] + row["rejected_docs"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
def test_some_queries_against_sql(spark):
    names = ["clean_for_model", "text_metrics", "corpus_summary", "bpe_merges", "encode", "token_windows"]
    results = compare(spark, SF, names)
    assert all(r.startswith("ok") for r in results.values()), results
