"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import duckdb_rows, spark_rows
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLE

FOLDER = f"/root/testdata/{os.environ.get('ORACLE_SF', 'sf0.001')}"
WITH_SQL = sorted(ORACLE)


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(ORACLE) == {"random_forest", "knn_recall", "knn_text_recall", "score_stream"}


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_sql(spark, name):
    got = spark_rows(queries()[name](spark, FOLDER))
    want = duckdb_rows(FOLDER, oracle_sql()[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
