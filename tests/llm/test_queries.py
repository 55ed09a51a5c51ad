"""The registered queries against their SQL, on the smallest test tables."""

import os

import duckdb
import pytest

from check_oracle import TABLES, compare
from rolelake.llm.queries import LLM_ORACLE, LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    verdict, _ = compare(spark, connection, SF_DIR, name)
    assert verdict.startswith("ok"), verdict


def test_every_sql_has_a_query():
    assert set(LLM_ORACLE) <= set(LLM_QUERIES)
