"""Every registered query against its SQL in DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql
from catalog.queries import QUERIES
from verify_queries import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, con, name):
    assert name in oracle_sql()
    verdict = compare(spark, con, sf_dir, name)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    lines = entry(spark)
    assert lines.columns == ["server_id", "log_name", "log_pos", "row_ordinal", "line"]
    assert lines.count() > 0
