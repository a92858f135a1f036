"""Every registered query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import os

import pytest

from granary.plans import all_queries
from tests.compare import differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(all_queries.ORACLE_SQL))
def test_rows_equal_those_of_sql(spark, name):
    assert not differences(all_queries.QUERIES[name](spark, SF), all_queries.ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(all_queries.QUERIES) - set(all_queries.ORACLE_SQL)))
def test_without_sql_gives_rows(spark, name):
    df = all_queries.QUERIES[name](spark, SF)
    assert len(df.columns) == len(set(df.columns))
    rows, again = (sorted(map(repr, all_queries.QUERIES[name](spark, SF).collect())) for _ in range(2))
    # the benchmark's few items need not share a 12-mer
    assert rows == again and (rows or name == "local_alignment_of_items")
    assert "nan" not in repr(rows).lower()


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
