"""Every registered query against its DuckDB oracle (sf0.001, whole tables).

The driver repeats this at sf0.01; ``python tests/oracle_check.py`` runs
the same comparison there by hand.
"""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare

QUERIES = entry.queries()
SQL = entry.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["item_type", "total_sales", "count"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    res = compare(spark, SF_SMALL, name, QUERIES[name], SQL.get(name), duck_small)
    assert res["status"] in ("ok", "rows-only"), res
