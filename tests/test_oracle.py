"""Every SQL-expressible query equals its DuckDB oracle on sf0.001, and every
other registered query runs and returns rows with a stable schema."""

from __future__ import annotations

import pytest

from kiln_paths import SF_SMALL
from kiln.plans import catalog
from tools.oracle_check import rows_of, type_diff

ORACLE_NAMES = sorted(catalog.ORACLE)
ROW_NAMES = sorted(set(catalog.QUERIES) - set(catalog.ORACLE))


@pytest.mark.parametrize("name", ORACLE_NAMES)
def test_matches_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    srows = df.collect()
    cur = duck.execute(catalog.ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert type_diff(df.schema, duck.sql(catalog.ORACLE[name])) == {}
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)


# the "more than 50 ratings" filter is sized for sf0.01 (FIXTURES.md); at
# sf0.001 no item reaches it, so an empty result is the right answer there
MAY_BE_EMPTY_AT_SF0001 = {"recommend_top_n"}


@pytest.mark.parametrize("name", ROW_NAMES)
def test_model_queries_run(spark, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    schema = df.schema
    n = df.count()
    assert n > 0 or name in MAY_BE_EMPTY_AT_SF0001
    assert df.schema == schema


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert {r["category"] for r in rows} >= {"signup"}
    # the zero-fill branch: signup rows are never NONE
    assert [r["n_none"] for r in rows if r["category"] == "signup"] == [0]
    assert set(e.queries()) >= set(catalog.QUERIES)
    assert set(e.oracle_sql()) <= set(e.queries())
