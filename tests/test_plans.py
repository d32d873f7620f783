"""Plan checks: SQL-checked queries stay in the JVM (no Python UDF), no
query plans a cartesian product or nested-loop join, and scans read only the
columns they need with filters pushed down."""

from __future__ import annotations

import pytest

from kiln_paths import SF_SMALL
from kiln.plans import catalog

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")
# model-shaped queries whose plans are built by Spark ML or hold a pandas UDF by design
PYTHON_OK = {"pearson_p", "stem_vocabulary", "knn_classify", "knn_distance_vote", "knn_neighbours"}
SKIP_PLAN = {"cv_scores", "grid_search", "grid_search_trees", "intake_latest_ratings", "compare_models", "als_grid", "kmeans_elbow", "intake_item_stats",
             "silhouette", "feature_importance"}


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


# Spark ML multiplies blocks of factors itself; the refit scores one constant user (a one-row side)
FACTOR_PRODUCT = {"recommend_many_users", "als_refit"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SKIP_PLAN - FACTOR_PRODUCT))
def test_no_cartesian_or_nested_loop(spark, name):
    p = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", sorted(set(catalog.ORACLE) - PYTHON_OK - SKIP_PLAN))
def test_oracle_queries_have_no_python(spark, name):
    p = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    assert not any(n in p for n in PY_NODES), name


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = catalog.QUERIES["filter_between"](spark, SF_SMALL)
    p = _plan(df)
    pushed = p.split("PushedFilters:")[1].split("]")[0]
    assert "EqualTo(event_type,click)" in pushed
    assert "props" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_flagship_plan_reads_two_columns(spark):
    p = _plan(catalog.QUERIES["resolution_share"](spark, SF_SMALL))
    schema = p.split("ReadSchema:")[1].split("\n")[0]
    assert "event_type" in schema and "props" not in schema and "value" not in schema


def test_top_k_is_not_a_global_sort(spark):
    p = _plan(catalog.QUERIES["top10_categories"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


@pytest.mark.parametrize("name", ["word_count", "tfidf_long", "count_idf_long"])
def test_texts_are_not_tokenised_in_the_scan(spark, name):
    """``explode`` would let Catalyst infer ``size(tokens) > 0`` and push it
    into the scan, tokenising every text twice; the term operators use
    ``explode_outer`` + a NULL filter instead."""
    p = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    for line in p.splitlines():
        if "FileScan parquet" in line or line.lstrip().startswith("+- Filter") and "split(" in line:
            assert "size(" not in line, line
