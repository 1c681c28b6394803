"""Every registered query against its SQL twin on the smallest tables, and the shape of some plans."""

import re
from pathlib import Path

import pytest

from checks.compare import compare, oracle_connection
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_its_twin(spark, con, name):
    ok, message = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF_DIR)
    assert ok, message


def test_every_query_has_a_twin():
    assert sorted(QUERIES) == sorted(ORACLE)


@pytest.mark.parametrize("name", ["product_yoy", "mom", "clean_rows", "fact_resolved", "orphans"])
def test_no_window_over_the_whole_data(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan or "Window [" not in plan


@pytest.mark.parametrize("name,most", [("quality_log", 3), ("profile_quality_log", 1), ("sales_view", 1), ("clean_rows", 1), ("channel_analysis", 1)])
def test_line_items_are_read_so_often_at_most(spark, name, most):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"FileScan parquet [^\n]*lineitem", plan)) <= most


@pytest.mark.parametrize("name", ["orphans", "new_dim_members", "dense_ranks", "fact_insert_new", "ytd", "clean_rows_strict"])
def test_what_is_read_once_is_written_first(spark, name):
    """After the one pass, the rest of the query reads what that pass wrote."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"FileScan parquet [^\n]*lineitem", plan)) <= 1


def test_versions_of_a_customer_count_together_or_alone(spark):
    """The two rankings differ, so each proves its own way of counting."""
    every, current = (QUERIES[f"top_customers_{which}"](spark, SF_DIR).collect() for which in ("all_versions", "current_version"))
    assert sorted(map(tuple, every)) != sorted(map(tuple, current))
    assert max(r["monto_total"] for r in every) >= max(r["monto_total"] for r in current)
    assert sorted(map(tuple, every)) == sorted(map(tuple, QUERIES["top_customers"](spark, SF_DIR).collect()))
