"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as e
from check_queries import compare, connect
from pulsemill.registered.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    rows = e.queries()[name](spark, SF_DIR).toPandas()
    assert compare(rows, sql.sql(e.oracle_sql()[name]).df()) == "ok"


def test_entry(spark):
    assert e.entry(spark).columns == ["product_type", "serialNumber", "metric", "t", "value"]


def test_no_python_and_no_cartesian_product(spark, plan_of):
    for name in ("q_panel_window", "q_saved_q1", "q_series_summary", "q_melt", "q_assemble_points", "q_resample_fill", "q_panel_chunks"):
        plan = plan_of(e.queries()[name](spark, SF_DIR))
        for node in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
            assert node not in plan, (name, node)
