"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as registry
from tillworks.queries.oracle_sql import oracle_sql
from tillworks.queries.spark_queries import QUERIES
from check import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None


# Queries without files in between, so that their plan shows all of their work.
ONE_PLAN = ("silver_valid", "quality_metrics", "dim_product", "fact_sales_build", "dedupe_latest", "not_null_violations",
            "required_fields_filter", "sales_velocity", "repartition_by_transaction")


@pytest.mark.parametrize("name", ONE_PLAN)
def test_plans_stay_on_spark_operators(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables past the broadcast bound
    try:
        plan = registry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SinglePartition, REPARTITION"):
        assert unwanted not in plan


def test_entry(spark):
    assert len(registry.entry(spark).columns) == 10
    assert set(registry.oracle_sql()) <= set(registry.queries())
