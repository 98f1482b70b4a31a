"""Every registered query against its SQL counterpart, and what its plan must not contain."""

import os

import pytest

import __spark_entry__ as entry
from riskloom.plans.registry import REGISTRY
from riskloom.sources import star
from tests.compare import connect, differences

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

# pairwise joins, row-at-a-time Python, and collecting whole tables into a plan
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "LocalTableScan [iso3")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_its_sql(spark, connection, name):
    df = REGISTRY[name](spark, FOLDER)
    assert differences(df, connection, entry.oracle_sql()[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]


def test_every_query_of_the_reference_has_sql():
    assert set(REGISTRY) <= set(entry.oracle_sql())


def test_flagship_query(spark):
    assert entry.entry(spark).count() > 0


def test_scan_reads_only_needed_columns(spark):
    plan = REGISTRY["success_flags"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_returnflag:string>" in plan or (
        "ReadSchema: struct<l_suppkey:bigint,l_returnflag:string>" in plan
    )


def test_filter_reaches_the_scan(spark):
    df = star.loans(spark, FOLDER, "customer", "IBRD")
    assert "PushedFilters: [" in df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in df._jdf.queryExecution().executedPlan().toString()


# --- what the derived tables must satisfy whatever the data is -------------------------------------------------------


def test_master_quality(spark):
    from pyspark.sql import functions as F

    master = REGISTRY["country_master"](spark, FOLDER)
    assert master.groupBy("country", "year").count().filter("count > 1").isEmpty()
    assert master.filter(F.length("iso3") != 3).isEmpty()
    assert master.filter("year NOT BETWEEN 1970 AND 2030").isEmpty()
    for column in ("environmental_score", "social_score", "governance_score", "esg_score", "esg_risk_score", "success_rate"):
        assert master.filter(f"{column} NOT BETWEEN 0 AND 100").isEmpty()
    assert master.filter("abs(esg_score + esg_risk_score - 100) > 0.2").isEmpty()
    assert master.filter("lending_amount <> commitment_amount OR lending_amount < 0").isEmpty()


def test_bronze_quality(spark):
    from pyspark.sql import functions as F

    esg = star.esg(spark, FOLDER)
    assert esg.select("pillar").distinct().count() >= 2
    assert esg.filter("pillar IS NULL OR value IS NULL").isEmpty()
    loans = star.loans(spark, FOLDER)
    assert loans.count() == loans.select("loan_id").distinct().count()
    share = loans.agg(F.avg(F.col("fiscal_year").isNull().cast("int"))).first()[0]
    assert share < 0.05
