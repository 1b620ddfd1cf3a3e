"""Every named query against its SQL on DuckDB, and what its plan may not hold."""

from __future__ import annotations

import re

import duckdb
import pytest

import __spark_entry__ as driver
from checks import oracle
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries())
    assert set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    rows = QUERIES[name](spark, FOLDER)
    plan = plan_of(rows)
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert banned not in plan
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(rows.columns)
    expected = sorted((tuple(r[columns.index(c)] for c in sorted(columns)) for r in found.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in sorted(columns)) for r in rows.collect()), key=repr)
    assert got == expected
    assert got


def test_entry(spark):
    assert driver.entry(spark).columns == [
        "run_id", "business_unit", "nii_business_unit", "cost_centre", "cc_ratio", "fe_weight",
        "allocation_denominator", "nii_cost_centre",
    ]


def test_weight_filter_reaches_the_scan(spark):
    plan = plan_of(QUERIES["weighted_metric"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_quantity,5.0)" in plan
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string>" in plan


def test_dated_lookups_of_joined_lines(spark):
    """The lines move for their two large joins, once to be priced and once for their steps, and not for the
    curve; what is listed per step is broadcast only after it was measured."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
    try:
        rows = QUERIES["curve_asof"](spark, "/root/testdata/sf0.01")
        before = plan_of(rows)
        assert re.search(r"SortMergeJoin \[currency#\d+, _step#\d+\]", before)
        shuffles = re.findall(r"Exchange hashpartitioning\((l_\w+)#", before)
        assert sorted(shuffles) == ["l_orderkey"] * 2 + ["l_partkey"] * 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_allocation_reads_the_income_once_and_never_gathers_a_unit(spark):
    rows = QUERIES["nii_cost_centre_distinct"](spark, FOLDER)
    rows.collect()
    plan = plan_of(rows).split("== Initial Plan ==")[0]
    assert re.search(r"Exchange hashpartitioning\([^)]*nii_business_unit#\d+, \d+\)", plan)
    assert re.search(r"Exchange hashpartitioning\(business_unit#\d+, _salt#\d+L, \d+\)", plan)
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 2  # actuals and forecast, once each
