"""Every registered query against its SQL in DuckDB, and the shape of its plan."""

from __future__ import annotations

import math
import os
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from pathquality.suite import all_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLES = all_queries()  # those of llm/ have tests of their own
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, bool) or str(type(value)).find("bool") >= 0:
        return bool(value)
    if isinstance(value, (int, float)) or hasattr(value, "dtype"):
        return f"{float(value):.10g}"
    return str(value)


def rows_of(df: pd.DataFrame):
    ordered = df[sorted(df.columns)]
    return sorted(
        ([plain(x) for x in row] for row in ordered.itertuples(index=False)), key=lambda r: str(r)
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "Python", "Pandas"):
        assert operator not in plan
    if name in ORACLES:
        want = duck.execute(ORACLES[name]).fetchdf()
        got = df.toPandas()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)
    else:
        assert df.count() > 0


def test_no_oracle_without_query():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[:2] == ["element_type", "element_id"] and df.count() > 0


def test_scan_reads_only_what_it_needs(spark):
    df = QUERIES["scan_filter_project"](spark, FOLDER)
    spark_side = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    plan = df._jdf.queryExecution().explainString(spark_side.fromString("formatted"))
    read = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "l_extendedprice" not in read and "l_partkey" not in read
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert "GreaterThanOrEqual(l_shipdate" in pushed
    assert "StringStartsWith(l_linestatus" in plan
