"""What the queries over sessions move: each line twice at most, and once for all readers."""

from __future__ import annotations

import os
import re

import pytest

from pathquality.operators.path import PATH_COLUMNS
from pathquality.plans.rollup import QUALITY_KEYS, element_1m, quality_1m
from pathquality.suite import all_queries, service
from pathquality.suite import views as v

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = all_queries().queries
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_sides(spark):
    """Nothing is small enough for Catalyst to broadcast by itself, as with large tables."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_lines_move_by_part_and_by_order_only(spark, no_small_sides):
    rows = v.sessions(spark, FOLDER).select("branch_id", "provider", "app", "response_ms")
    moved = re.findall(r"hashpartitioning\((\w+)#", plan_of(rows))
    assert sorted(k for k in moved if not k.endswith("regionkey")) == [
        "c_custkey", "l_orderkey", "l_partkey", "o_custkey", "o_orderkey", "p_partkey"]


def test_the_orders_are_merged_at_every_size(spark):
    assert "SortMergeJoin [l_orderkey" in plan_of(v.sessions(spark, FOLDER))


@pytest.mark.parametrize("name", [
    "sla_circuit_evidence", "sla_scorecard", "sla_provider_timeline", "sla_branch_minutes",
    "sla_scorecard_rollup", "localise_rollup", "localise_top1", "localise", "branch_ranking",
    "branch_ranking_rollup", "quantile_exact", "app_p95", "alert_card_slow", "p95_by_app_minute",
    "p95_by_app_minute_rollup", "rollup_element_1m"])
def test_sessions_are_joined_once(spark, name, monkeypatch):
    joined = []
    monkeypatch.setattr(v, "sessions", lambda *a, f=v.sessions: joined.append(a) or f(*a))
    assert "lineitem" not in plan_of(QUERIES[name](spark, FOLDER))
    assert len(joined) == 1


@pytest.mark.parametrize("name", [
    "approx_distinct_rollup", "quantile_rollup", "p95_by_app_minute_rollup",
    "branch_ranking_rollup", "sla_scorecard_rollup"])
def test_rollups_have_the_grain_that_is_read(spark, name, monkeypatch):
    grains = []

    def made(rows, keys=QUALITY_KEYS):
        grains.append(keys)
        return quality_1m(rows, keys)

    monkeypatch.setattr(service, "quality_1m", made)
    QUERIES[name](spark, FOLDER)
    assert grains and all("circuit_id" not in keys for keys in grains)


def test_estimates_are_broadcast_to_the_values(spark, no_small_sides):
    rows = spark.range(100).selectExpr("id % 2 AS k", "id AS x")
    found = spark.createDataFrame([(0, 94.0), (1, 10.0)], "k bigint, p double")
    near = service.near_rank(rows, found, ["k"], "x", "p", 0.95, "near")
    assert "BroadcastHashJoin" in plan_of(near)
    assert sorted(map(tuple, near.collect())) == [(0, True), (1, False)]


def test_a_rollup_of_few_elements_is_part_of_the_whole(spark):
    rows = v.sessions(spark, FOLDER)
    only = spark.createDataFrame([("app", "Brand#7"), ("switch", "none")], "element_type string, element_id string")
    columns = ("minute", "element_type", "element_id", "sessions", "degraded", "degraded_apps")
    few = element_1m(rows, PATH_COLUMNS, only=only).select(*columns).collect()
    whole = element_1m(rows).filter("element_type = 'app' AND element_id = 'Brand#7'").select(*columns)
    assert few and sorted(map(str, few)) == sorted(map(str, whole.collect()))
