from __future__ import annotations

import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathquality.operators import quantile as quantile_module
from pathquality.operators.asof import asof_join, asof_join_within, range_join_nearest
from pathquality.operators.keyed import (
    bounded_distinct,
    earliest_per_key,
    heaviest_item,
    latest_per_key,
)
from pathquality.operators.lookup import longest_prefix_match, lookup, prefix_table
from pathquality.operators.path import explode_path
from pathquality.operators.quantile import exact_quantile
from pathquality.operators.sizing import fits_broadcast
from pathquality.operators.slices import in_slices, oldest_needed

from .network import T0, at


def _two_sides(spark, seed, hot):
    """Random rows; with `hot`, one key holds a third of each side."""
    rng = random.Random(seed)

    def rows(n):
        key = lambda i: "hot" if hot and i % 3 == 0 else f"k{rng.randrange(6)}"
        return [(i, key(i), at(rng.randrange(0, 60_000) / 1000)) for i in range(n)]

    left, right = rows(150), rows(150)
    right += [(1000 + i, k, t) for i, k, t in left[:10]]  # equal times
    return left, right


def _nearest(left, right, tolerance_ms, skew_ms):
    out = {}
    for i, k, t in left:
        later = sorted((rt, j) for j, rk, rt in right if rk == k and rt >= t - timedelta(milliseconds=skew_ms))
        out[i] = None
        if later:
            whole_ms = lambda x: (x - T0) // timedelta(milliseconds=1)
            if tolerance_ms is None or abs(whole_ms(later[0][0]) - whole_ms(t)) <= tolerance_ms:
                out[i] = later[0][0]
    return out


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize(("tolerance_ms", "skew_ms"), [(5000, 50), (300, 300), (10, 900), (0, 0)])
def test_asof_within_matches_brute_force(spark, hot, tolerance_ms, skew_ms):
    left, right = _two_sides(spark, tolerance_ms + skew_ms, hot)
    l = spark.createDataFrame(left, "id int, k string, t timestamp")
    r = spark.createDataFrame(right, "rid int, k string, rt timestamp")
    want = _nearest(left, right, tolerance_ms, skew_ms)
    got = asof_join_within(l, r, ["k"], "t", "rt", tolerance_ms, skew_ms)
    assert {x["id"]: x["r_rt"] for x in got.collect()} == want
    check = range_join_nearest(l, r, ["k"], ["id"], "t", "rt", tolerance_ms, skew_ms)
    assert {x["id"]: x["r_rt"] for x in check.collect()} == want


@pytest.mark.parametrize("block_s", [1, 7, 3600])
def test_unbounded_asof_matches_brute_force(spark, block_s):
    left, right = _two_sides(spark, 7, True)
    right = [r for r in right if (r[2] - T0).total_seconds() > 40 or r[1] == "hot"]
    l = spark.createDataFrame([*left, (999, None, T0)], "id int, k string, t timestamp")
    r = spark.createDataFrame([*right, (998, None, at(1))], "rid int, k string, rt timestamp")
    got = asof_join(l, r, ["k"], "t", "rt", block_s=block_s)
    want = {**_nearest(left, right, None, 0), 999: None}
    assert {x["id"]: x["r_rt"] for x in got.collect()} == want


def test_one_reply_may_serve_several_requests(spark):
    l = spark.createDataFrame([(1, "a", at(0)), (2, "a", at(1))], "id int, k string, t timestamp")
    r = spark.createDataFrame([("a", at(2))], "k string, rt timestamp")
    got = asof_join_within(l, r, ["k"], "t", "rt", 5000)
    assert all(x["r_matched"] for x in got.collect())


@pytest.mark.parametrize(("small", "ordered"), [(5, 10**9), (5, 0), (4000, 10**9)])
@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_exact_quantile(spark, monkeypatch, small, ordered, q):
    """Ranked whole, bracketed, and bracketed in bins."""
    monkeypatch.setattr(quantile_module, "SMALL", small)
    monkeypatch.setattr(quantile_module, "ORDERED", ordered)
    monkeypatch.setattr(quantile_module, "ACCURACY", 100 if small == 5 else 5000)
    rng = np.random.default_rng(3)
    groups = {
        "hot": rng.exponential(50, 3000), "ties": np.repeat([1.0, 2.0, 9.0], 200),
        "one": np.array([4.2]), "wide": np.concatenate([rng.normal(0, 1, 500), [1e9, -1e9]]),
    }
    rows = [(k, float(x)) for k, xs in groups.items() for x in xs] + [("hot", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r["p"] for r in exact_quantile(df, ["k"], "x", q, "p").collect()}
    assert got.keys() == groups.keys()
    for k, xs in groups.items():
        assert got[k] == pytest.approx(np.quantile(xs, q), rel=1e-12)
    alone = exact_quantile(df.filter("k = 'hot'"), [], "x", q, "p").first()["p"]
    assert alone == pytest.approx(got["hot"])


def test_quantile_of_nothing_has_no_row(spark):
    empty = spark.createDataFrame([], "k string, x double")
    assert exact_quantile(empty, ["k"], "x", 0.5).count() == 0


PREFIXES = [("10.0.0.0/8", "net"), ("10.1.0.0/16", "site"), ("10.1.2.0/24", "lan"),
            ("10.1.2.3/32", "host"), ("10.1.2.0/24", "zz-later duplicate")]


@pytest.mark.parametrize("limit", [1_000, 0])
def test_longest_prefix_wins(spark, limit):
    table = prefix_table(spark.createDataFrame(PREFIXES, "p string, name string"), "p", "name")
    base, host = 10 << 24, (10 << 24) + (1 << 16) + (2 << 8) + 3
    ips = [(1, host), (2, host + 1), (3, base + (1 << 16)), (4, base + 5), (5, 42), (6, None)]
    df = spark.createDataFrame(ips, "id int, ip bigint")
    got = longest_prefix_match(df, F.col("ip"), table, {"name": ("name", "")}, limit)
    assert {r["id"]: r["name"] for r in got.collect()} == {
        1: "host", 2: "lan", 3: "site", 4: "net", 5: "", 6: ""
    }


def test_empty_prefix_table(spark):
    table = prefix_table(spark.createDataFrame([], "p string, name string"), "p", "name")
    df = spark.createDataFrame([(1, 5)], "id int, ip bigint")
    assert longest_prefix_match(df, F.col("ip"), table, {"name": ("name", "")}).first()["name"] == ""


def test_lookup_default_and_presence(spark):
    table = spark.createDataFrame([("a", 1, None)], "k string, n int, s string")
    df = spark.createDataFrame([("a",), ("b",), (None,)], "key string")
    got = lookup(df, table, {"key": "k"}, {"n": ("n", 0), "s": ("s", "?")}, found="known")
    assert {tuple(r) for r in got.collect()} == {
        ("a", 1, "?", True), ("b", 0, "?", False), (None, 0, "?", False)
    }


def test_one_row_per_key(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", 2, None)]
    df = spark.createDataFrame(rows, "k string, ver int, s string")
    assert {tuple(r) for r in latest_per_key(df, ["k"], ["ver"]).collect()} == {
        ("a", 3, "z"), ("b", 2, None)
    }
    assert {tuple(r) for r in earliest_per_key(df, ["k"], ["ver"]).collect()} == {
        ("a", 1, "x"), ("b", 2, None)
    }


def test_bounded_list_and_heaviest(spark):
    rows = [("a", f"app{i % 30:02d}", i % 2) for i in range(300)] + [("b", "app00", 0), ("b", None, 0)]
    df = spark.createDataFrame(rows, "k string, app string, w int")
    got = {r["k"]: r["items"] for r in bounded_distinct(df, ["k"], "app").collect()}
    assert got == {"a": [f"app{i:02d}" for i in range(16)], "b": ["app00"]}
    top = {r["k"]: r["top_item"] for r in heaviest_item(df, ["k"], "app", "w").collect()}
    assert top == {"a": "app29", "b": ""}


def test_path_drops_empty_and_repeated_elements(spark):
    cols = ["switch_id", "router_id", "circuit_id", "pop_id", "provider", "probe_c2s", "probe_s2c",
            "server_id", "app"]
    df = spark.createDataFrame([("", "r", "c", "p", "v", "gw", "gw", "", "a")], cols)
    got = {tuple(r) for r in explode_path(df, []).collect()}
    assert got == {("router", "r"), ("circuit", "c"), ("pop", "p"), ("provider", "v"),
                   ("gateway", "gw"), ("app", "a")}


def test_slices_are_open_below_and_closed_above(spark):
    df = spark.createDataFrame([(at(s),) for s in (-60, 0, 1, 60, 120)], "t timestamp")
    got = df.filter(in_slices(F.col("t"), at(0), at(60), [0, 60])).collect()
    assert sorted(r["t"] for r in got) == [at(0), at(1), at(60)]


def test_read_bound(spark):
    from pathquality.functions.clock import EPOCH

    def since(times, lookback=86_400):
        df = spark.createDataFrame([(t,) for t in times], "first_seen timestamp")
        row = oldest_needed(df, at(0), lookback, 5_050).first()
        return row["since"], row["queued"]

    assert since([at(-10), at(-20)]) == (at(-25.05), 2)
    assert since([at(-10), EPOCH], 3600) == (at(-3600), 2)
    assert since([at(-7200)], 3600) == (at(-3600), 1)
    assert since([])[1] == 0


def test_broadcast_needs_a_measured_size(spark):
    df = spark.range(100).select(F.col("id"), F.lit("x" * 100).alias("s"))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=5_000)
