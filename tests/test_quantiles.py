"""Exact distributed quantiles vs numpy's linear interpolation."""

import numpy as np
import pytest

from tierwise.operators.analytics import box_stats, describe_stats
from tierwise.operators.quantiles import exact_quantiles, median

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def check(got, rows):
    by = {}
    for g, v in rows:
        if v is not None and v == v:
            by.setdefault(g, []).append(v)
    assert {g for g, _ in got} == set(by)
    for g, vals in by.items():
        for p in PROBS:
            assert got[(g, p)] == pytest.approx(float(np.quantile(vals, p)), abs=1e-9, rel=1e-12), (g, p)


def test_matches_numpy_with_groups_and_skew(spark):
    rng = np.random.default_rng(7)
    rows = []
    for g, n, scale in (("a", 3000, 30), ("b", 17, 30), ("c", 1, 30), (None, 400, 1e9), ("tiny", 500, 1e-7)):
        vals = rng.normal(0 if g is None else 100, scale, n)
        if g == "a":
            vals[: n // 3] = 42.0   # a value holding a third of the group
        rows += [(g, float(v)) for v in vals]
    rows += [("b", None), ("b", float("nan")), ("none", None), ("neg", -0.0), ("neg", 0.0), ("neg", -5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    check({(r.g, r.p): r.q for r in exact_quantiles(df, "v", PROBS, ["g"]).collect()}, rows)


def test_no_keys_and_median(spark):
    df = spark.createDataFrame([(float(x), float(x % 7) if x % 5 else None) for x in range(1, 1001)],
                               "a double, b double")
    assert exact_quantiles(df, "a", [0.5]).first().q == pytest.approx(500.5)
    m = {r.column: r.median for r in median(df, ["a", "b"]).collect()}
    bs = [float(x % 7) for x in range(1, 1001) if x % 5]
    assert m["a"] == pytest.approx(500.5) and m["b"] == pytest.approx(float(np.median(bs)))


def test_empty_input(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, "v", [0.5]).count() == 0
    assert exact_quantiles(df.limit(0), "v", [0.5]).count() == 0


def test_many_groups(spark):
    rows = [(g, float((i * 7 + g) % 50)) for g in range(200) for i in range(30)]
    rows += [(0, float(i)) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, v double")
    check({(r.g, r.p): r.q for r in exact_quantiles(df, "v", PROBS, ["g"]).collect()}, rows)


def test_describe_keeps_an_all_null_column_and_precise_std(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(1e6, 3.0, 2000)
    df = spark.createDataFrame([(float(x), None) for x in v], "a double, b double")
    got = {r.column: r for r in describe_stats(df, ["a", "b"]).collect()}
    assert got["a"]["std"] == pytest.approx(float(np.std(v, ddof=1)), rel=1e-9)
    assert got["a"]["mean"] == pytest.approx(float(np.mean(v)), rel=1e-12)
    assert (got["b"]["count"], got["b"]["mean"], got["b"]["q50"]) == (0, None, None)


def test_box_keeps_the_null_group(spark):
    rows = [(None, float(i)) for i in range(10)] + [(None, 1000.0), ("x", 1.0), ("y", None)]
    got = {r.g: r for r in box_stats(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    assert (got[None]["n"], got[None]["outliers"], got[None]["whisker_high"]) == (11, 1, 9.0)
    assert got["x"]["median"] == 1.0 and got["y"]["n"] == 0
