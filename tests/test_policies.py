"""Scoring policies: the reference's test vectors, boundaries and properties."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierwise.functions.scoring import (
    apply_score, continuous_score, continuous_tier, macro_stress, recommend,
)
from tierwise.policies import API, CONTINUOUS, GOLD, RECOMMENDATIONS_SHORT, TESTS, Policy


def score(spark, policy, rows, macro=None):
    df = spark.createDataFrame(rows, "ltv double, dti double, interest_rate double")
    kw = {} if macro is None else {"macro": macro}
    out = apply_score(df, policy, **kw).withColumn("rec", recommend("risk_tier"))
    return [(r.risk_score, r.risk_tier, r.rec) for r in out.collect()]


@pytest.mark.parametrize("ltv,dti,rate,tier", [
    (98, 55, 9.0, "CRITICAL"), (92, 46, 7.0, "HIGH"), (85, 40, 5.0, "MEDIUM"), (70, 30, 3.5, "LOW")])
def test_reference_tier_cases(spark, ltv, dti, rate, tier):
    (s, t, _), = score(spark, TESTS, [(float(ltv), float(dti), rate)])
    assert t == tier


def test_exact_formula_and_bounds(spark):
    (s, t, _), = score(spark, TESTS, [(70.0, 30.0, 3.5)])
    assert s == 0.28 and t == "LOW"
    (s, _, _), = score(spark, TESTS, [(80.0, 36.0, 6.0)])
    assert 0.0 <= s <= 1.0


def test_macro_raises_score(spark):
    (lo, _, _), = score(spark, TESTS, [(85.0, 40.0, 5.0)], macro=0.2)
    (hi, _, _), = score(spark, TESTS, [(85.0, 40.0, 5.0)], macro=0.8)
    assert hi > lo


def test_ltv_threshold(spark):
    (a, _, _), (b, _, _) = score(spark, TESTS, [(79.9, 36.0, 6.0), (80.1, 36.0, 6.0)])
    assert b > a


def test_readme_sample_api_vs_gold(spark):
    (s, t, rec), = score(spark, API, [(95.0, 48.0, 8.5)])
    assert (s, t) == (0.87, "CRITICAL") and "rejection" in rec
    (s, t, _), = score(spark, GOLD, [(95.0, 48.0, 8.5)])
    assert round(s, 2) == 0.81 and t == "CRITICAL"


def test_gold_null_inputs_score_medium(spark):
    (s, t, _), = score(spark, GOLD, [(None, None, None)])
    assert round(s, 10) == 0.52 and t == "MEDIUM"
    (s, t, _), = score(spark, API, [(None, None, None)])
    assert s is None and t is None


def test_low_recommendation_approves(spark):
    (_, t, rec), = score(spark, API, [(70.0, 30.0, 3.5)])
    assert t == "LOW" and "Approve" in rec
    assert "rejection" in RECOMMENDATIONS_SHORT["CRITICAL"]


@pytest.mark.parametrize("value,gold,api", [
    (79.999, 0.2, 0.2), (80.0, 0.5, 0.5), (90.0, 0.5, 0.8), (90.001, 0.8, 0.8), (95.0, 0.8, 1.0), (95.001, 1.0, 1.0)])
def test_ltv_band_boundaries(spark, value, gold, api):
    df = spark.createDataFrame([(value, 30.0, 3.0)], "ltv double, dti double, interest_rate double")
    g = apply_score(df, GOLD).first().ltv_score
    a = apply_score(df, API).first().ltv_score
    assert (g, a) == (gold, api)


@pytest.mark.parametrize("value,gold,api", [(36.0, 0.5, 0.5), (43.0, 0.5, 0.8), (50.0, 0.8, 1.0)])
def test_dti_band_boundaries(spark, value, gold, api):
    df = spark.createDataFrame([(70.0, value, 3.0)], "ltv double, dti double, interest_rate double")
    assert (apply_score(df, GOLD).first().dti_score, apply_score(df, API).first().dti_score) == (gold, api)


@pytest.mark.parametrize("value,gold,api", [(4.0, 0.5, 0.5), (6.0, 0.5, 0.8), (8.0, 0.8, 1.0)])
def test_rate_band_boundaries(spark, value, gold, api):
    df = spark.createDataFrame([(70.0, 30.0, value)], "ltv double, dti double, interest_rate double")
    assert (apply_score(df, GOLD).first().rate_spread_score,
            apply_score(df, API).first().rate_spread_score) == (gold, api)


def test_nan_is_top_band(spark):
    # Spark orders NaN above every number: a NaN rate scores 1.0, hence NaN -> null at sources
    df = spark.createDataFrame([(70.0, 30.0, float("nan"))], "ltv double, dti double, interest_rate double")
    assert apply_score(df, GOLD).first().rate_spread_score == 1.0


def test_refresh_macro_value(spark):
    v = spark.range(1).select(macro_stress(F.lit(5.25), F.lit(3.9), F.lit(2.1)).alias("m")).first().m
    assert round(v, 10) == 0.615


def test_continuous_policy(spark):
    df = spark.createDataFrame([(80.0, 36.0, 6.5), (None, 36.0, 6.5)], "ltv double, dti double, interest_rate double")
    rows = df.select(continuous_score().alias("s")).withColumn("t", continuous_tier("s")).collect()
    expected = 80 / 100 * 0.3 + 36 / 65 * 0.25 + 6.5 / 10 * 0.25 + 0.12
    assert abs(rows[0].s - expected) < 1e-12 and rows[0].t == "HIGH"
    assert rows[1].s is None and rows[1].t is None
    assert CONTINUOUS.tiers.cuts == (0.3, 0.55, 0.75)


_vals = st.floats(min_value=0, max_value=150, allow_nan=False)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(_vals, _vals, st.floats(min_value=0, max_value=20, allow_nan=False)),
                min_size=1, max_size=20))
def test_property_range_and_totality(spark, rows):
    for p in (GOLD, API):
        out = score(spark, p, rows)
        for s, t, _ in out:
            assert 0.28 - 1e-9 <= s <= 0.92 + 1e-9
            assert t in ("LOW", "MEDIUM", "HIGH", "CRITICAL")


@settings(max_examples=6, deadline=None)
@given(_vals, _vals, st.floats(min_value=0, max_value=20, allow_nan=False), st.floats(min_value=0, max_value=30))
def test_property_monotone_in_ltv(spark, ltv, dti, rate, bump):
    p: Policy = GOLD
    (a, _, _), (b, _, _) = score(spark, p, [(ltv, dti, rate), (ltv + bump, dti, rate)])
    assert b >= a
