"""Scenario operators: validation, bulk scoring, refresh, what-if, alerts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierwise.operators import scenarios
from tierwise.policies import API, RECOMMENDATIONS_SHORT

COLS = "loan_amount double, ltv double, dti double, interest_rate double, income double"


@pytest.mark.parametrize("row,valid", [
    ((450000.0, 95.0, 48.0, 8.5, 85000.0), True),
    ((0.0, 95.0, 48.0, 8.5, 85000.0), False),          # amount must be > 0
    ((10_000_000.0, 200.0, 100.0, 30.0, 0.0), True),   # all upper bounds inclusive
    ((10_000_001.0, 95.0, 48.0, 8.5, 1.0), False),
    ((1.0, 200.5, 48.0, 8.5, 1.0), False),
    ((1.0, 95.0, -0.1, 8.5, 1.0), False),
    ((1.0, 95.0, 48.0, 30.5, 1.0), False),
    ((1.0, 95.0, 48.0, 8.5, -1.0), False),
    ((1.0, None, 48.0, 8.5, 1.0), False),               # required field
])
def test_validate_input(spark, row, valid):
    ok, bad = scenarios.validate_input(spark.createDataFrame([row], COLS))
    assert (ok.count(), bad.count()) == ((1, 0) if valid else (0, 1))


def test_score_loans_api_and_short_texts(spark):
    df = spark.createDataFrame([(450000.0, 95.0, 48.0, 8.5, 85000.0)], COLS)
    r = scenarios.score_loans(df, API, scored_at="2024-01-01T00:00:00").first()
    assert (r.risk_score, r.risk_tier, r.scored_at) == (0.87, "CRITICAL", "2024-01-01T00:00:00")
    assert "rejection" in r.recommendation
    r2 = scenarios.score_loans(df, API, texts=RECOMMENDATIONS_SHORT).first()
    assert r2.recommendation == "Immediate rejection recommended."


def test_refresh_recomputes_from_sub_scores(spark):
    g = spark.createDataFrame([(1.0, 1.0, 1.0, 0.6, 0.92, "CRITICAL"), (0.8, 0.8, 0.8, 0.6, 0.76, "HIGH"),
                               (0.2, 0.2, 0.2, 0.6, 0.26, "LOW")],
                              "ltv_score double, dti_score double, rate_spread_score double, "
                              "macro_stress_score double, risk_score double, risk_tier string")
    r = scenarios.refresh_scores(g).collect()
    assert r[0].macro_stress_score == pytest.approx(0.615)
    assert r[1].risk_score == pytest.approx(0.8 * 0.8 + 0.615 * 0.2) and r[1].risk_tier == "HIGH"
    assert r[0].risk_tier == "CRITICAL" and r[2].risk_tier == "LOW"
    rep = {x.risk_tier: (x.before_count, x.after_count) for x in scenarios.refresh_report(g, scenarios.refresh_scores(g, 1.0)).collect()}
    # macro 1.0: HIGH row -> 0.84 (< .85, still HIGH); LOW row -> 0.36 (MEDIUM)
    assert rep == {"CRITICAL": (1, 1), "HIGH": (1, 1), "LOW": (1, 0), "MEDIUM": (0, 1)}


def test_what_if_and_contributions(spark):
    df = spark.createDataFrame([("L1", 90.0, 45.0, 7.0, "CRITICAL")],
                               "loan_id string, ltv double, dti double, interest_rate double, risk_tier string")
    w = scenarios.what_if(df, 50.0).first()
    assert w.new_score == pytest.approx(0.5 * 0.3 + 45 / 65 * 0.25 + 0.7 * 0.25 + 0.12)
    assert w.new_tier == "HIGH" and w.tier_changed
    sweep = scenarios.what_if_sweep(df, [50.0, 100.0]).collect()
    assert [round(x.scenario_ltv) for x in sweep] == [50, 100]
    f = {x.factor: x.impact for x in scenarios.factor_contributions(df).collect()}
    assert f == pytest.approx({"LTV": 0.27, "DTI": 45 / 65 * 0.25, "Int Rate": 0.175, "Macro Stress": 0.12})


def test_rate_hike_and_critical_count(spark):
    df = spark.createDataFrame([(0.5, "CRITICAL", dt.date(2024, 1, 2)), (0.7, "HIGH", dt.date(2024, 1, 2)),
                                (0.9, "CRITICAL", dt.date(2024, 1, 1))],
                               "risk_score double, risk_tier string, processing_date date")
    h = {r.hike: r.impacted_score for r in scenarios.rate_hike(df).collect()}
    assert h[0.0] == pytest.approx(0.7) and h[2.0] == pytest.approx(0.7 + 0.05)
    assert scenarios.critical_count(df, "2024-01-02").first().critical_count == 1
    assert [r.p for r in df.select(scenarios.faked_previous(F.lit(7)).alias("p")).limit(1).collect()] == [2]
    assert [r.p for r in df.select(scenarios.faked_previous(F.lit(3)).alias("p")).limit(1).collect()] == [0]


def test_hourly_delta_uses_calendar_previous_hour(spark):
    c = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), 3), (dt.datetime(2024, 1, 1, 11), 2),
                               (dt.datetime(2024, 1, 1, 13), 4)], "hour timestamp_ntz, current_count long")
    r = {x.hour.hour: (x.previous_count, x.alert) for x in scenarios.hourly_delta(c).collect()}
    assert r == {10: (0, True), 11: (3, False), 13: (0, True)}
