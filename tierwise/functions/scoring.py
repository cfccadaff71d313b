"""Column builders for the scoring policies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..policies import (
    CONTINUOUS, CONTINUOUS_MACRO_TERM, CONTINUOUS_SCALE, RECOMMENDATIONS, Bands,
    Policy, Tiers,
)
from .cleaning import _c, capped, clamp01


def band_score(col, bands: Bands, null_score: float | None = None) -> Column:
    """M1-M3: compile a band table to one CASE WHEN chain.

    The input is widened to double first (silver stores float32), then
    compared against each cut with ``<`` or ``<=`` as the band declares.
    A null input gets ``null_score`` (or stays null when that is None).
    """
    c = _c(col).cast("double")
    if null_score is None:
        expr = F.when(c.isNull(), F.lit(None).cast("double"))
    else:
        expr = F.when(c.isNull(), F.lit(float(null_score)))
    for cut, closed, score in zip(bands.cuts, bands.closed, bands.scores):
        cond = c <= F.lit(cut) if closed else c < F.lit(cut)
        expr = expr.when(cond, F.lit(float(score)))
    return expr.otherwise(F.lit(float(bands.scores[-1])))


def weighted_score(ltv_s, dti_s, rate_s, macro_s, weights=(0.30, 0.25, 0.25, 0.20),
                   digits: int | None = None) -> Column:
    """M5: ltv*w0 + dti*w1 + rate*w2 + macro*w3, left to right, in double."""
    w = [F.lit(float(x)) for x in weights]
    s = _c(ltv_s) * w[0] + _c(dti_s) * w[1] + _c(rate_s) * w[2] + _c(macro_s) * w[3]
    return F.round(s, digits) if digits is not None else s


def risk_tier(score, tiers: Tiers, nullable: bool = True) -> Column:
    """Score -> tier label by the policy's cuts.

    ``nullable=False`` drops the null guard when the score cannot be null
    (gold scores a null input as 0.5), keeping the expression small.
    """
    s = _c(score)
    expr = F.when(s.isNull(), F.lit(None).cast("string")) if nullable else None
    for cut, closed, label in zip(tiers.cuts, tiers.closed, tiers.labels):
        cond = s <= F.lit(cut) if closed else s < F.lit(cut)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(tiers.labels[-1]))


def sub_scores(policy: Policy, ltv="ltv", dti="dti", rate="interest_rate",
               macro: float | Column | None = None) -> dict[str, Column]:
    """M1-M4 as a dict of named columns for ``withColumns``."""
    m = policy.macro if macro is None else macro
    return {
        "ltv_score": band_score(ltv, policy.ltv, policy.null_score),
        "dti_score": band_score(dti, policy.dti, policy.null_score),
        "rate_spread_score": band_score(rate, policy.rate, policy.null_score),
        "macro_stress_score": m if isinstance(m, Column) else F.lit(float(m)),
    }


def score_stages(policy: Policy, ltv="ltv", dti="dti", rate="interest_rate",
                 macro: float | Column | None = None) -> list[dict[str, Column]]:
    """M1-M6 as three projection stages: sub-scores, weighted score, tier.

    Later stages refer to earlier ones by name, so a tier filter pushed
    below the projections refers to each CASE chain once per use instead
    of re-inlining whole nested expression trees.
    """
    subs = sub_scores(policy, ltv, dti, rate, macro)
    score = weighted_score("ltv_score", "dti_score", "rate_spread_score", "macro_stress_score",
                           policy.weights, policy.score_digits)
    tier = risk_tier("risk_score", policy.tiers, nullable=policy.null_score is None)
    return [subs, {"risk_score": score}, {"risk_tier": tier}]


def apply_score(df, policy: Policy, **kw):
    """Apply ``score_stages`` to a DataFrame."""
    for stage in score_stages(policy, **kw):
        df = df.withColumns(stage)
    return df


def recommend(tier, texts: dict[str, str] = RECOMMENDATIONS) -> Column:
    """Tier -> recommendation text."""
    m = F.create_map(*[F.lit(x) for kv in texts.items() for x in kv])
    return m[_c(tier)]


def macro_stress(fed, unemployment, gdp_growth) -> Column:
    """M8: clamp01(fed*.1 + unemp*.05 - gdp*.05)."""
    return clamp01(_c(fed) * F.lit(0.1) + _c(unemployment) * F.lit(0.05)
                   - _c(gdp_growth) * F.lit(0.05))


def macro_index(fed="fed_funds_rate", unemployment="unemployment_rate", cpi="cpi") -> Column:
    """clamp01(fed/10*.40 + unemp/10*.35 + cpi/500*.25)."""
    return clamp01(_c(fed) / F.lit(10.0) * F.lit(0.40)
                   + _c(unemployment) / F.lit(10.0) * F.lit(0.35)
                   + _c(cpi) / F.lit(500.0) * F.lit(0.25))


def county_risk_index(income="median_income", home="median_home_value") -> Column:
    """clamp01(min(inc/150000,1)*.6 + min(home/800000,1)*.4)."""
    return clamp01(capped(income, 150000.0) * F.lit(0.6) + capped(home, 800000.0) * F.lit(0.4))


def continuous_score(ltv="ltv", dti="dti", rate="interest_rate") -> Column:
    """Linear what-if score; null inputs propagate."""
    return (_c(ltv).cast("double") / F.lit(CONTINUOUS_SCALE["ltv"]) * F.lit(0.3)
            + _c(dti).cast("double") / F.lit(CONTINUOUS_SCALE["dti"]) * F.lit(0.25)
            + _c(rate).cast("double") / F.lit(CONTINUOUS_SCALE["interest_rate"]) * F.lit(0.25)
            + F.lit(CONTINUOUS_MACRO_TERM))


def continuous_tier(score) -> Column:
    """M14."""
    return risk_tier(score, CONTINUOUS.tiers)
