"""Scoring inside ad-hoc SQL (K11 with M1-M6): a policy as SQL functions.

``register`` makes temporary functions from a policy's bands, weights and cuts; the optimizer inlines their bodies,
so a query over raw columns runs as plain expressions. For a policy ``gold`` they are

* ``gold_ltv_score(ltv)``, ``gold_dti_score(dti)``, ``gold_rate_score(rate)``,
* ``gold_risk_score(ltv_score, dti_score, rate_score, macro_score)``, ``gold_macro()``,
* ``gold_risk_tier(risk_score)``.

Scores are taken from sub-scores in an outer query, tiers from scores: each stage is then one projection, and no
band's text is repeated by inlining.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..policies import Bands, Policy, Tiers


def _d(x: float) -> str:
    return f"{float(x)!r}D"


def _steps(value: str, cuts, closed, results: list[str], null: str) -> str:
    cases = " ".join(f"WHEN {value} {'<=' if c else '<'} {_d(cut)} THEN {r}" for cut, c, r in zip(cuts, closed, results))
    return f"CASE WHEN {value} IS NULL THEN {null} {cases} ELSE {results[-1]} END"


def band_sql(value: str, bands: Bands, null_score: float | None) -> str:
    """M1-M3 as SQL text."""
    return _steps(value, bands.cuts, bands.closed, [_d(s) for s in bands.scores], "NULL" if null_score is None else _d(null_score))


def tier_sql(value: str, tiers: Tiers) -> str:
    """M6 as SQL text."""
    return _steps(value, tiers.cuts, tiers.closed, [f"'{x}'" for x in tiers.labels], "NULL")


def score_sql(policy: Policy, parts: list[str]) -> str:
    """M5 as SQL text, summed left to right."""
    total = " + ".join(f"{p} * {_d(w)}" for p, w in zip(parts, policy.weights))
    return f"round({total}, {policy.score_digits})" if policy.score_digits is not None else total


def register(spark: SparkSession, policy: Policy, prefix: str | None = None) -> list[str]:
    """Creates the functions of a policy with bands; gives their names."""
    p, made = prefix or policy.name, []

    def make(name: str, args: list[str], returns: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {p}_{name}({', '.join(f'{a} DOUBLE' for a in args)}) RETURNS {returns} RETURN {body}")
        made.append(f"{p}_{name}")

    for name, bands in (("ltv", policy.ltv), ("dti", policy.dti), ("rate", policy.rate)):
        make(f"{name}_score", ["x"], "DOUBLE", band_sql("x", bands, policy.null_score))
    make("macro", [], "DOUBLE", _d(policy.macro))
    parts = ["ltv_score", "dti_score", "rate_score", "macro_score"]
    make("risk_score", parts, "DOUBLE", score_sql(policy, parts))
    make("risk_tier", ["x"], "STRING", tier_sql("x", policy.tiers))
    return made


def scored_select(policy: Policy, source: str, columns: str, prefix: str | None = None) -> str:
    """A query that scores ``source`` (with ltv, dti, interest_rate) in the three stages, keeping ``columns``."""
    p = prefix or policy.name
    return f"""SELECT *, {p}_risk_tier(risk_score) AS risk_tier FROM (
  SELECT *, {p}_risk_score(ltv_score, dti_score, rate_score, {p}_macro()) AS risk_score FROM (
    SELECT {columns}, {p}_ltv_score(ltv) AS ltv_score, {p}_dti_score(dti) AS dti_score, {p}_rate_score(interest_rate) AS rate_score
    FROM {source}))"""
