"""Scoring policies as data.

The reference carries five mutually incompatible scoring rules (batch gold,
the scoring service, its unit tests, the macro refresh, the dashboard's
continuous what-if). They are kept side by side as named policies; column
builders in ``functions.scoring`` compile them to ``CASE WHEN`` chains.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Bands:
    """Step function: value -> score.

    ``cuts`` ascend; ``closed[i]`` says whether a value equal to ``cuts[i]``
    still belongs to band i (``<=``) or to band i+1 (``<``).
    ``scores`` has one more entry than ``cuts``.
    """

    cuts: tuple[float, ...]
    closed: tuple[bool, ...]
    scores: tuple[float, ...]


@dataclass(frozen=True)
class Tiers:
    cuts: tuple[float, ...]
    closed: tuple[bool, ...]
    labels: tuple[str, ...] = ("LOW", "MEDIUM", "HIGH", "CRITICAL")


@dataclass(frozen=True)
class Policy:
    name: str
    ltv: Bands | None
    dti: Bands | None
    rate: Bands | None
    tiers: Tiers
    null_score: float | None = None      # sub-score for a null input; None = null propagates
    macro: float = 0.6
    weights: tuple[float, float, float, float] = (0.30, 0.25, 0.25, 0.20)
    score_digits: int | None = None      # round(score, n) before tiering


# Fixed values that must equal the reference's: band cuts, band scores,
# weights, macro constant and tier cuts of each policy.
_SCORES = (0.2, 0.5, 0.8, 1.0)

GOLD = Policy(
    name="gold",
    ltv=Bands((80.0, 90.0, 95.0), (False, True, True), _SCORES),
    dti=Bands((36.0, 43.0, 50.0), (False, True, True), _SCORES),
    rate=Bands((4.0, 6.0, 8.0), (False, True, True), _SCORES),
    tiers=Tiers((0.3, 0.6, 0.8), (False, True, True)),
    null_score=0.5,
)

API = Policy(
    name="api",
    ltv=Bands((80.0, 90.0, 95.0), (False, False, False), _SCORES),
    dti=Bands((36.0, 43.0, 50.0), (False, False, False), _SCORES),
    rate=Bands((4.0, 6.0, 8.0), (False, False, False), _SCORES),
    tiers=Tiers((0.3, 0.6, 0.85), (False, False, False)),
    score_digits=4,
)

TESTS = Policy(
    name="tests",
    ltv=API.ltv, dti=API.dti, rate=API.rate,
    tiers=Tiers((0.3, 0.6, 0.8), (False, False, False)),
    score_digits=3,
)

# Re-tier after a macro refresh: stored sub-scores are reused (no bands).
REFRESH = Policy(
    name="refresh",
    ltv=None, dti=None, rate=None,
    tiers=Tiers((0.3, 0.6, 0.85), (False, False, False)),
)

# Dashboard's linear score: ltv/100*.3 + dti/65*.25 + rate/10*.25 + .12
CONTINUOUS = Policy(
    name="continuous",
    ltv=None, dti=None, rate=None,
    tiers=Tiers((0.3, 0.55, 0.75), (False, False, False)),
    score_digits=None,
)
CONTINUOUS_SCALE = {"ltv": 100.0, "dti": 65.0, "interest_rate": 10.0}
CONTINUOUS_MACRO_TERM = 0.12

POLICIES = {p.name: p for p in (GOLD, API, TESTS, REFRESH, CONTINUOUS)}

# Recommendation text per tier (scoring service wording) — fixed values.
RECOMMENDATIONS = {
    "CRITICAL": "Immediate rejection recommended. Exceeds all risk thresholds.",
    "HIGH": "Loan requires senior underwriter review. High default probability.",
    "MEDIUM": "Standard underwriting process. Monitor LTV and DTI closely.",
    "LOW": "Approve with standard terms. Low default risk.",
}

# Dashboard constants — fixed values.
BENCHMARK_SCORE = 0.45
PROJECTION_GROWTH = 1.05
RATE_HIKES = (0.0, 0.5, 1.0, 2.0, 5.0)

# Shorter recommendation wording used by the reference's unit tests — fixed values.
RECOMMENDATIONS_SHORT = {
    "CRITICAL": "Immediate rejection recommended.",
    "HIGH": "Requires senior underwriter review.",
    "MEDIUM": "Standard underwriting process.",
    "LOW": "Approve with standard terms.",
}
