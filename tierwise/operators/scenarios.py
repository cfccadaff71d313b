"""Scenario analytics and alternative scoring paths.

All are column arithmetic or small aggregates; scenario lists are literal
arrays exploded per row (no joins), so their size is fixed by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import (
    apply_score, continuous_score, continuous_tier, macro_stress, recommend, risk_tier, weighted_score,
)
from ..policies import API, RATE_HIKES, REFRESH, Policy

# Fixed values that must equal the reference's: scoring-input ranges.
INPUT_RULES = [
    ("loan_amount", 0.0, False, 10_000_000.0, True),   # (col, lo, lo_inclusive, hi, hi_inclusive)
    ("ltv", 0.0, True, 200.0, True),
    ("dti", 0.0, True, 100.0, True),
    ("interest_rate", 0.0, True, 30.0, True),
    ("income", 0.0, True, None, True),
]


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def rejection_reasons(rules=INPUT_RULES) -> Column:
    """array of violated rules per row (empty = valid). Nulls are rejected."""
    reasons = []
    for col, lo, lo_inc, hi, hi_inc in rules:
        c = _d(col)
        bad = c.isNull()
        bad = bad | ((c < lo) if lo_inc else (c <= lo))
        if hi is not None:
            bad = bad | ((c > hi) if hi_inc else (c >= hi))
        reasons.append(F.when(bad, F.lit(f"{col} out of range")))
    return F.array_compact(F.array(*reasons))


def validate_input(df: DataFrame, rules=INPUT_RULES) -> tuple[DataFrame, DataFrame]:
    """split into (valid, rejected-with-reasons). One projection, two filters."""
    tagged = df.withColumn("reasons", rejection_reasons(rules))
    return (tagged.where(F.size("reasons") == 0).drop("reasons"),
            tagged.where(F.size("reasons") > 0))


def score_loans(df: DataFrame, policy: Policy = API, scored_at: str | None = None,
                texts: dict | None = None) -> DataFrame:
    """M7: bulk scoring (batch or stream) with recommendation and timestamp."""
    scored = apply_score(df, policy)
    rec = recommend("risk_tier") if texts is None else recommend("risk_tier", texts)
    ts = F.lit(scored_at) if scored_at is not None else F.date_format(F.current_timestamp(),
                                                                      "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return scored.withColumns({"recommendation": rec, "scored_at": ts})


def refresh_scores(gold: DataFrame, macro: float | Column | None = None,
                   policy: Policy = REFRESH) -> DataFrame:
    """M8 + M9: new macro score, recompute from stored sub-scores, re-tier.

    Immutable rewrite (no UPDATE): a new frame to be written as a new version.
    Default macro is the reference's hard-coded inputs (5.25, 3.9, 2.1).
    """
    m = macro_stress(F.lit(5.25), F.lit(3.9), F.lit(2.1)) if macro is None else (
        macro if isinstance(macro, Column) else F.lit(float(macro)))
    out = gold.withColumn("macro_stress_score", m)
    out = out.withColumn("risk_score", weighted_score("ltv_score", "dti_score", "rate_spread_score",
                                                      "macro_stress_score", policy.weights))
    return out.withColumn("risk_tier", risk_tier("risk_score", policy.tiers))


def refresh_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tier counts of two stored versions, in one aggregation over both."""
    both = before.select("risk_tier", F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select("risk_tier", F.lit(0).alias("b"), F.lit(1).alias("a")))
    return both.groupBy("risk_tier").agg(F.sum("b").alias("before_count"), F.sum("a").alias("after_count"))


def refresh_preview(gold: DataFrame, macro: float | Column | None = None, policy: Policy = REFRESH) -> DataFrame:
    """M10 before anything is written: tier counts now and after a refresh, from one scan."""
    now = gold.withColumn("tier_before", F.col("risk_tier"))
    moves = refresh_scores(now, macro, policy).groupBy("tier_before", "risk_tier").agg(F.count(F.lit(1)).alias("n"))
    ends = F.array(F.struct(F.col("tier_before").alias("risk_tier"), F.col("n").alias("b"), F.lit(0).alias("a")),
                   F.struct(F.col("risk_tier").alias("risk_tier"), F.lit(0).alias("b"), F.col("n").alias("a")))
    return (moves.select(F.explode(ends).alias("e")).select("e.*").groupBy("risk_tier")
            .agg(F.sum("b").alias("before_count"), F.sum("a").alias("after_count")))


def continuous_scores(df: DataFrame) -> DataFrame:
    """M13 + M14."""
    s = df.withColumn("continuous_score", continuous_score())
    return s.withColumn("continuous_tier", continuous_tier("continuous_score"))


# Fixed values that must equal the reference's: factor names and the macro term.
FACTORS = [("LTV", "ltv", 100.0, 0.3), ("DTI", "dti", 65.0, 0.25), ("Int Rate", "interest_rate", 10.0, 0.25)]
MACRO_FACTOR = ("Macro Stress", 0.12)


def factor_contributions(df: DataFrame, key: str = "loan_id") -> DataFrame:
    """Four (factor, impact) rows per loan, by ``stack`` (no shuffle)."""
    cells = [F.struct(F.lit(name).alias("factor"), (_d(c) / F.lit(k) * F.lit(w)).alias("impact"))
             for name, c, k, w in FACTORS]
    cells.append(F.struct(F.lit(MACRO_FACTOR[0]).alias("factor"), F.lit(MACRO_FACTOR[1]).alias("impact")))
    return df.select(key, F.explode(F.array(*cells)).alias("f")).select(key, "f.factor", "f.impact")


def what_if(df: DataFrame, ltv: float | Column) -> DataFrame:
    """Replace LTV, rescore with the continuous policy, flag a tier change."""
    new_ltv = ltv if isinstance(ltv, Column) else F.lit(float(ltv))
    s = continuous_score(new_ltv, "dti", "interest_rate")
    out = df.withColumns({"new_ltv": new_ltv, "new_score": s})
    out = out.withColumn("new_tier", continuous_tier("new_score"))
    return out.withColumn("tier_changed", F.col("new_tier") != F.col("risk_tier"))


def what_if_sweep(df: DataFrame, ltvs: list[float]) -> DataFrame:
    """M16 over a scenario list: each row is expanded by the literal list (no join)."""
    out = df.withColumn("scenario_ltv", F.explode(F.array(*[F.lit(float(x)) for x in ltvs])))
    return what_if(out, F.col("scenario_ltv"))


def rate_hike(df: DataFrame, hikes=RATE_HIKES) -> DataFrame:
    """J3 + M17: portfolio mean score under each hike; hike > 0 adds hike/10*.25.

    The one-row mean is expanded by the literal hike list (no join)."""
    mean = df.agg(F.avg("risk_score").alias("mean_score"))
    j = mean.select("mean_score", F.explode(F.array(*[F.lit(float(h)) for h in hikes])).alias("hike"))
    bump = F.when(F.col("hike") > 0, F.col("hike") / F.lit(10.0) * F.lit(0.25)).otherwise(F.lit(0.0))
    return j.select("hike", "mean_score", (F.col("mean_score") + bump).alias("impacted_score"))


# ---------------------------------------------------------------- alerting

def critical_count(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """CRITICAL rows processed on ``as_of``, by default on the latest day of the data; one scan."""
    day = df.groupBy("processing_date").agg(F.count_if(F.col("risk_tier") == "CRITICAL").alias("n"))
    if as_of is not None:
        day = day.where(F.col("processing_date") == F.lit(as_of).cast("date"))
        return day.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("critical_count"))
    return day.agg(F.coalesce(F.max_by("n", "processing_date"), F.lit(0)).alias("critical_count"))


def faked_previous(current) -> Column:
    """W3, reference rule kept for parity: previous = current - 5, or 0 when <= 5."""
    c = F.col(current) if isinstance(current, str) else current
    return F.when(c > 5, c - 5).otherwise(F.lit(0))


def hourly_counts(df: DataFrame, ts_col: str, tier: str = "CRITICAL") -> DataFrame:
    """Hourly count of ``tier`` rows (tumbling 1-hour windows on naive time)."""
    w = F.window(F.col(ts_col).try_cast("timestamp_ntz"), "1 hour")
    return (df.where(F.col("risk_tier") == tier).groupBy(w.alias("w"))
              .agg(F.count(F.lit(1)).alias("current_count"))
              .select(F.col("w.start").alias("hour"), "current_count"))


def hourly_delta(counts: DataFrame) -> DataFrame:
    """Compare each hour with the calendar hour before it (0 when empty).

    Shift-and-aggregate instead of a self-join: every hourly row is emitted
    once as "current" for its hour and once as "previous" for the next hour,
    then one groupBy folds them. One pass over the hourly aggregate, no join,
    no global window.
    """
    one = F.lit(1)
    cells = F.array(
        F.struct(F.col("hour").alias("hour"), F.col("current_count").alias("cur"),
                 F.lit(0).cast("long").alias("prev"), one.alias("has_cur")),
        F.struct((F.col("hour") + F.expr("INTERVAL 1 HOUR")).alias("hour"), F.lit(0).cast("long").alias("cur"),
                 F.col("current_count").alias("prev"), F.lit(0).alias("has_cur")))
    j = (counts.select(F.explode(cells).alias("c")).select("c.*")
         .groupBy("hour").agg(F.sum("cur").alias("current_count"), F.sum("prev").alias("previous_count"),
                              F.max("has_cur").alias("has_cur"))
         .where(F.col("has_cur") == 1))
    pc = F.col("previous_count")
    # fixed value: the alert text format equals the reference's (product prefix omitted)
    return j.select("hour", "current_count", pc.alias("previous_count"),
                    (F.col("current_count") - pc).alias("new_critical"),
                    (F.col("current_count") > pc).alias("alert"),
                    F.when(F.col("current_count") > pc,
                           F.format_string("%d new CRITICAL risk loans detected at %s",
                                           F.col("current_count") - pc,
                                           F.col("hour").cast("timestamp_ntz").cast("string"))).alias("message"))
