"""Staging view and marts.

Marts are aggregates with partial (map-side) aggregation; none sorts a
whole table: order is applied on read (``ordered``) or via a top-k
(TakeOrderedAndProject), which keeps only k rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import GOLD_CARRY, HIGH_RISK_TIERS


def stg_loan_risk_scores(gold: DataFrame, as_of_ts: str | Column | None = None) -> DataFrame:
    """Rename codes, add processed_at; gold partition columns dropped."""
    if as_of_ts is None:
        ts = F.current_timestamp()
    elif isinstance(as_of_ts, Column):
        ts = as_of_ts
    else:
        ts = F.lit(as_of_ts).cast("timestamp")
    carry = [c for c in GOLD_CARRY if c in gold.columns]
    return gold.select(
        *carry,
        "loan_amount", "ltv", "dti", "interest_rate", "income",
        "ltv_score", "dti_score", "rate_spread_score", "macro_stress_score",
        "risk_score", "risk_tier", "processing_date",
        F.col("action_taken").alias("action_code"),
        F.col("loan_type").alias("loan_type_code"),
        ts.alias("processed_at"),
    )


def _avg(c: str) -> Column:
    # float32 columns are widened before summing
    return F.avg(F.col(c).cast("double"))


def mart_risk_summary(stg: DataFrame) -> DataFrame:
    """A1: by tier: count and averages. Order (avg score desc) on read."""
    return stg.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("loan_count"),
        _avg("risk_score").alias("avg_risk_score"),
        _avg("loan_amount").alias("avg_loan_amount"),
        _avg("ltv").alias("avg_ltv"),
        _avg("dti").alias("avg_dti"),
        _avg("interest_rate").alias("avg_interest_rate"),
    )


def mart_daily_risk_trend(stg: DataFrame) -> DataFrame:
    """A3: by (processing_date, tier): count, avg score."""
    return stg.groupBy("processing_date", "risk_tier").agg(
        F.count(F.lit(1)).alias("loan_count"),
        _avg("risk_score").alias("avg_risk_score"),
    )


def high_risk(df: DataFrame) -> DataFrame:
    """tier in (CRITICAL, HIGH)."""
    return df.where(F.col("risk_tier").isin(HIGH_RISK_TIERS))


def critical(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """F8: tier = CRITICAL [and processing_date = as_of]."""
    out = df.where(F.col("risk_tier") == "CRITICAL")
    if as_of is not None:
        out = out.where(F.col("processing_date") == F.lit(as_of).cast("date"))
    return out


def mart_high_risk_loans(stg: DataFrame) -> DataFrame:
    """O2 table: high-risk rows; sorting is left to readers."""
    return high_risk(stg)


def ordered(df: DataFrame, keys: list) -> DataFrame:
    """Global order for display. Range-partitioned sort."""
    return df.orderBy(*keys)


def top_critical(df: DataFrame, limit: int = 10, tie: str = "loan_id") -> DataFrame:
    """O1: CRITICAL loans by score desc, limit 1..100, 6 columns.

    ``tie`` gives a total order so the k rows are deterministic; Spark plans
    this as TakeOrderedAndProject (k rows per task, then a k-row merge).
    """
    if not 1 <= limit <= 100:
        raise ValueError("limit must be in 1..100")
    cols = ["risk_score", "risk_tier", "loan_amount", "ltv", "dti", "interest_rate"]
    keys = [F.col("risk_score").desc()] + ([F.col(tie).asc()] if tie in df.columns else [])
    extra = [tie] if tie in df.columns else []
    return critical(df).orderBy(*keys).limit(limit).select(*extra, *cols)


def high_risk_head(stg: DataFrame, n: int = 100, tie: str = "loan_id") -> DataFrame:
    """O3: first n of the sorted high-risk list (top-k, not a full sort)."""
    keys = [F.col("risk_score").desc()] + ([F.col(tie).asc()] if tie in stg.columns else [])
    return high_risk(stg).orderBy(*keys).limit(n)


def loan_by_id(df: DataFrame, loan_id: str) -> DataFrame:
    """one loan by key."""
    return df.where(F.col("loan_id") == F.lit(loan_id))
