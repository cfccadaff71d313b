"""Marts kept up to date (A3, A4, A5, A7, A11, A13) and quantiles that merge.

Both are layers that follow the gold layer by partition (``versions.follow``): when a late day arrives, its
partition alone is read.

* ``sums``: per (date, state, tier) counts, sums and bounds. Averages and shares come from them, so all six answers read
  the cube, never a loan.
* ``sketches``: per date and column a KLL sketch. Sketches of any dates merge; a quantile of the merged one is within
  ``RANK_ERROR`` of its rank (``quantiles.py`` stays the exact path, and the default).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import HIGH_RISK_TIERS, PARTITION_COLS
from . import analytics, versions

DATE, KEYS = "processing_date", ["state", "risk_tier"]
MEASURES = {"score": "risk_score", "amount": "loan_amount"}


def _v(c: str) -> Column:
    return F.col(c).cast("double")


# ---------------------------------------------------------------- sums

def sums(gold: DataFrame) -> DataFrame:
    """The cube's rows of some partitions."""
    parts = []
    for name, c in MEASURES.items():
        parts += [F.count(_v(c)).alias(f"n_{name}"), F.sum(_v(c)).alias(f"sum_{name}"),
                  F.min(_v(c)).alias(f"min_{name}"), F.max(_v(c)).alias(f"max_{name}")]
    return gold.groupBy(*PARTITION_COLS, DATE, *KEYS).agg(F.count(F.lit(1)).alias("n"), *parts)


def update_sums(spark: SparkSession, gold_root: str, cube_root: str) -> dict:
    return versions.follow(spark, gold_root, cube_root, sums)


def _mean(name: str, when: Column | None = None) -> Column:
    total, n = F.col(f"sum_{name}"), F.col(f"n_{name}")
    return F.sum(total if when is None else F.when(when, total)) / F.nullif(F.sum(n if when is None else F.when(when, n)), F.lit(0))


def daily_trend(cube: DataFrame) -> DataFrame:
    """A3."""
    return cube.groupBy(DATE, "risk_tier").agg(F.sum("n").alias("loan_count"), _mean("score").alias("avg_risk_score"))


def portfolio_stats(cube: DataFrame) -> DataFrame:
    """A4."""
    high = F.col("risk_tier").isin(HIGH_RISK_TIERS)
    return cube.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_loans"), F.coalesce(F.round(_mean("score"), 3), F.lit(0.0)).alias("avg_risk_score"),
        F.coalesce(F.round(_mean("amount"), 0), F.lit(0.0)).alias("avg_loan_amount"),
        F.round(F.coalesce(F.sum(F.when(high, F.col("sum_amount"))), F.lit(0.0)) / F.lit(1e9), 2).alias("high_risk_exposure_billions"),
        F.max(DATE).alias("last_updated"))


def tier_distribution(cube: DataFrame) -> DataFrame:
    """A null tier is counted but has no share."""
    counts = cube.groupBy("risk_tier").agg(F.sum("n").alias("loan_count"))
    total = F.sum(F.when(F.col("risk_tier").isNotNull(), F.col("loan_count"))).over(Window.partitionBy())     # a row per tier
    return counts.withColumn("share", F.when(F.col("risk_tier").isNotNull(), F.col("loan_count") / total))


def totals(cube: DataFrame) -> DataFrame:
    """A7, A8."""
    return cube.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_loans"), _mean("score").alias("mean_risk_score"),
                    F.sum("sum_amount").alias("total_amount"), F.min(DATE).alias("min_date"), F.max(DATE).alias("max_date"),
                    F.min("min_amount").alias("min_amount"), F.max("max_amount").alias("max_amount"))


def daily_stats(cube: DataFrame) -> DataFrame:
    """A11."""
    return cube.groupBy(F.col(DATE).alias("date")).agg(_mean("score").alias("mean"), F.max("max_score").alias("max"), F.min("min_score").alias("min"))


def hierarchy_sum(cube: DataFrame) -> DataFrame:
    """A13."""
    return cube.rollup(*KEYS).agg(F.sum("sum_amount").alias("total_amount"), F.grouping_id().alias("level"))


# ---------------------------------------------------------------- sketches

K = 400
# rank error (as a share of the rows) of a KLL sketch with K, at 99 % confidence: the published rule
RANK_ERROR = round(2.296 / K ** 0.9723, 6)


def sketches(gold: DataFrame, cols: list[str] = analytics.DESCRIBE_COLS) -> DataFrame:
    """A sketch per partition, date and column. NaN is no value."""
    v = F.when(~F.isnan("v"), F.col("v"))
    long = gold.select(*PARTITION_COLS, DATE, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _v(c).alias("v")) for c in cols])).alias("x")).select(*PARTITION_COLS, DATE, "x.*")
    return long.withColumn("v", v).where("v IS NOT NULL").groupBy(*PARTITION_COLS, DATE, "column").agg(
        F.count("v").alias("n"), F.kll_sketch_agg_double("v", K).alias("sketch"))


def update_sketches(spark: SparkSession, gold_root: str, root: str) -> dict:
    return versions.follow(spark, gold_root, root, sketches)


def merged_quantiles(layer: DataFrame, probabilities: list[float], dates: tuple[str, str] | None = None) -> DataFrame:
    """column, n, probability, value and rank_error (the bound) over all dates, or those of an inclusive range."""
    if dates is not None:
        layer = layer.where(F.col(DATE).between(*[F.lit(d).cast("date") for d in dates]))
    one = layer.groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", K).alias("sketch"))
    found = F.explode(F.array(*[F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
                                for p in probabilities]))
    return one.select("column", "n", found.alias("q")).select("column", "n", "q.*", F.lit(RANK_ERROR).alias("rank_error"))
