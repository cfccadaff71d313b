"""Portfolio analytics.

Every consumer of the portfolio is an aggregate on the cluster (partial +
final hash aggregation); windows run only on already-aggregated frames
whose size is bounded by tiers or calendar days, never by loan count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..policies import BENCHMARK_SCORE, PROJECTION_GROWTH
from ..schemas import HIGH_RISK_TIERS
from .quantiles import bucket_table, histogram, moments, quantiles_of, wide_quantiles

DESCRIBE_COLS = ["loan_amount", "ltv", "dti", "interest_rate", "risk_score"]
CORR_COLS = ["ltv", "dti", "interest_rate", "risk_score"]


def _d(c: str) -> Column:
    return F.col(c).cast("double")


def row_count(df: DataFrame) -> DataFrame:
    """A21."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def portfolio_stats(df: DataFrame) -> DataFrame:
    """A4: the five statistics of the stats endpoint in ONE scan.

    avg score 3 dp, avg amount 0 dp (null -> 0.0), exposure of HIGH+CRITICAL
    in billions 2 dp (null -> 0), latest processing date.
    """
    hi = F.col("risk_tier").isin(HIGH_RISK_TIERS)
    return df.agg(
        F.count(F.lit(1)).alias("total_loans"),
        F.coalesce(F.round(F.avg("risk_score"), 3), F.lit(0.0)).alias("avg_risk_score"),
        F.coalesce(F.round(F.avg(_d("loan_amount")), 0), F.lit(0.0)).alias("avg_loan_amount"),
        F.round(F.coalesce(F.sum(F.when(hi, _d("loan_amount"))), F.lit(0.0)) / F.lit(1e9), 2)
         .alias("high_risk_exposure_billions"),
        F.max("processing_date").alias("last_updated"),
    )


def tier_distribution(df: DataFrame) -> DataFrame:
    """Count per tier and its share (null tier excluded from share)."""
    counts = df.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("loan_count"))
    # window over the <= 5-row aggregate only
    total = F.sum(F.when(F.col("risk_tier").isNotNull(), F.col("loan_count"))).over(Window.partitionBy())
    return counts.withColumn("share", F.when(F.col("risk_tier").isNotNull(), F.col("loan_count") / total))


def totals(df: DataFrame) -> DataFrame:
    """A7 + A8: count, mean score, total amount, date/amount bounds."""
    return df.agg(
        F.count(F.lit(1)).alias("total_loans"),
        F.avg("risk_score").alias("mean_risk_score"),
        F.sum(_d("loan_amount")).alias("total_amount"),
        F.min("processing_date").alias("min_date"),
        F.max("processing_date").alias("max_date"),
        F.min(_d("loan_amount")).alias("min_amount"),
        F.max(_d("loan_amount")).alias("max_amount"),
    )


def segment(df: DataFrame, states=("VA", "MD", "DC"), amount: tuple | None = None,
            dates: tuple | None = None) -> DataFrame:
    """state set and inclusive amount range; optional date range."""
    out = df.where(F.col("state").isin(list(states)))
    if amount is not None:
        out = out.where(_d("loan_amount").between(float(amount[0]), float(amount[1])))
    if dates is not None:
        out = out.where(F.col("processing_date").between(F.lit(dates[0]).cast("date"),
                                                         F.lit(dates[1]).cast("date")))
    return out


def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Wide -> long (column, v) without a shuffle."""
    return df.unpivot([], [_d(c).alias(c) for c in cols], "column", "v")


def describe_stats(df: DataFrame, cols: list[str] = DESCRIBE_COLS) -> DataFrame:
    """Per column count, mean, std (sample), min, 25/50/75 % (linear), max.

    One histogram of (column, value) feeds the moments and the quartiles: one
    scan, nothing collected. A column without values has count 0.
    """
    keys = ["column"]
    hist = histogram(_long(df, cols), "v", keys)
    bt = bucket_table(hist, keys)
    q = wide_quantiles(quantiles_of(hist, bt, [0.25, 0.5, 0.75], keys), {0.25: "q25", 0.5: "q50", 0.75: "q75"}, keys)
    return moments(bt, keys).join(q, "column", "left")


def corr_matrix(df: DataFrame, cols: list[str] = CORR_COLS) -> DataFrame:
    """A10: Pearson matrix (pairwise-complete) as (a, b, corr) rows, one scan."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.corr(_d(a), _d(b)).alias(f"{a}__{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"{a}__{b}").alias("corr")))
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.a", "c.b", "c.corr")


def daily_stats(df: DataFrame) -> DataFrame:
    """mean/max/min score per processing day."""
    return df.groupBy(F.col("processing_date").alias("date")).agg(
        F.avg("risk_score").alias("mean"), F.max("risk_score").alias("max"),
        F.min("risk_score").alias("min"))


def trend_delta(daily: DataFrame, benchmark: float = BENCHMARK_SCORE,
                growth: float = PROJECTION_GROWTH) -> DataFrame:
    """W2 + A12 + M18 + M19 on the daily frame (one row per calendar day).

    latest = mean of the last day; prev = mean of the day before it (latest
    when there is a single day); delta; peak of daily max; 30-day
    projection; distance to the benchmark.
    """
    w = Window.orderBy(F.col("date").desc())
    ranked = daily.withColumn("rn", F.row_number().over(w))
    agg = ranked.agg(
        F.max(F.when(F.col("rn") == 1, F.col("date"))).alias("latest_date"),
        F.max(F.when(F.col("rn") == 1, F.col("mean"))).alias("latest"),
        F.coalesce(F.max(F.when(F.col("rn") == 2, F.col("mean"))),
                   F.max(F.when(F.col("rn") == 1, F.col("mean")))).alias("previous"), F.max("max").alias("peak"))
    return agg.select(
        "latest_date", "latest", "previous", (F.col("latest") - F.col("previous")).alias("delta"),
        "peak", (F.col("latest") * F.lit(growth)).alias("projected_30d"),
        (F.col("latest") - F.lit(benchmark)).alias("vs_benchmark"))


def hierarchy_sum(df: DataFrame, path=("state", "risk_tier"), value: str = "loan_amount") -> DataFrame:
    """Sums at every level of the path (rollup) with the grouping id."""
    return df.rollup(*path).agg(F.sum(_d(value)).alias("total_amount"),
                                F.grouping_id().alias("level"))


def box_stats(df: DataFrame, by: str = "loan_type", value: str = "risk_score") -> DataFrame:
    """Per group min, Q1, median, Q3, max, 1.5 IQR fences (linear quantiles),
    whisker ends (furthest values inside the fences) and the outlier count.

    One (group, value) histogram feeds all of it; a null group is a group.
    """
    keys = [by]
    hist = histogram(df, value, keys)
    bt = bucket_table(hist, keys)
    q = wide_quantiles(quantiles_of(hist, bt, [0.25, 0.5, 0.75], keys), {0.25: "q1", 0.5: "median", 0.75: "q3"}, keys)
    iqr = F.col("q3") - F.col("q1")
    q = (q.withColumn("lower_fence", F.col("q1") - F.lit(1.5) * iqr)
          .withColumn("upper_fence", F.col("q3") + F.lit(1.5) * iqr).withColumnRenamed(by, "_by"))
    v, low, high = F.col("v"), F.col("lower_fence"), F.col("upper_fence")
    x = hist.join(q, F.col(by).eqNullSafe(F.col("_by")), "left")
    fences = ["q1", "median", "q3", "lower_fence", "upper_fence"]
    return x.groupBy(by).agg(
        F.min("v").alias("min"), F.max("v").alias("max"),
        F.sum(F.when(v.isNotNull(), F.col("n")).otherwise(0)).alias("n"),
        *[F.max(c).alias(c) for c in fences],
        F.min(F.when(v >= low, v)).alias("whisker_low"), F.max(F.when(v <= high, v)).alias("whisker_high"),
        F.sum(F.when(~v.between(low, high), F.col("n")).otherwise(0)).alias("outliers"))


def percentile_rank(df: DataFrame, scores: list[float], col: str = "risk_score") -> DataFrame:
    """For each probe x, share of rows with score < x, x100 (null = not below).

    One aggregation with one conditional average per probe (no row
    multiplication), then the 1-row result is unpivoted.
    """
    s = F.col(col)
    row = df.agg(*[(F.avg(F.when(s < F.lit(float(x)), 1.0).otherwise(0.0)) * 100).alias(f"p{i}")
                   for i, x in enumerate(scores)])
    cells = [F.struct(F.lit(float(x)).alias("score"), F.col(f"p{i}").alias("pct_rank"))
             for i, x in enumerate(scores)]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.score", "c.pct_rank")


def exposure_by_tier(df: DataFrame) -> DataFrame:
    """Count x average amount in billions (= sum / 1e9) per tier."""
    return df.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("loan_count"), F.avg(_d("loan_amount")).alias("avg_amount"),
        (F.sum(_d("loan_amount")) / F.lit(1e9)).alias("exposure_billions"))


def peak(daily: DataFrame) -> DataFrame:
    """Highest daily maximum."""
    return daily.agg(F.max("max").alias("peak"))


def preview(df: DataFrame, n: int = 5, cols: list[str] | None = None) -> DataFrame:
    """First n rows (of some columns); a limit is the feature."""
    return (df.select(*cols) if cols else df).limit(n)


def bounds(df: DataFrame, cols: list[str]) -> DataFrame:
    """Min and max of each column in one aggregation."""
    return df.agg(*[f(F.col(c)).alias(f"{n}_{c}") for c in cols for f, n in ((F.min, "min"), (F.max, "max"))])
