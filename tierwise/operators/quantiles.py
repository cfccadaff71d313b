"""Exact, linearly interpolated quantiles that scale out, on one path.

1. A histogram: one row per (group, distinct value) with its count (partial
   aggregation, so a value that holds a third of all rows becomes one row).
2. Every value has a bucket that follows from the value alone: ``RESOLUTION``
   buckets per unit of ``ln(1 + |v|)``, in the order of the values. A wider
   spread of values gives more buckets; no sample, no bounds, no job.
3. A (group, bucket) table of counts, with running offsets, tells which bucket
   holds each rank that a quantile needs.
4. Only those buckets of the histogram are ranked inside and interpolated:
   q = v_lo + (v_hi - v_lo) * frac, pos = (n - 1) * p, the rule of pandas
   ``quantile``/``describe`` and SQL ``quantile_cont``.

Nothing is collected and no plan depends on the data's size; a hot group is
spread over its buckets. The histogram's shuffle is reused by both branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESOLUTION = 4096
NO_VALUE = -(1 << 62)


def bucket_of(v: Column) -> Column:
    """The bucket of a double; never decreases as v grows."""
    return (F.signum(v) * F.floor(F.lit(float(RESOLUTION)) * F.log1p(F.abs(v)))).cast("long")


def _centre(b: Column) -> Column:
    """A value in or next to a bucket, to sum deviations from."""
    return F.signum(b.cast("double")) * F.expm1(F.abs(b) / F.lit(float(RESOLUTION)))


def histogram(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """(keys..., v, n, b): distinct values with counts; null and NaN are one row with null v, in a bucket
    of their own. As b is never null, no join adds a filter to one of the histogram's uses, and both
    share one shuffle."""
    v = F.col(value).cast("double")
    long = df.select(*keys, F.when(~F.isnan(v), v).alias("v"))
    return long.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "b", F.coalesce(bucket_of(F.col("v")), F.lit(NO_VALUE)))


def bucket_table(hist: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., b, bn, off, total) and per bucket the extremes and the sums of deviations from its centre
    c. One row per (group, bucket); the windows run over these rows only."""
    d = F.col("v") - _centre(F.col("b"))
    bt = hist.groupBy(*keys, "b").agg(
        F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)).alias("bn"),
        F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.sum(F.col("n") * d).alias("s1"), F.sum(F.col("n") * d * d).alias("s2"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    return (bt.withColumn("c", _centre(F.col("b")))
              .withColumn("off", F.coalesce(F.sum("bn").over(before), F.lit(0)))
              .withColumn("total", F.sum("bn").over(group)))


def moments(bt: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., count, mean, std, min, max) from a bucket table; a group without values has count 0."""
    n, group = F.col("bn"), Window.partitionBy(*keys)
    whole = F.when(n > 0, n * F.col("c") + F.col("s1"))
    x = bt.withColumn("_mean", F.try_divide(F.sum(whole).over(group), F.sum("bn").over(group)))
    # squared deviations: within the bucket, and of the bucket's own mean from the group's
    own = F.col("s2") - F.col("s1") * F.col("s1") / n
    apart = F.col("c") + F.col("s1") / n - F.col("_mean")
    x = x.withColumn("_m2", F.when(n > 0, own + n * apart * apart))
    return x.groupBy(*keys).agg(
        F.sum("bn").alias("count"), F.max("_mean").alias("mean"),
        F.sqrt(F.when(F.sum("bn") > 1, F.greatest(F.sum("_m2"), F.lit(0.0)) / (F.sum("bn") - 1))).alias("std"),
        F.min("lo").alias("min"), F.max("hi").alias("max"))


def quantiles_of(hist: DataFrame, bt: DataFrame, probs: list[float], keys: list[str]) -> DataFrame:
    """(keys..., p, q) for every group with values."""
    pos = lambda p: (F.col("total") - 1) * F.lit(float(p))                  # noqa: E731
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.lit(w).alias("which"),
                                f(pos(p)).cast("long").alias("k"), (pos(p) - F.floor(pos(p))).alias("frac"))
                       for p in probs for w, f in ((0, F.floor), (1, F.ceil))])
    here = bt.where("bn > 0").select(
        *[F.col(k).alias(f"_t_{k}") for k in keys], F.col("b").alias("_t_b"), "off",
        F.explode(F.filter(wanted, lambda t: (t["k"] >= F.col("off")) & (t["k"] < F.col("off") + F.col("bn")))).alias("t"))
    same = (F.col("b") == F.col("_t_b"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
    hit = hist.join(here, same).select(*keys, "b", "v", "n", "off", "t.*")
    inside = (Window.partitionBy(*keys, "b", "p", "which").orderBy("v")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hit = hit.withColumn("end", F.col("off") + F.sum("n").over(inside))
    hit = hit.where((F.col("k") < F.col("end")) & (F.col("k") >= F.col("end") - F.col("n")))
    out = hit.groupBy(*keys, "p").agg(F.max(F.when(F.col("which") == 0, F.col("v"))).alias("v0"),
                                      F.max(F.when(F.col("which") == 1, F.col("v"))).alias("v1"),
                                      F.max("frac").alias("frac"))
    return out.select(*keys, "p", (F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("frac")).alias("q"))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], keys: list[str] | None = None) -> DataFrame:
    """(keys..., p, q) for every group and probability. Nulls and NaN are skipped; groups without values
    give no rows."""
    keys = list(keys or [])
    hist = histogram(df, value, keys)
    return quantiles_of(hist, bucket_table(hist, keys), probs, keys)


def wide_quantiles(q: DataFrame, names: dict[float, str], keys: list[str]) -> DataFrame:
    """(keys..., p, q) rows as one column per probability."""
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in names.items()])


def median(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per column: (column, median)."""
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in cols], "column", "v")
    return exact_quantiles(long, "v", [0.5], ["column"]).select("column", F.col("q").alias("median"))
