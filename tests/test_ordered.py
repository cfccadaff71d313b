"""The row before, whatever the distribution in time."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tierwise.operators import ingest, ordered


def burst(spark, n=30000):
    """A third of all rows in one second, most of it in one series, many of them equal."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("series_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1_700_000_000)).otherwise(F.col("id") * 997 % 2_000_000_000).cast("timestamp").alias("ts"),
        F.when(F.col("id") % 2 == 0, 1.0).otherwise((F.col("id") % 1000).cast("double")).alias("value"))


def test_burst_is_spread_over_all_ranges(spark):
    df = burst(spark)
    sizes = [r["count"] for r in ordered.ranged(df, "series_id", ["ts", "value"], "value", 12).groupBy("_part").count().collect()]
    assert len(sizes) == 12 and max(sizes) <= 3 * 30000 / 12


def test_previous_is_lag(spark):
    df = burst(spark, 6000)
    got = ordered.previous(df, "series_id", ["ts", "value"], "value", partitions=7)
    want = df.withColumn("previous", F.lag("value").over(Window.partitionBy("series_id").orderBy("ts", "value")))
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_groups_that_skip_ranges_and_null_groups(spark):
    rows = [("a", 1, 1.0), ("c", 5, 2.0), (None, 1, 7.0), (None, 9, 8.0)] + [("b", i, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, t int, v double")
    got = ordered.previous(df, "g", ["t"], "v", partitions=11)
    want = df.withColumn("previous", F.lag("v").over(Window.partitionBy("g").orderBy("t")))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_rate_changes_of_a_burst(spark):
    df = burst(spark, 3000).withColumn("label", F.lit("x"))
    got = ingest.rate_changes(df, "ts", partitions=6).select("series_id", "ts", "value", F.round("rate_change_bps", 6).alias("b"))
    lag = F.lag("value").over(Window.partitionBy("series_id").orderBy("ts", "value"))
    want = df.select("series_id", "ts", "value", F.round(F.coalesce((F.col("value") - lag) * 100, F.lit(0.0)), 6).alias("b"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
