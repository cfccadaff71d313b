"""Domain views over the supplied test tables.

The supplied tables hold no mortgages, so these deterministic projections
give each domain schema from them (identical expressions exist as SQL in
``plans.oracle``). All are narrow projections: no shuffle, full column
pruning and filter pushdown into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT_LOAN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table. Its timestamps are naive (TIMESTAMP_NTZ); the views
    below are defined on UTC wall-clock time, so the session zone is pinned to
    UTC (streaming watermarks need zone-aware timestamps)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _iso(ts):
    """Naive timestamp -> 'yyyy-MM-ddTHH:mm:ss' without any time-zone step."""
    return F.regexp_replace(ts.cast("timestamp_ntz").cast("string"), " ", "T")


def _s(c):
    return c.cast("string")


def _landed_ts():
    """Ship date plus a deterministic time of day (hour from the order key,
    minute from the line number)."""
    return (F.col("l_shipdate")
            + F.make_interval(hours=(F.col("l_orderkey") % 24).cast("int"),
                              mins=F.col("l_linenumber").cast("int")))


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_bytes: int = 1 << 30) -> DataFrame:
    """One supplied table as a file stream; micro-batches are sized by bytes."""
    reader = (spark.readStream.schema(table(spark, sf_dir, name).schema)
              .option("maxBytesPerTrigger", str(max_bytes)))
    root = sf_dir.rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(path).isDirectory():
        return reader.parquet(f"{root}/{name}.parquet")
    # a file stream reads folders: a table of one file is picked out of its folder
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(root)


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loan events of the supplied ``lineitem``."""
    return loans_of(table(spark, sf_dir, "lineitem"))


def loans_of(li: DataFrame) -> DataFrame:
    """Raw loan events (all text) derived from ``lineitem`` rows, batch or stream.

    ``landed_date`` stands in for the day the record landed (the reference
    stamps the run date; here it is the ship date, so the daily marts have
    many days).
    """
    pk, ok, sk, ln = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_linenumber")
    return li.select(
        F.concat_ws("-", _s(ok), _s(ln), _s(pk), _s(sk)).alias("loan_id"),
        F.when(pk % 97 == 0, F.lit("NA")).when(pk % 89 == 0, F.lit(""))
         .otherwise(_s(F.col("l_extendedprice"))).alias("loan_amount"),
        _s(sk % 6).alias("loan_type"),
        _s(ok % 10).alias("action_taken"),
        F.when(pk % 23 == 0, F.lit("NA")).when(pk % 29 == 0, F.lit("Exempt"))
         .otherwise(_s(F.lit(60) + F.col("l_quantity").cast("int"))).alias("ltv"),
        F.when(pk % 20 == 0, F.lit("NA")).when(pk % 20 == 1, F.lit("<20%"))
         .when(pk % 20 == 2, F.lit("20%-<30%")).when(pk % 20 == 3, F.lit("30%-<36%"))
         .when(pk % 20 == 4, F.lit("50%-60%")).when(pk % 20 == 5, F.lit(">60%"))
         .otherwise(_s(F.lit(30) + pk % 20)).alias("dti"),
        _s(F.lit(20) + pk * 37 % 200).alias("income"),
        F.when(ok % 19 == 0, F.lit("NA"))
         .otherwise(F.concat(_s(F.lit(2) + F.round(F.col("l_tax") * 100).cast("int")), F.lit("."),
                             _s(ln % 4 * 25))).alias("interest_rate"),
        F.when(ok % 10 == 3, _s(ln)).otherwise(F.lit("NA")).alias("denial_reason_1"),
        F.when(sk % 3 == 0, F.lit("VA")).when(sk % 3 == 1, F.lit("MD")).otherwise(F.lit("DC")).alias("state"),
        F.lpad(_s(sk % 200), 3, "0").alias("county_code"),
        _s(pk * 1000).alias("property_value"),
        F.lit(EVENT_LOAN).alias("event_type"),
        _iso(_landed_ts()).alias("ingestion_timestamp"),
        F.lit("loan-applications").alias("_source_topic"),
        F.unix_timestamp(_landed_ts().cast("timestamp")).alias("_bridge_ts"),
        F.col("l_shipdate").cast("date").alias("landed_date"),
    )


def rate_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form rate observations of the supplied ``events``."""
    return rates_of(table(spark, sf_dir, "events"))


def rates_of(ev: DataFrame) -> DataFrame:
    """Long-form rate observations from ``events`` rows: one series per event type."""
    return ev.select(
        F.col("event_type").alias("series_id"),
        F.col("event_type").alias("label"),
        F.col("ts"),
        F.col("value"),
    )


def indicator_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form macro indicator observations from ``events``.

    date = hour of ts; click/view/purchase/signup are the four indicators.
    """
    ev = table(spark, sf_dir, "events")
    key = (F.when(F.col("event_type") == "click", "fed_funds_rate")
            .when(F.col("event_type") == "view", "treasury_yield_10yr")
            .when(F.col("event_type") == "purchase", "unemployment_rate")
            .when(F.col("event_type") == "signup", "cpi"))
    return (ev.where(F.col("event_type").isin("click", "view", "purchase", "signup"))
              .select(F.window("ts", "1 hour").start.cast("string").alias("date"),
                      key.alias("indicator"), F.col("value"), F.col("ts").alias("seq")))


def census_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census-style county rows (all text) from ``customer``."""
    c = table(spark, sf_dir, "customer")
    nk = F.col("c_nationkey")
    return c.select(
        F.concat(F.col("c_name"), F.lit(" County, X")).alias("NAME"),
        _s(F.col("c_acctbal") * 80).alias("B25077_001E"),
        _s(F.col("c_acctbal") * 15).alias("B19013_001E"),
        _s(F.col("c_custkey") % 1000).alias("B25003_002E"),
        F.when(nk % 4 == 0, "51").when(nk % 4 == 1, "24").when(nk % 4 == 2, "11")
         .otherwise("99").alias("state"),
        _s(F.col("c_custkey")).alias("county"),
    )
