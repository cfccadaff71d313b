"""Benchmark: the lake pipeline and the warehouse-side models on Spark.

Mirrors what the reference times: build the scored layer, then the staging
view and the three marts (its "all 4 models" wall time), the 12 model
tests, and the consumer queries. Every step runs to completion (writes or a
noop sink), nothing is collected except tiny results.

Prints ONE JSON line:
{"metric": "marts_wall_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tierwise import session  # noqa: E402
from tierwise.operators import analytics, ingest, lake, marts, quality, scenarios  # noqa: E402
from tierwise.plans import registry, streams, views  # noqa: E402,F401  (streams registers its queries)
from tierwise.sources import files, testmap  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
# rows per lake file; small enough that a 0.1-scale layer spans several files
# (one parquet row group cannot be split across tasks). 0 = library default.
FILE_ROWS = int(os.environ.get("BENCH_FILE_ROWS", "0"))
# raw landing file size (the landing stream writes many small files)
LANDING_FILE_ROWS = 50_000


def main() -> None:
    extra = {}
    if os.environ.get("BENCH_ADVISORY"):
        extra["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = os.environ["BENCH_ADVISORY"]
    spark = session.build(master=f"local[{CPUS}]", shuffle_partitions=CPUS, app="tierwise-bench", extra=extra)
    work = session.scratch_path(spark, "bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    # warm-up on the smallest tables (JIT, codegen caches); not reported
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        wraw = testmap.raw_loans(spark, warm).drop("landed_date")
        lake.write_silver(lake.clean_raw(wraw, as_of=views.AS_OF_DATE), f"{work}/warm_silver")
        wg = lake.score(lake.read_silver_path(spark, f"{work}/warm_silver"))
        for m in (marts.mart_risk_summary, marts.mart_high_risk_loans, marts.mart_daily_risk_trend):
            noop(m(marts.stg_loan_risk_scores(wg, as_of_ts=views.AS_OF_TS)))
        analytics.describe_stats(wg).collect()

    # lake jobs: land raw JSON (as the stream landing does, many files), then
    # raw JSON -> silver (S1 + K1) and silver -> gold (K2)
    raw_path, silver_path, gold_path = f"{work}/raw", f"{work}/silver", f"{work}/gold"
    timed("land_raw_json", lambda: testmap.raw_loans(spark, SF_DIR).drop("landed_date").write
          .option("maxRecordsPerFile", LANDING_FILE_ROWS).json(raw_path))
    # like the reference's nightly run, one run stamps one processing date
    raw = files.read_raw(spark, raw_path)
    fr = {"max_records": FILE_ROWS} if FILE_ROWS else {}
    fr["one_day"] = True          # one run date: no shuffle before the write
    timed("etl_silver", lambda: lake.write_silver(lake.clean_raw(raw, as_of=views.AS_OF_DATE), silver_path, **fr))
    timed("etl_gold", lambda: lake.write_gold(lake.score(lake.read_silver_path(spark, silver_path)), gold_path, **fr))

    gold = spark.read.parquet(gold_path)
    stg = marts.stg_loan_risk_scores(gold, as_of_ts=views.AS_OF_TS)
    stg.createOrReplaceTempView("stg_loan_risk_scores")

    timed("stg_view", lambda: noop(spark.table("stg_loan_risk_scores")))
    timed("mart_risk_summary", lambda: marts.mart_risk_summary(stg).write.mode("overwrite")
          .parquet(f"{work}/mart_risk_summary"))
    timed("mart_high_risk_loans", lambda: marts.mart_high_risk_loans(stg).write.mode("overwrite")
          .parquet(f"{work}/mart_high_risk_loans"))
    timed("mart_daily_risk_trend", lambda: marts.mart_daily_risk_trend(stg).write.mode("overwrite")
          .parquet(f"{work}/mart_daily_risk_trend"))

    models = {"stg_loan_risk_scores": stg, "mart_risk_summary": spark.read.parquet(f"{work}/mart_risk_summary"),
              "mart_high_risk_loans": spark.read.parquet(f"{work}/mart_high_risk_loans"),
              "mart_daily_risk_trend": spark.read.parquet(f"{work}/mart_daily_risk_trend")}
    timed("model_tests_12", lambda: quality.model_tests(models).collect())
    timed("quality_suite_28", lambda: quality.run_suite(stg, as_of=views.AS_OF_DATE).collect())
    timed("portfolio_stats", lambda: analytics.portfolio_stats(stg).collect())
    timed("top_critical", lambda: marts.top_critical(stg, 10).collect())
    timed("describe_stats", lambda: analytics.describe_stats(stg).collect())
    timed("corr_matrix", lambda: analytics.corr_matrix(stg).collect())
    timed("state_tier_rollup", lambda: analytics.hierarchy_sum(stg).collect())
    timed("rate_bps", lambda: noop(ingest.rate_changes(testmap.rate_observations(spark, SF_DIR), "ts")))
    timed("macro_snapshots", lambda: noop(ingest.macro_snapshots(testmap.indicator_observations(spark, SF_DIR))))
    timed("county_lookup", lambda: noop(ingest.county_lookup(testmap.census_rows(spark, SF_DIR))))

    # many days at once, box plot, scenarios, streams
    thirty = F.make_date(F.lit(2024), F.lit(4), F.least(F.dayofmonth("landed_date"), F.lit(30)))
    timed("silver_30_days", lambda: lake.write_silver(
        lake.clean_raw(views.raw(spark, SF_DIR), as_of=thirty).drop("landed_date"), f"{work}/silver_days"))
    timed("box_by_type", lambda: analytics.box_stats(stg, by="loan_type_code").collect())
    timed("what_if_sweep", lambda: noop(scenarios.what_if_sweep(stg, [60.0, 80.0, 95.0])))
    for name in ("stream_tier_counts", "stream_hourly_alerts", "stream_quality_watch", "stream_rate_bps"):
        timed(name, lambda name=name: noop(registry.QUERIES[name](spark, SF_DIR)))

    marts_wall = times["stg_view"] + times["mart_risk_summary"] + times["mart_high_risk_loans"] \
        + times["mart_daily_risk_trend"]
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({"metric": "marts_wall_sec", "value": round(marts_wall, 3), "unit": "sec",
                      "queries": times, "total_sec": round(sum(times.values()), 3),
                      "sf": float(m.group(1)) if m else SF_DIR, "cpus": CPUS}))
    spark.stop()


if __name__ == "__main__":
    main()
