"""End-to-end jobs composed from the operators (the reference's nightly lake
run and its macro refresh), each a short sequence of Spark actions.

Every write goes to a path under ``root`` (a shared folder on a cluster);
stages read back what the previous stage wrote, so each stage restarts from
durable files after a failure and lineage never spans the whole run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lake, marts, quality, scenarios, versions
from ..sources import files

MART_BUILDERS = {
    "mart_risk_summary": marts.mart_risk_summary,
    "mart_high_risk_loans": marts.mart_high_risk_loans,
    "mart_daily_risk_trend": marts.mart_daily_risk_trend,
}


def build_models(spark: SparkSession, gold: DataFrame, root: str, as_of_ts: str | None = None) -> dict:
    """Staging view (K8) + the three marts as rewritten tables (K7) + model tests."""
    stg = lake.materialize(marts.stg_loan_risk_scores(gold, as_of_ts=as_of_ts), "stg_loan_risk_scores", "view")
    models = {"stg_loan_risk_scores": stg}
    for name, build in MART_BUILDERS.items():
        models[name] = lake.materialize(build(stg), name, "table", path=f"{root}/marts/{name}")
    return models


def nightly(spark: SparkSession, raw_path: str, root: str, as_of: str | None = None,
            as_of_ts: str | None = None, min_raw_bytes: int = 0) -> dict:
    """Raw JSON -> silver (K1) -> gold (K2) -> warehouse view -> staging + marts
    -> 12 model tests -> 28-check suite -> layer report and alerts (Q13-Q17).

    ``as_of`` is the run date, today by default. Every report is kept under its
    date (``reports/<name>/date=<as_of>``). Returns small summaries."""
    as_of = as_of or str(spark.sql("SELECT current_date()").first()[0])
    raw = files.read_raw(spark, raw_path)
    lake.write_silver(lake.clean_raw(raw, as_of), f"{root}/silver", one_day=True)
    silver = lake.read_silver_path(spark, f"{root}/silver")
    lake.write_gold(lake.score(silver), f"{root}/gold", one_day=True)
    gold = lake.read_silver_path(spark, f"{root}/gold")
    if versions.current(spark, f"{root}/scores") is not None:
        versions.create(spark, f"{root}/scores", gold)          # what refreshes start from
    models = build_models(spark, gold, root, as_of_ts)

    def report(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/reports/{name}/date={as_of}"
        lake.write_report(df, path)
        return spark.read.schema(df.schema).json(path)

    tests = report(quality.model_tests(models), "model_tests")
    suite = report(quality.run_suite(models["stg_loan_risk_scores"], as_of=as_of), "quality_suite")
    layers = [quality.check_files(files.list_files(spark, raw_path), min_raw_bytes, layer="raw_check"),
              quality.check_files(files.list_files(spark, f"{root}/silver"), 0, ".parquet", layer="silver_check"),
              quality.check_files(files.list_files(spark, f"{root}/gold"), layer="gold_check"),
              quality.check_table(models["stg_loan_risk_scores"], as_of=as_of)
              .select(F.lit("warehouse_check").alias("layer"), "status")]
    statuses = files.union_all([x.select("layer", "status") for x in layers])
    layer = report(quality.layer_report(statuses, date=as_of), "layer_report")
    alerts = report(quality.quality_alerts(layer), "alerts")
    return {
        "summary": [r.asDict() for r in spark.read.parquet(f"{root}/marts/mart_risk_summary").collect()],
        "model_tests_failed": tests.where("status = 'FAIL'").count(),
        "suite": quality.summarize(suite).first().asDict(),
        "alerts": [r["message"] for r in alerts.collect()],
    }


def refresh(spark: SparkSession, root: str, macro: float | Column | None = None,
            as_of_ts: str | None = None) -> DataFrame:
    """The next version of the scored layer with a new macro score, all marts built from it before the
    pointer moves, and the tier counts of the versions before and after.

    The first refresh takes ``root/gold`` as version 1. Layer and marts live under ``root/scores``; the log entry of a
    version names its marts, so a reader of the pointer never sees one without the other."""
    at = f"{root}/scores"
    if versions.current(spark, at) is None:
        versions.create(spark, at, lake.read_silver_path(spark, f"{root}/gold"))
    before = versions.current(spark, at)

    def marts_of(rows: DataFrame, entry: dict) -> dict:
        place = f"{at}/marts/{entry['manifest']}"
        build_models(spark, rows, place, as_of_ts)
        return {"marts": f"{place}/marts"}

    after = versions.rewrite(spark, at, lambda df: scenarios.refresh_scores(df, macro), "refresh", marts_of)
    return versions.compare(spark, at, before["version"], after["version"])
