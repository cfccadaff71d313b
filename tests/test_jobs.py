"""End-to-end jobs on files derived from the supplied tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierwise.operators import lake, marts, versions
from tierwise.plans import jobs, views
from tierwise.sources import testmap


def test_nightly_and_refresh(spark, tmp_dir):
    raw = testmap.raw_loans(spark, SF_SMALL).drop("landed_date")
    # land raw JSON the way the stream landing lays it out (by day)
    landed = raw.withColumns({"year": F.lit("2024"), "month": F.lit("04"), "day": F.lit("07")})
    landed.write.partitionBy("year", "month", "day").json(f"{tmp_dir}/raw")
    out = jobs.nightly(spark, f"{tmp_dir}/raw", f"{tmp_dir}/lake", as_of="2024-04-07",
                       as_of_ts="2024-04-07 06:00:00")
    expected = marts.mart_risk_summary(marts.stg_loan_risk_scores(lake.score(lake.clean_raw(raw, "2024-04-07"))))
    exp = {r.risk_tier: r.loan_count for r in expected.collect()}
    assert {r["risk_tier"]: r["loan_count"] for r in out["summary"]} == exp
    assert out["model_tests_failed"] == 0
    assert out["suite"]["total"] == 28
    rep = spark.read.json(f"{tmp_dir}/lake/reports/layer_report/date=2024-04-07").first()
    assert (rep.raw_check, rep.silver_check, rep.gold_check) == ("PASS", "PASS", "PASS")
    assert rep.warehouse_check.startswith("FAIL: Row count")
    assert out["alerts"] == ["Data Quality Alert! Failed checks: warehouse_check"]
    before_after = {r.risk_tier: (r.before_count, r.after_count)
                    for r in jobs.refresh(spark, f"{tmp_dir}/lake", as_of_ts="2024-04-07 07:00:00").collect()}
    assert sum(b for b, _ in before_after.values()) == sum(a for _, a in before_after.values()) == sum(exp.values())
    after = versions.current(spark, f"{tmp_dir}/lake/scores")
    assert after["version"] == 2
    summary = spark.read.parquet(f"{after['marts']}/mart_risk_summary").collect()
    assert {r.risk_tier: r.loan_count for r in summary} == {t: a for t, (_, a) in before_after.items() if a}
    # a nightly run afterwards is a version of its own
    jobs.nightly(spark, f"{tmp_dir}/raw", f"{tmp_dir}/lake", as_of="2024-04-08")
    assert versions.current(spark, f"{tmp_dir}/lake/scores")["version"] == 3
    assert views.AS_OF_DATE  # views module importable alongside jobs


def test_missing_layer_fails_and_reports_keep_their_dates(spark, tmp_dir):
    from tierwise.operators import quality
    from tierwise.sources import files
    none = quality.check_files(files.list_files(spark, f"{tmp_dir}/nowhere"), layer="raw_check").first()
    assert none.status == "FAIL: no files"
    row = testmap.raw_loans(spark, SF_SMALL).drop("landed_date").limit(50)
    row.write.json(f"{tmp_dir}/raw")
    for day in ("2024-04-07", "2024-04-08"):
        jobs.nightly(spark, f"{tmp_dir}/raw", f"{tmp_dir}/lake", as_of=day)
    assert sorted(str(r.date) for r in spark.read.json(f"{tmp_dir}/lake/reports/layer_report").collect()) == \
        ["2024-04-07", "2024-04-08"]
    assert jobs.nightly(spark, f"{tmp_dir}/raw", f"{tmp_dir}/lake")["suite"]["total"] == 28       # today by default
