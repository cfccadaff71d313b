"""Quality suite, model tests, table/file checks and reports."""

from pyspark.sql import functions as F

from tierwise.operators import quality
from tierwise.operators.quality import REFERENCE_SUITE


def _gold(spark, rows):
    return spark.createDataFrame(rows, "loan_amount float, ltv float, dti double, interest_rate float, "
                                       "income float, ltv_score double, dti_score double, rate_spread_score double, "
                                       "macro_stress_score double, risk_score double, risk_tier string, "
                                       "processing_date date")


def test_suite_counts_and_one_row_per_check(spark):
    import datetime as dt
    d = dt.date(2024, 1, 10)
    good = (200000.0, 80.0, 40.0, 5.0, 90.0, .5, .5, .5, .6, .52, "MEDIUM", d)
    bad = (None, 210.0, None, 31.0, 1.0, .5, .5, .5, .6, 1.2, "WEIRD", d)
    res = quality.run_suite(_gold(spark, [good] * 150 + [bad]), as_of="2024-01-20")
    rows = {r.check: r for r in res.collect()}
    assert len(rows) == len(REFERENCE_SUITE) == 28
    assert rows["not_null:loan_amount"].unexpected_count == 1
    assert rows["between:ltv"].unexpected_count == 1 and not rows["between:ltv"].passed
    assert rows["between:dti"].passed                      # nulls are ignored by range checks
    assert rows["in_set:risk_tier"].unexpected_count == 1
    assert rows["row_count:table"].passed and rows["fresh:processing_date"].observed == 10.0
    s = quality.summarize(res).first()
    assert s.total == 28 and s.passed + s.failed == 28
    assert s.success_rate == round(s.passed / 28 * 100, 1)


def test_missing_column_fails_exists(spark):
    df = spark.createDataFrame([(1.0, "LOW")], "risk_score double, risk_tier string")
    rows = {r.check: r for r in quality.run_suite(df, as_of="2024-01-01").collect()}
    assert rows["exists:risk_score"].passed and not rows["exists:loan_amount"].passed


def test_empty_results_summary(spark):
    empty = spark.createDataFrame([], "passed boolean")
    s = quality.summarize(empty).first()
    assert (s.total, s.passed, s.failed, s.success_rate) == (0, 0, 1, 0.0)


def test_model_tests_flag_failures(spark):
    stg = spark.createDataFrame([(0.5, "LOW", 1.0), (None, "HIGH", 2.0), (0.9, "BAD", None)],
                                "risk_score double, risk_tier string, loan_amount double")
    models = {"stg_loan_risk_scores": stg, "mart_risk_summary": stg.groupBy("risk_tier").count(),
              "mart_high_risk_loans": stg.where("risk_tier IN ('HIGH','LOW')"),
              "mart_daily_risk_trend": stg.select("risk_tier")}
    res = {(r.model, r.column, r.test): r for r in quality.model_tests(models).collect()}
    assert len(res) == 12
    assert res[("stg_loan_risk_scores", "risk_score", "not_null")].failures == 1
    assert res[("stg_loan_risk_scores", "risk_tier", "accepted_values")].status == "FAIL"
    assert res[("mart_high_risk_loans", "risk_tier", "accepted_values")].failures == 1


def test_table_check_collects_all_errors(spark):
    import datetime as dt
    df = spark.createDataFrame([(None, "LOW", dt.date(2024, 1, 1)), (0.3, None, dt.date(2024, 1, 2))],
                               "risk_score double, risk_tier string, processing_date date")
    r = quality.check_table(df, as_of="2024-01-03").first()
    assert r.status.startswith("FAIL: Row count 2 is not > 100000")
    assert "NULL risk_score" in r.status and "invalid risk_tier" not in r.status
    assert "Max processing_date 2024-01-02 != 2024-01-03" in r.status


def test_files_report_and_alerts(spark):
    files = spark.createDataFrame([("s3://b/loans/a.parquet", 10, "2020-01-01 00:00:00"),
                                   ("s3://b/loans/b.json", 2 * 1024 ** 3, "2020-01-01 00:00:00"),
                                   ("s3://b/loans/c.parquet", 5, "2024-01-01 00:00:00")],
                                  "path string, length long, modificationTime string").withColumn(
        "modificationTime", F.to_timestamp("modificationTime"))
    assert quality.check_files(files, ext=".parquet").first().status == "PASS"
    assert quality.check_files(files, min_bytes=10 * 1024 ** 3).first().status.startswith("FAIL")
    assert quality.check_files(files.where("false")).first().status == "FAIL: no files"
    assert quality.older_than(files, 30, "2024-01-15").count() == 2
    assert quality.with_suffix(files).count() == 2
    rep = quality.storage_report(files, 30, "2024-01-15").first()
    assert rep.month == "2024-01" and rep.gb_archived == round((2 * 1024 ** 3 + 10) / 1024 ** 3, 4)
    statuses = spark.createDataFrame([("raw_check", "PASS"), ("gold_check", "FAIL: x")], "layer string, status string")
    report = quality.layer_report(statuses, date="2024-01-15")
    r = report.first()
    assert (r.raw_check, r.silver_check, r.gold_check) == ("PASS", "FAIL", "FAIL: x")
    msg = quality.quality_alerts(report).first().message
    assert msg == "Data Quality Alert! Failed checks: silver_check, gold_check, warehouse_check"


def test_suite_on_empty_input_does_not_raise(spark):
    empty = _gold(spark, [])
    rows = {r.check: r for r in quality.run_suite(empty, as_of="2024-01-01").collect()}
    assert rows["share_between:risk_tier=LOW"].observed == 0.0 and rows["share_between:risk_tier=LOW"].passed
    assert not rows["row_count:table"].passed and rows["mean_between:risk_score"].observed is None
    assert quality.summarize(quality.run_suite(empty, as_of="2024-01-01")).first().total == 28
