"""Small source/sink/projection helpers."""

import os
import re

from pyspark.sql import functions as F

from tierwise.functions.cleaning import iso_now, to_day, zero_if_null
from tierwise.operators import analytics, lake, marts
from tierwise.sources import files


def test_read_rates_from_start(spark, tmp_dir):
    p = os.path.join(tmp_dir, "rates.csv")
    with open(p, "w") as f:
        f.write("series_id,date,value\nDGS10,2019-12-31,1.9\nDGS10,2020-01-02,1.88\nDGS10,2020-01-03,.\n")
    rows = files.read_rates(spark, p).collect()
    assert [(r.date, r.value) for r in rows] == [("2020-01-02", "1.88"), ("2020-01-03", ".")]


def test_catalog_sample_fold_and_load(spark, tmp_dir):
    df = spark.createDataFrame([(i, "x") for i in range(50)], "Loan_Amount int, Risk_Tier string")
    df.createOrReplaceTempView("loan_risk_scores_t")
    assert files.table(spark, "loan_risk_scores_t").count() == 50
    assert files.ref(spark, "loan_risk_scores_t").count() == files.source(spark, "loan_risk_scores_t").count()
    assert files.sample_rows(df, 10).count() == 10
    assert files.fold_names(df).columns == ["loan_amount", "risk_tier"]
    assert files.fold_names(df, "upper").columns == ["LOAN_AMOUNT", "RISK_TIER"]
    df.write.parquet(f"{tmp_dir}/gold")
    assert lake.load_gold(spark, f"{tmp_dir}/gold", "loan_risk_scores_loaded").count() == 50


def test_iso_now_to_day_zero_default(spark):
    r = spark.range(1).select(iso_now().alias("t"), to_day(F.lit("2024-04-07 10:00:00").cast("timestamp")).alias("d"),
                              zero_if_null(F.lit(None).cast("int")).alias("z")).first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}", r.t)
    assert str(r.d) == "2024-04-07" and r.z == 0


def test_lookup_order_and_preview(spark):
    df = spark.createDataFrame([("L1", 0.9, "CRITICAL"), ("L2", 0.5, "MEDIUM"), ("L3", 0.7, "HIGH")],
                               "loan_id string, risk_score double, risk_tier string")
    assert marts.loan_by_id(df, "L3").first().risk_tier == "HIGH"
    assert [r.loan_id for r in marts.ordered(df, [F.col("risk_score").desc()]).collect()] == ["L1", "L3", "L2"]
    dist = analytics.tier_distribution(df)
    assert [r.risk_tier for r in marts.ordered(dist, [F.desc("loan_count"), "risk_tier"]).collect()][0] == "CRITICAL"
    assert analytics.preview(df, 2, ["loan_id", "risk_tier"]).count() == 2
    assert analytics.preview(df).count() == 3
    b = analytics.bounds(df, ["risk_score"]).first()
    assert (b.min_risk_score, b.max_risk_score) == (0.5, 0.9)
    assert analytics.row_count(df).first().total == 3


def test_kafka_source_needs_connector(spark):
    """One subscription over all topics; this image has no Kafka connector jar,
    so loading must fail with Spark's missing-data-source error (nothing else)."""
    import pytest
    from tierwise.streaming import bridge
    with pytest.raises(Exception, match="(?i)kafka"):
        bridge.read_topics(spark, max_offsets=100)


def test_parse_events(spark):
    from tierwise.schemas import RAW_LOAN
    from tierwise.streaming import bridge
    df = spark.createDataFrame([('{"loan_amount": "1", "ltv": "80"}',), ("{bad",)], "value string")
    rows = bridge.parse_events(df, RAW_LOAN).collect()
    assert (rows[0].loan_amount, rows[0].ltv, rows[0]._ok) == ("1", "80", True)
    assert rows[1]._ok is False and rows[1].loan_amount is None
