"""Silver/gold layout round trip, catalog registration, compaction, sinks."""

import os

from pyspark.sql import functions as F

from tierwise.operators import lake
from tierwise.sources.files import read_silver
from tierwise.plans import views


def test_silver_gold_round_trip(spark, tmp_dir):
    from conftest import SF_SMALL
    raw = views.raw(spark, SF_SMALL).drop("landed_date")
    silver = lake.clean_raw(raw, as_of="2024-04-07")
    lake.write_silver(silver, f"{tmp_dir}/silver")
    assert os.path.isdir(f"{tmp_dir}/silver/year=2024/month=04/day=07")
    back = lake.read_silver_path(spark, f"{tmp_dir}/silver")
    assert back.count() == silver.count()
    assert dict(back.dtypes)["month"] == "string"
    gold = lake.score(back)
    lake.write_gold(gold, f"{tmp_dir}/gold")
    # partition text survives the second hop (no month=4 directories)
    assert os.path.isdir(f"{tmp_dir}/gold/year=2024/month=04/day=07")
    g = read_silver(spark, f"{tmp_dir}/gold", day="2024-04-07")
    assert g.count() == silver.count()
    assert set(["ltv_score", "risk_tier", "loan_id"]) <= set(g.columns)
    assert g.where(F.col("risk_tier").isNull()).count() == 0


def test_select_existing_is_tolerant(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert lake.select_existing(df, ["b", "zz", "a"]).columns == ["b", "a"]


def test_register_layer_and_sql(spark, tmp_dir):
    from conftest import SF_SMALL
    raw = views.raw(spark, SF_SMALL).drop("landed_date")
    gold = lake.score(lake.clean_raw(raw, as_of="2024-04-07"))
    lake.write_gold(gold, f"{tmp_dir}/gold")
    t = lake.register_layer(spark, f"{tmp_dir}/gold", "gold", "risk_scores_t")
    assert t.count() == gold.count()
    n = lake.sql(spark, "SELECT count(*) AS n FROM gold_risk_scores_t WHERE risk_tier = 'CRITICAL'").first().n
    assert n == gold.where("risk_tier = 'CRITICAL'").count()


def test_lookup_dual_sink_and_materialize(spark, tmp_dir):
    df = spark.createDataFrame([("51059", "Fairfax", 0.9)], "county_fips string, county_name string, idx double")
    lake.write_lookup(df, tmp_dir)
    assert spark.read.parquet(f"{tmp_dir}/parquet").count() == 1
    csv = spark.read.option("header", True).csv(f"{tmp_dir}/csv").first()
    assert csv.county_fips == "51059"
    v = lake.materialize(df, "lookup_view", "view")
    assert v.count() == 1
    t = lake.materialize(df, "lookup_tbl", "table", path=f"{tmp_dir}/tbl")
    assert t.count() == 1
    lake.write_report(df, f"{tmp_dir}/report")
    assert spark.read.json(f"{tmp_dir}/report").count() == 1


def test_partition_text_survives_type_inference(spark, tmp_dir):
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        df = spark.createDataFrame([(1.0, "2024", "04", "07")], "v double, year string, month string, day string")
        lake.write_silver(df, f"{tmp_dir}/a")
        back = lake.read_silver_path(spark, f"{tmp_dir}/a")
        assert (back.first().month, back.first().day) == ("04", "07")
        lake.write_gold(back, f"{tmp_dir}/b")
        assert os.path.isdir(f"{tmp_dir}/b/year=2024/month=04/day=07")
        assert read_silver(spark, f"{tmp_dir}/b", day="2024-04-07").first().month == "04"
        assert lake.load_gold(spark, f"{tmp_dir}/b", "loaded_text").first().month == "04"
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
