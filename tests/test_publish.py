"""Write, audit, publish; the crawl; scoring functions in SQL."""

import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierwise.functions import scoring, sql_functions
from tierwise.operators import catalog, lake, quality, versions
from tierwise.plans import maintained, views
from tierwise.policies import API, GOLD, TESTS


def test_a_bad_file_is_held_back_and_the_others_are_read(spark, tmp_dir):
    root = f"{tmp_dir}/p"
    gold = maintained.monthly_gold(spark, SF_SMALL)
    months = [r.month for r in gold.select("month").distinct().orderBy("month").collect()]
    bad = gold.where(F.col("month") == months[0]).withColumn("risk_score", F.lit(7.0))
    e = versions.publish(spark, root, gold.where(F.col("month") != months[0]).unionByName(bad))
    assert e["version"] == 1
    there = versions.read(spark, root)
    assert {r.month for r in there.select("month").distinct().collect()} == set(months[1:])
    books = versions.ledger(spark, root)
    held = books.where(F.size("failed") > 0)
    assert {tuple(r.failed) for r in held.collect()} == {("between:risk_score",)}
    assert held.agg(F.sum("n_rows")).first()[0] == bad.count()
    whole = quality.run_suite(there, as_of=views.AS_OF_DATE).drop("layer").collect()
    merged = quality.finish_suite(books.where(F.size("failed") == 0), there.columns, as_of=views.AS_OF_DATE).drop("layer").collect()
    assert [(r.check_id, r.passed, r.unexpected_count, round(r.observed or 0, 6)) for r in merged] == \
        [(r.check_id, r.passed, r.unexpected_count, round(r.observed or 0, 6)) for r in whole]
    tiers = {r.risk_tier: r.after_count for r in versions.compare(spark, root, 1, 1).collect()}
    assert tiers == {r.risk_tier: r["count"] for r in there.groupBy("risk_tier").count().collect()}
    # a delivery of bad files only changes nothing
    assert versions.publish(spark, root, bad)["version"] == 1 and versions.read(spark, root).count() == there.count()
    # a missing column breaks its checks in every file
    assert versions.publish(spark, f"{tmp_dir}/q", gold.drop("risk_tier")) == {}


def test_crawl_adds_what_is_new_and_logs_what_is_gone(spark, tmp_dir):
    gold = lake.score(lake.clean_raw(views.raw(spark, SF_SMALL).drop("landed_date"), as_of="2024-04-07"))
    path, name = f"{tmp_dir}/g", "crawl_t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    lake.write_gold(gold, path)
    assert [tuple(r) for r in catalog.crawl(spark, path, name).collect()] == [("table created", name), ("partition added", "2024-04-07")]
    assert catalog.crawl(spark, path, name).count() == 0
    n = spark.table(name).count()
    more = lake.with_partition_cols(gold.withColumn("processing_date", F.lit("2024-04-08").cast("date")).withColumn("note", F.lit("x")))
    lake.write_gold(more, path, mode="append")
    assert [tuple(r) for r in catalog.crawl(spark, path, name).collect()] == [("column added", "note"), ("partition added", "2024-04-08")]
    t = spark.table(name)
    assert t.count() == 2 * n and t.where("note = 'x'").count() == n and t.where("day = '07'").count() == n
    shutil.rmtree(f"{path}/year=2024/month=04/day=07")
    assert [tuple(r) for r in catalog.crawl(spark, path, name).collect()] == [("partition vanished", "2024-04-07")]
    assert [tuple(r) for r in catalog.crawl(spark, path, name, "drop").collect()] == [("partition dropped", "2024-04-07")]
    assert catalog.crawl(spark, path, name).count() == 0 and spark.table(name).count() == n
    with pytest.raises(ValueError):
        catalog.crawl(spark, path, name, "keep")


@pytest.mark.parametrize("policy", [GOLD, API, TESTS])
def test_sql_functions_score_like_the_policy(spark, policy):
    values = [None, 0.0, 35.9, 36.0, 43.0, 43.1, 50.0, 51.0, 79.9, 80.0, 90.0, 90.1, 95.0, 95.1, 4.0, 6.0, 8.0, 8.1]
    df = spark.createDataFrame([(a, b, c) for a in values for b in values[:9] for c in values[13:] + [None]],
                               "ltv double, dti double, interest_rate double")
    sql_functions.register(spark, policy, "p")
    df.createOrReplaceTempView("policy_rows")
    got = spark.sql(sql_functions.scored_select(policy, "policy_rows", "ltv, dti, interest_rate", "p"))
    want = scoring.apply_score(df, policy)
    cols = ["ltv", "dti", "interest_rate", "risk_score", "risk_tier"]
    assert got.select(cols).exceptAll(want.select(cols)).isEmpty() and got.count() == want.count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Scan") == 1
