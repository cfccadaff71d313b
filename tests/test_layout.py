"""The clustered layer: same answers, few row groups read."""

from pyspark.sql import functions as F

from conftest import SF_CHECK
from tierwise.operators import analytics, layout, marts
from tierwise.plans import maintained, views


def rows_read(df) -> int:
    """Rows that the scan took from row groups it didn't rule out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookups_and_segments_read_few_rows(spark, tmp_dir):
    stg = views.stg(spark, SF_CHECK)
    total = stg.count()
    layout.write_clustered(stg, f"{tmp_dir}/c", maintained.CLUSTER_BY, "loan_id", files=16, group_bytes=20_000, distinct_keys=2000)
    there = spark.read.parquet(f"{tmp_dir}/c")
    assert there.count() == total
    stg.repartition(16).write.parquet(f"{tmp_dir}/plain")
    plain = spark.read.parquet(f"{tmp_dir}/plain")
    some = [r.loan_id for r in stg.select("loan_id").orderBy(F.xxhash64("loan_id")).limit(5).collect()]
    for loan in some:
        found = marts.loan_by_id(there, loan)
        assert found.count() == stg.where(F.col("loan_id") == loan).count()
        assert rows_read(found) <= total / 4
    narrow = lambda df: df.where((F.col("state") == "VA") & F.col("loan_amount").between(20000.0, 24000.0))      # noqa: E731
    assert narrow(there).count() == narrow(stg).count()
    assert rows_read(narrow(there)) <= total / 3 < rows_read(narrow(plain))
    critical = there.where((F.col("risk_score") > 0.75) & (F.col("state") == "MD"))
    assert rows_read(critical) <= total / 2


def test_results_are_those_of_the_plain_layer(spark, tmp_dir):
    stg = views.stg(spark, SF_CHECK)
    layout.write_clustered(stg, f"{tmp_dir}/c", maintained.CLUSTER_BY, "loan_id", files=5)
    there = spark.read.parquet(f"{tmp_dir}/c")
    assert {f for f in there.columns} == {f for f in stg.columns}
    a, b = (analytics.segment(x, ("VA",), (10000.0, 60000.0)).select("loan_id", "risk_tier") for x in (there, stg))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_cell_and_nulls_are_spread(spark):
    df = spark.range(9000).select(F.concat(F.lit("k"), "id").alias("key"), F.when(F.col("id") % 3 > 0, 1.0).alias("v"),
                                  F.lit("same").alias("s"))
    placed = layout.curve(df, ["v", "s"])
    parts = placed.repartitionByRange(9, "_curve", "v", "key").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(parts) == 9 and max(r["count"] for r in parts) < 3000
