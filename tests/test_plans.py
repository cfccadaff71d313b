"""Plan properties every registered batch query must keep at scale."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

BATCH = sorted(n for n in E.queries() if not n.startswith(("stream_", "op")) and n != "pipeline")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pair_explosion_or_python(spark, name):
    plan = physical(E.queries()[name](spark, SF_SMALL))
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name}: {bad}"


def test_top_k_is_take_ordered(spark):
    for name in ("top_critical", "high_risk_head"):
        assert "TakeOrderedAndProject" in physical(E.queries()[name](spark, SF_SMALL))


def test_marts_use_partial_aggregation_and_pruned_scans(spark):
    df = E.queries()["risk_summary"](spark, SF_SMALL)
    plan = physical(df)
    assert "partial_avg" in plan and "partial_count" in plan
    # only the columns the loan view needs are read from lineitem
    assert "l_discount" not in plan and "l_returnflag" not in plan


def test_filters_reach_the_scan(spark, tmp_dir):
    from pyspark.sql import functions as F
    from tierwise.operators import lake, marts
    from tierwise.plans import views
    raw = views.raw(spark, SF_SMALL).drop("landed_date")
    lake.write_gold(lake.score(lake.clean_raw(raw, as_of="2024-04-07")), f"{tmp_dir}/gold")
    gold = spark.read.parquet(f"{tmp_dir}/gold")
    plan = physical(marts.top_critical(gold, 10))
    assert "PushedFilters: [IsNotNull(risk_tier), EqualTo(risk_tier,CRITICAL)]" in plan
    pruned = physical(gold.where(F.col("day") == "07").select("risk_score"))
    assert "PartitionFilters: [isnotnull(day" in pruned and "ReadSchema: struct<risk_score:double>" in pruned


def scans(df) -> int:
    """File scans that run, reused exchanges counted once."""
    df.collect()
    plan = physical(df)
    plan = plan[:plan.index("+- == Initial Plan ==")] if "+- == Initial Plan ==" in plan else plan
    return plan.count("FileScan")


@pytest.mark.parametrize("name", ["describe_stats", "box_by_type", "trend_delta", "critical_count",
                                  "refresh_report", "quality_suite", "portfolio_stats"])
def test_one_scan(spark, name):
    assert scans(E.queries()[name](spark, SF_SMALL)) == 1


@pytest.mark.parametrize("name", ["describe_stats", "box_by_type", "county_lookup"])
def test_no_job_over_rows_while_the_plan_is_built(spark, name):
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", "")
    E.queries()[name](spark, SF_SMALL)
    # the one job reads the table's footer for its schema
    assert len(sc.statusTracker().getJobIdsForGroup(f"build-{name}")) <= 1
    sc.setJobGroup("", "")


def test_rate_changes_read_the_table_twice(spark):
    """Once for the bounds of the ranges, once for the rows; all that follows reads the ranged copy."""
    from tierwise.operators import ordered
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_type", "ts", "value")
    assert physical(ordered.ranged(df, "event_type", ["ts", "value"], "value")).count("FileScan") == 1
    plan = physical(E.queries()["rate_bps"](spark, SF_SMALL))
    assert "events.parquet" not in plan and "rangepartitioning" not in plan


def test_scoring_functions_are_inlined(spark):
    plan = physical(E.queries()["sql_scoring"](spark, SF_SMALL))
    assert "gold_ltv_score" not in plan and "Python" not in plan and "CASE WHEN" in plan


def test_streams_run_no_python_operator():
    import inspect

    from tierwise.streaming import bridge, counters, rates
    for m in (bridge, counters, rates):
        text = inspect.getsource(m)
        assert "InPandas" not in text and "pandas_udf" not in text and "withWatermark" not in text
