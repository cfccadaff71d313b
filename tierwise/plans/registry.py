"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the whole supplied tables (no id subsets, no row caps
except where a limit is the feature) and returns an unevaluated DataFrame.
Output columns are aliased to match ``plans.oracle.SQL``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import analytics, ingest, lake, marts, quality, scenarios
from ..policies import API
from ..session import scratch_path
from ..sources import files as file_sources
from ..sources import testmap
from . import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def canonical(df: DataFrame) -> DataFrame:
    """Dates and timestamps as canonical text (``YYYY-MM-DD``,
    ``YYYY-MM-DD HH:MM:SS.ffffff``) so results compare byte-for-byte across
    engines; every other column is left as is."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t == "date":
            out.append(F.col(f.name).cast("string").alias(f.name))
        elif t in ("timestamp", "timestamp_ntz"):
            out.append(F.date_format(F.col(f.name), TS_TEXT).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def register(name: str):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: canonical(_fn(spark, sf_dir))
        return fn
    return deco


def r6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def dbl(c: str) -> Column:
    return F.col(c).cast("double").alias(c)


# ------------------------------------------------------------ lake layers

@register("silver_loans")
def q_silver_loans(spark, sf_dir):
    s = views.silver(spark, sf_dir)
    return s.select("loan_id", "state", "action_taken", "loan_type", "processing_date",
                    dbl("loan_amount"), dbl("ltv"), r6("dti").alias("dti"),
                    dbl("interest_rate"), dbl("income"))


@register("gold_scores")
def q_gold_scores(spark, sf_dir):
    g = views.gold(spark, sf_dir)
    return g.select("loan_id", "ltv_score", "dti_score", "rate_spread_score", "macro_stress_score",
                    r6("risk_score").alias("risk_score"), "risk_tier", "processing_date")


# ------------------------------------------------------------ marts

@register("risk_summary")
def q_risk_summary(spark, sf_dir):
    m = marts.mart_risk_summary(views.stg(spark, sf_dir))
    return m.select("risk_tier", "loan_count", *[r6(c).alias(c) for c in m.columns[2:]])


@register("high_risk_loans")
def q_high_risk_loans(spark, sf_dir):
    h = marts.mart_high_risk_loans(views.stg(spark, sf_dir))
    return h.select("loan_id", r6("risk_score").alias("risk_score"), "risk_tier",
                    dbl("loan_amount"), "processing_date", "action_code", "loan_type_code")


@register("daily_trend")
def q_daily_trend(spark, sf_dir):
    d = marts.mart_daily_risk_trend(views.stg(spark, sf_dir))
    return d.select("processing_date", "risk_tier", "loan_count",
                    r6("avg_risk_score").alias("avg_risk_score"))


# ------------------------------------------------------------ analytics


PCT_RANK_PROBES = [0.3, 0.45, 0.52, 0.6, 0.75, 0.85]
SEGMENT_STATES = ("VA", "MD")
SEGMENT_AMOUNT = (10000.0, 60000.0)


@register("portfolio_stats")
def q_portfolio_stats(spark, sf_dir):
    return analytics.portfolio_stats(views.stg(spark, sf_dir))


@register("tier_distribution")
def q_tier_distribution(spark, sf_dir):
    t = analytics.tier_distribution(views.stg(spark, sf_dir))
    return t.select("risk_tier", "loan_count", r6("share").alias("share"))


@register("totals_bounds")
def q_totals_bounds(spark, sf_dir):
    t = analytics.totals(views.stg(spark, sf_dir))
    return t.select("total_loans", r6("mean_risk_score").alias("mean_risk_score"),
                    F.round("total_amount", 2).alias("total_amount"), "min_date", "max_date",
                    "min_amount", "max_amount")


@register("top_critical")
def q_top_critical(spark, sf_dir):
    t = marts.top_critical(views.stg(spark, sf_dir), limit=10)
    return t.select("loan_id", r6("risk_score").alias("risk_score"), "risk_tier", dbl("loan_amount"),
                    dbl("ltv"), r6("dti").alias("dti"), dbl("interest_rate"))


@register("high_risk_head")
def q_high_risk_head(spark, sf_dir):
    h = marts.high_risk_head(views.stg(spark, sf_dir), n=100)
    return h.select("loan_id", r6("risk_score").alias("risk_score"), "risk_tier", dbl("loan_amount"))


@register("segment_filter")
def q_segment_filter(spark, sf_dir):
    s = analytics.segment(views.stg(spark, sf_dir), SEGMENT_STATES, SEGMENT_AMOUNT)
    return s.select("loan_id", "state", dbl("loan_amount"), "risk_tier")


@register("describe_stats")
def q_describe_stats(spark, sf_dir):
    d = analytics.describe_stats(views.stg(spark, sf_dir))
    return d.select(F.col("column").alias("metric"), "count",
                    *[r6(c).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


@register("corr_matrix")
def q_corr_matrix(spark, sf_dir):
    c = analytics.corr_matrix(views.stg(spark, sf_dir))
    return c.select("a", "b", r6("corr").alias("corr"))


@register("daily_stats")
def q_daily_stats(spark, sf_dir):
    d = analytics.daily_stats(views.stg(spark, sf_dir))
    return d.select("date", r6("mean").alias("mean"), r6("max").alias("max"), r6("min").alias("min"))


@register("trend_delta")
def q_trend_delta(spark, sf_dir):
    t = analytics.trend_delta(analytics.daily_stats(views.stg(spark, sf_dir)))
    return t.select("latest_date", *[r6(c).alias(c) for c in t.columns[1:]])


@register("state_tier_rollup")
def q_state_tier_rollup(spark, sf_dir):
    h = analytics.hierarchy_sum(views.stg(spark, sf_dir))
    return h.select("state", "risk_tier", F.round("total_amount", 2).alias("total_amount"), "level")


@register("box_by_type")
def q_box_by_type(spark, sf_dir):
    b = analytics.box_stats(views.stg(spark, sf_dir), by="loan_type_code")
    return b.select("loan_type_code", "n", *[r6(c).alias(c) for c in
                    ("min", "q1", "median", "q3", "max", "lower_fence", "upper_fence",
                     "whisker_low", "whisker_high")], "outliers")


@register("pct_rank")
def q_pct_rank(spark, sf_dir):
    p = analytics.percentile_rank(views.stg(spark, sf_dir), PCT_RANK_PROBES)
    return p.select("score", r6("pct_rank").alias("pct_rank"))


@register("exposure_by_tier")
def q_exposure_by_tier(spark, sf_dir):
    e = analytics.exposure_by_tier(views.stg(spark, sf_dir))
    return e.select("risk_tier", "loan_count", r6("avg_amount").alias("avg_amount"),
                    r6("exposure_billions").alias("exposure_billions"))


# ------------------------------------------------------------ ingest



@register("rate_bps")
def q_rate_bps(spark, sf_dir):
    r = ingest.rate_changes(testmap.rate_observations(spark, sf_dir), order_col="ts")
    return r.select("series_id", "ts", "value", r6("rate_change_bps").alias("rate_change_bps"))


@register("macro_snapshots")
def q_macro_snapshots(spark, sf_dir):
    m = ingest.macro_snapshots(testmap.indicator_observations(spark, sf_dir))
    return m.select("date", *[r6(c).alias(c) for c in
                              ("fed_funds_rate", "treasury_yield_10yr", "unemployment_rate", "cpi",
                               "macro_stress_index")])


@register("county_lookup")
def q_county_lookup(spark, sf_dir):
    c = ingest.county_lookup(testmap.census_rows(spark, sf_dir))
    return c.select("county_fips", "county_name", *[r6(x).alias(x) for x in
                    ("median_home_value", "median_income", "owner_occupied_units")],
                    "state_code", r6("county_risk_index").alias("county_risk_index"))


# ------------------------------------------------------------ scenarios

WHAT_IF_LTV = 75.0


@register("api_scores")
def q_api_scores(spark, sf_dir):
    valid, _ = scenarios.validate_input(views.silver(spark, sf_dir))
    s = scenarios.score_loans(valid, API, scored_at=views.AS_OF_TS)
    return s.select("loan_id", "ltv_score", "dti_score", "rate_spread_score",
                    r6("risk_score").alias("risk_score"), "risk_tier", "recommendation")


@register("validated_input")
def q_validated_input(spark, sf_dir):
    s = views.silver(spark, sf_dir).withColumn("reasons", scenarios.rejection_reasons())
    return s.select("loan_id", F.size("reasons").alias("n_reasons"),
                    F.concat_ws(";", "reasons").alias("reasons"))


@register("refreshed_scores")
def q_refreshed_scores(spark, sf_dir):
    r = scenarios.refresh_scores(views.gold(spark, sf_dir))
    return r.select("loan_id", r6("macro_stress_score").alias("macro_stress_score"),
                    r6("risk_score").alias("risk_score"), "risk_tier")


@register("refresh_report")
def q_refresh_report(spark, sf_dir):
    return scenarios.refresh_preview(views.gold(spark, sf_dir))


@register("continuous_scores")
def q_continuous_scores(spark, sf_dir):
    c = scenarios.continuous_scores(views.stg(spark, sf_dir))
    return c.select("loan_id", r6("continuous_score").alias("continuous_score"), "continuous_tier")


@register("contributions")
def q_contributions(spark, sf_dir):
    c = scenarios.factor_contributions(marts.high_risk(views.stg(spark, sf_dir)))
    return c.select("loan_id", "factor", r6("impact").alias("impact"))


@register("what_if")
def q_what_if(spark, sf_dir):
    w = scenarios.what_if(views.stg(spark, sf_dir), WHAT_IF_LTV)
    return w.select("loan_id", "risk_tier", r6("new_score").alias("new_score"), "new_tier", "tier_changed")


@register("rate_hike")
def q_rate_hike(spark, sf_dir):
    r = scenarios.rate_hike(views.stg(spark, sf_dir))
    return r.select("hike", r6("mean_score").alias("mean_score"), r6("impacted_score").alias("impacted_score"))


@register("critical_count")
def q_critical_count(spark, sf_dir):
    return scenarios.critical_count(views.stg(spark, sf_dir))


@register("hourly_alerts")
def q_hourly_alerts(spark, sf_dir):
    c = scenarios.hourly_counts(views.stg(spark, sf_dir), "ingestion_timestamp")
    return scenarios.hourly_delta(c)


# ------------------------------------------------------------ quality



@register("quality_suite")
def q_quality_suite(spark, sf_dir):
    r = quality.run_suite(views.stg(spark, sf_dir), quality.REFERENCE_SUITE, as_of=views.AS_OF_DATE)
    return r.select("check_id", "check", F.col("column").alias("target"), r6("observed").alias("observed"),
                    "passed", "unexpected_count")


@register("quality_summary")
def q_quality_summary(spark, sf_dir):
    r = quality.run_suite(views.stg(spark, sf_dir), quality.REFERENCE_SUITE, as_of=views.AS_OF_DATE)
    return quality.summarize(r)


@register("model_tests")
def q_model_tests(spark, sf_dir):
    """Q11 + Q12 on the models' own rows: the staging rows and the three marts as they are built."""
    stg = views.stg(spark, sf_dir)
    return quality.model_tests({"stg_loan_risk_scores": stg, "mart_risk_summary": marts.mart_risk_summary(stg),
                                "mart_high_risk_loans": marts.mart_high_risk_loans(stg),
                                "mart_daily_risk_trend": marts.mart_daily_risk_trend(stg)})


@register("warehouse_check")
def q_warehouse_check(spark, sf_dir):
    return quality.check_table(views.stg(spark, sf_dir), as_of=views.AS_OF_DATE)


@register("file_checks")
def q_file_checks(spark, sf_dir):
    """Q13/Q14/A19 over the table files themselves (listing only; no file body read)."""
    files = file_sources.list_files(spark, sf_dir, glob="*.parquet", recursive=False)
    raw = quality.check_files(files.where(F.col("path").endswith("/lineitem.parquet")), 1024 * 1024, layer="raw_check")
    silver = quality.check_files(files, 0, ".parquet", layer="silver_check")
    gold = quality.check_files(files, 0, None, layer="gold_check")
    return raw.unionByName(silver).unionByName(gold)


@register("layer_report")
def q_layer_report(spark, sf_dir):
    """Q13-Q17 + F16: checks on the rows of every layer -> one report row + alert text."""
    layers = [quality.check_rows(views.raw(spark, sf_dir), "raw_check"),
              quality.check_rows(views.silver(spark, sf_dir), "silver_check"),
              quality.check_rows(views.gold(spark, sf_dir), "gold_check"),
              quality.check_table(views.stg(spark, sf_dir), as_of=views.AS_OF_DATE)
              .select(F.lit("warehouse_check").alias("layer"), "status")]
    statuses = file_sources.union_all([x.select("layer", "status") for x in layers])
    rep = quality.layer_report(statuses, date=views.AS_OF_DATE)
    alert = quality.quality_alerts(rep).select("message").scalar()
    return rep.withColumn("alert", F.coalesce(alert, F.lit("")))


@register("storage_report")
def q_storage_report(spark, sf_dir):
    """F12/A20 over the table files (age measured against a fixed future date)."""
    files = file_sources.list_files(spark, sf_dir, glob="*.parquet", recursive=False)
    return quality.storage_report(files, days=30, as_of="2100-01-01")


# ------------------------------------------------------------ more sources / scenarios


WHAT_IF_SWEEP = [60.0, 80.0, 95.0]


@register("loan_events_csv")
def q_loan_events_csv(spark, sf_dir):
    """S3 + F3 + P6/P7: loans landed as the public register's header CSV, read back
    as text, empty amount/LTV rows skipped, renamed to the 13-field event."""
    raw = testmap.raw_loans(spark, sf_dir)
    csv = raw.select("loan_amount", "loan_type", "action_taken", F.col("ltv").alias("loan_to_value_ratio"),
                     F.col("dti").alias("debt_to_income_ratio"), "income", "interest_rate", "denial_reason_1",
                     F.col("state").alias("state_code"), "county_code", "property_value")
    path = scratch_path(spark, "loans-csv")
    csv.write.mode("overwrite").option("header", True).csv(path)
    ev = ingest.loan_event(file_sources.read_loans_csv(spark, path), ingested_at=F.lit(views.AS_OF_TS))
    return ev.select("loan_amount", "loan_type", "action_taken", "ltv", "dti", "income", "interest_rate",
                     "state", "county_code", "event_type")


@register("what_if_sweep")
def q_what_if_sweep(spark, sf_dir):
    w = scenarios.what_if_sweep(views.stg(spark, sf_dir), WHAT_IF_SWEEP)
    return w.select("loan_id", "scenario_ltv", r6("new_score").alias("new_score"), "new_tier", "tier_changed")


@register("catalog_sql")
def q_catalog_sql(spark, sf_dir):
    """K2 + K10 + K11: gold written for one run date to the shared folder,
    registered as a partitioned table (schema from the files, partitions
    recovered), then answered with SQL over the catalog."""
    path = scratch_path(spark, "gold-catalog")
    raw = testmap.raw_loans(spark, sf_dir).drop("landed_date")
    lake.write_gold(lake.score(lake.clean_raw(raw, as_of=views.AS_OF_DATE)), path, one_day=True)
    name = "risk_scores_" + path.rsplit("-", 1)[-1]
    lake.register_layer(spark, path, "gold", name)
    return lake.sql(spark, f"SELECT risk_tier, count(*) AS loan_count, "
                           f"round(avg(risk_score), 6) AS avg_risk_score FROM gold_{name} GROUP BY risk_tier")


@register("tests_policy_scores")
def q_tests_policy_scores(spark, sf_dir):
    """The unit-test policy (exclusive bands, score rounded to 3 places, cuts
    .3/.6/.8, short recommendation texts) over the validated loans."""
    from ..policies import RECOMMENDATIONS_SHORT, TESTS
    valid, _ = scenarios.validate_input(views.silver(spark, sf_dir))
    s = scenarios.score_loans(valid, TESTS, scored_at=views.AS_OF_TS, texts=RECOMMENDATIONS_SHORT)
    return s.select("loan_id", r6("risk_score").alias("risk_score"), "risk_tier", "recommendation")


# ------------------------------------------------------------ landed files, lake round trip, segments


@register("county_from_arrays")
def q_county_from_arrays(spark, sf_dir):
    """S4 -> county dimension: census rows landed as header-row JSON arrays, one per block of 1000 keys."""
    names = ["NAME", "B25077_001E", "B19013_001E", "B25003_002E", "state", "county"]
    rows = testmap.census_rows(spark, sf_dir)
    block = F.floor(F.col("county").cast("long") / F.lit(1000))
    arrays = rows.groupBy(block.alias("block")).agg(F.collect_list(F.array(*names)).alias("rows"))
    path = scratch_path(spark, "census-arrays")
    header = F.array(F.array(*[F.lit(n) for n in names]))
    arrays.select(F.to_json(F.concat(header, "rows")).alias("value")).write.mode("overwrite").text(path)
    back = file_sources.census_fields(file_sources.read_census_json(spark, path, lines=True), names)
    c = ingest.county_lookup(back)
    return c.select("county_fips", "county_name", *[r6(x).alias(x) for x in
                    ("median_home_value", "median_income", "owner_occupied_units")],
                    "state_code", r6("county_risk_index").alias("county_risk_index"))


@register("macro_from_files")
def q_macro_from_files(spark, sf_dir):
    """S5 -> J1: indicators landed as {"data": [{date, value}]} payloads, one per indicator and day, with the
    missing marker beside the values."""
    obs = testmap.indicator_observations(spark, sf_dir)
    one = F.struct("seq", "date", F.col("value").cast("string").alias("value"))
    days = obs.groupBy("indicator", F.substring("date", 1, 10).alias("day")).agg(F.array_sort(F.collect_list(one)).alias("d"))
    data = F.transform("d", lambda x: F.struct(x["date"].alias("date"), x["value"].alias("value")))
    missing = F.array(F.struct(F.concat("day", F.lit(" 00:00:00")).alias("date"), F.lit(".").alias("value")))
    path = scratch_path(spark, "indicators")
    days.select("indicator", F.to_json(F.struct(F.concat(data, missing).alias("data"))).alias("value")) \
        .write.mode("overwrite").partitionBy("indicator").text(path)
    m = ingest.macro_snapshots(file_sources.read_indicator_json(spark, path, lines=True))
    return m.select("date", *[r6(c).alias(c) for c in
                              ("fed_funds_rate", "treasury_yield_10yr", "unemployment_rate", "cpi",
                               "macro_stress_index")])


@register("rates_from_files")
def q_rates_from_files(spark, sf_dir):
    """S6 -> W1: rate series landed as CSV text, a missing marker after every error, read and diffed."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    obs = testmap.rate_observations(spark, sf_dir)
    value = F.when(F.col("series_id") == "error", F.array(F.col("value").cast("string"), F.lit("."))).otherwise(
        F.array(F.col("value").cast("string")))
    path = scratch_path(spark, "rates-csv")
    obs.select("series_id", stamp.alias("date"), F.explode(value).alias("value")) \
        .write.mode("overwrite").option("header", True).csv(path)
    rates = file_sources.read_rates(spark, path).withColumn("label", F.col("series_id"))
    r = ingest.rate_changes(rates, "date")
    return r.select("series_id", F.col("date").alias("ts"), "value", r6("rate_change_bps").alias("rate_change_bps"))


@register("lake_round_trip")
def q_lake_round_trip(spark, sf_dir):
    """K1 + P4 + S2 + K9 + K7 + K3 + K12: silver written by processing date (one run a month here) and read
    back, one date read by partition; gold loaded into a table; a lookup in both formats; a report."""
    root = scratch_path(spark, "lake")
    runs = lake.clean_raw(views.raw(spark, sf_dir), as_of=F.trunc("landed_date", "month")).drop("landed_date")
    lake.write_silver(runs, f"{root}/silver")
    silver = lake.read_silver_path(spark, f"{root}/silver")
    lake.write_gold(lake.score(silver), f"{root}/gold")
    gold = lake.load_gold(spark, f"{root}/gold", "gold_" + root.rsplit("-", 1)[-1])
    tiers = lake.materialize(gold.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("rows")), "tiers_" + root.rsplit("-", 1)[-1],
                             "table", f"{root}/tiers")
    lake.write_lookup(tiers, f"{root}/lookup")
    lake.write_report(tiers, f"{root}/report")
    one_day = file_sources.read_silver(spark, f"{root}/silver", day="1995-06-01")
    legs = {
        "silver": silver.groupBy(F.concat_ws("-", "year", "month").alias("part")).agg(F.count(F.lit(1)).alias("rows")),
        "one_day": one_day.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("1995-06-01").alias("part"), "rows"),
        "gold": gold.groupBy(F.col("state").alias("part")).agg(F.count(F.lit(1)).alias("rows")),
        "lookup_parquet": spark.read.parquet(f"{root}/lookup/parquet").select(F.col("risk_tier").alias("part"), "rows"),
        "lookup_csv": spark.read.option("header", True).schema("risk_tier string, rows long").csv(f"{root}/lookup/csv")
        .select(F.col("risk_tier").alias("part"), "rows"),
        "report": spark.read.schema("risk_tier string, rows long").json(f"{root}/report")
        .select(F.col("risk_tier").alias("part"), "rows"),
    }
    return file_sources.union_all([x.select(F.lit(k).alias("leg"), "part", "rows") for k, x in legs.items()])


def _segment(spark, sf_dir):
    return analytics.segment(views.stg(spark, sf_dir), SEGMENT_STATES, SEGMENT_AMOUNT)


@register("segment_tiers")
def q_segment_tiers(spark, sf_dir):
    """F9 then A5/A6: the distribution within a segment."""
    t = analytics.tier_distribution(_segment(spark, sf_dir))
    return t.select("risk_tier", "loan_count", r6("share").alias("share"))


@register("segment_corr")
def q_segment_corr(spark, sf_dir):
    """F9 then A10."""
    return analytics.corr_matrix(_segment(spark, sf_dir)).select("a", "b", r6("corr").alias("corr"))


@register("segment_describe")
def q_segment_describe(spark, sf_dir):
    """F9 then A9."""
    d = analytics.describe_stats(_segment(spark, sf_dir))
    return d.select(F.col("column").alias("metric"), "count",
                    *[r6(c).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


@register("loan_drilldown")
def q_loan_drilldown(spark, sf_dir):
    """F17 then M15 and M16: the first loan in order of its key, its factors and a sweep of what-ifs."""
    stg = views.stg(spark, sf_dir)
    loan = marts.loan_by_id(stg, stg.agg(F.min("loan_id")).scalar())
    parts = scenarios.factor_contributions(loan).select("loan_id", F.col("factor").alias("item"), F.col("impact").alias("value"))
    sweep = scenarios.what_if_sweep(loan, WHAT_IF_SWEEP).select(
        "loan_id", F.concat(F.lit("LTV "), F.col("scenario_ltv").cast("int")).alias("item"), F.col("new_score").alias("value"))
    return file_sources.union_all([parts, sweep]).select("loan_id", "item", r6("value").alias("value"))


@register("topic_volume")
def q_topic_volume(spark, sf_dir):
    """A22 + F14 + F15: messages by topic from the offsets of its partitions; internal topics are skipped and the
    names matched. Topics are the event types, one of them internal; partitions follow the user."""
    from ..streaming import bridge
    ev = testmap.table(spark, sf_dir, "events")
    topic = F.when(F.col("event_type") == "error", "_error").otherwise(F.col("event_type"))
    offsets = ev.select(topic.alias("topic"), (F.col("user_id") % 8).cast("int").alias("partition"),
                        F.col("event_id").cast("long").alias("offset"))
    return bridge.topic_volume(bridge.match(offsets, "topic", "(click|view|signup|_error)"))


@register("ordered_marts")
def q_ordered_marts(spark, sf_dir):
    """The marts in their order, with the place in it."""
    from pyspark.sql import Window
    stg = views.stg(spark, sf_dir)
    summary = marts.ordered(marts.mart_risk_summary(stg), [F.desc("avg_risk_score"), "risk_tier"])
    s = summary.select(F.lit("summary").alias("mart"), F.col("risk_tier").alias("item"),
                       F.row_number().over(Window.orderBy(F.desc("avg_risk_score"), "risk_tier")).alias("place"))
    t = analytics.tier_distribution(stg).select(
        F.lit("tiers").alias("mart"), F.col("risk_tier").alias("item"),
        F.row_number().over(Window.orderBy(F.desc("loan_count"), "risk_tier")).alias("place"))
    days = marts.mart_daily_risk_trend(stg)
    d = marts.ordered(days, ["processing_date", "risk_tier"]).select(
        F.lit("trend").alias("mart"), F.concat_ws(" ", F.col("processing_date").cast("string"), "risk_tier").alias("item"),
        F.row_number().over(Window.orderBy("processing_date", "risk_tier")).alias("place"))
    return file_sources.union_all([s, t, d])


@register("state_union")
def q_state_union(spark, sf_dir):
    """The loans of each state appended by column name, then counted."""
    raw = testmap.raw_loans(spark, sf_dir)
    parts = [raw.where(F.col("state") == x) for x in ("VA", "MD", "DC")]
    return file_sources.union_all(parts).groupBy("state", "loan_type").agg(F.count(F.lit(1)).alias("loan_count"))


@register("hourly_faked_previous")
def q_hourly_faked_previous(spark, sf_dir):
    """W3 under the reference's stand-in rule."""
    c = scenarios.hourly_counts(views.stg(spark, sf_dir), "ingestion_timestamp")
    return c.select("hour", "current_count", scenarios.faked_previous("current_count").alias("previous_count"))
