"""Registered streaming queries.

Each streams the given tables (as file streams, micro-batches sized by bytes)
through a Structured Streaming query until the backlog is done
(``availableNow``), and returns the sink read back as a batch DataFrame, so that
streaming results can be checked against batch SQL. The results don't depend on
how the input is cut into files or batches.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lake, marts
from ..session import scratch_path
from ..sources import files, testmap
from ..streaming import bridge, counters, rates
from . import views
from .registry import register

BRIDGE_EPOCH = 1_700_000_000


def _drain(q) -> None:
    """Wait for an availableNow query to end, and raise what ended it."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _scored(raw):
    silver = lake.clean_raw(raw, as_of=F.to_date(F.substring("ingestion_timestamp", 1, 10)))
    return lake.score(silver)


def _scored_stream(spark, sf_dir):
    return _scored(testmap.loans_of(testmap.stream_table(spark, sf_dir, "lineitem")).drop("landed_date"))


@register("stream_tier_counts")
def q_stream_tier_counts(spark, sf_dir):
    """Running tier counts."""
    agg = counters.running_tier_counts(_scored_stream(spark, sf_dir))
    out, ck = scratch_path(spark, "tier-counts"), scratch_path(spark, "tier-counts-ckpt")
    _drain(counters.start_update(agg, out, ck, ["risk_tier"]))
    return counters.latest_by_key(spark, out, ["risk_tier"])


@register("stream_hourly_alerts")
def q_stream_hourly_alerts(spark, sf_dir):
    """Hourly CRITICAL counts in state, compared hour over hour when read."""
    scored = _scored_stream(spark, sf_dir).withColumn("event_ts", F.to_timestamp("ingestion_timestamp"))
    out, ck = scratch_path(spark, "hourly"), scratch_path(spark, "hourly-ckpt")
    _drain(counters.start_hourly_alerts(scored, out, ck))
    return counters.read_hourly_alerts(spark, out)


@register("stream_rate_bps")
def q_stream_rate_bps(spark, sf_dir):
    """W1 on a stream: observations land by day, changes are taken when read."""
    stream = testmap.rates_of(testmap.stream_table(spark, sf_dir, "events"))
    out, ck = scratch_path(spark, "rate-bps"), scratch_path(spark, "rate-bps-ckpt")
    _drain(rates.land_rates(stream, out, ck, "ts"))
    return rates.read_rate_changes(spark, out, "ts").select(
        "series_id", "ts", "value", F.round("rate_change_bps", 6).alias("rate_change_bps"))


@register("stream_quality_watch")
def q_stream_quality_watch(spark, sf_dir):
    """Q18: the 28-check suite runs on every arrival; the partial results of all arrivals merge."""
    stg = marts.stg_loan_risk_scores(_scored_stream(spark, sf_dir), as_of_ts=views.AS_OF_TS)
    out, ck = scratch_path(spark, "quality-watch"), scratch_path(spark, "quality-watch-ckpt")
    _drain(counters.watch_quality(stg, out, ck, as_of=views.AS_OF_DATE))
    rep = counters.read_quality(spark, out, stg.columns, as_of=views.AS_OF_DATE)
    return rep.select("check_id", "check", F.col("column").alias("target"),
                      F.round("observed", 6).alias("observed"), "passed", "unexpected_count")


def _rate_payload():
    """The bridge's rate records: ``error`` events carry a truncated (bad) payload, ``signup`` events a bare
    number (wrapped as {"data": ...}), the others an object."""
    return (F.when(F.col("event_type") == "error", F.substring("props", 1, 5))
             .when(F.col("event_type") == "signup", F.col("value").cast("string"))
             .otherwise(F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("series_id"),
                                           F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
                                           F.col("value")))))


def _topic_streams(spark, sf_dir):
    """One stream of the records of two topics."""
    loans = bridge.to_topic(testmap.loans_of(testmap.stream_table(spark, sf_dir, "lineitem")).drop("landed_date"),
                            "loan-applications")
    ev = testmap.stream_table(spark, sf_dir, "events")
    return loans.unionByName(ev.select(_rate_payload().alias("value"), F.lit("mortgage-rates").alias("topic")))


@register("stream_bridge")
def q_stream_bridge(spark, sf_dir):
    """Topic records -> parsed, wrapped, tagged and keyed, counted by topic on the stream."""
    b = bridge.bridge_transform(_topic_streams(spark, sf_dir), now=F.lit(BRIDGE_EPOCH))
    agg = b.groupBy("topic").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("ok").alias("sent"),
        F.count_if(~F.col("ok")).alias("failed"), F.count_if(F.col("ok") & ~F.col("is_object")).alias("wrapped"),
        F.count_if(F.col("key") != F.col("topic")).alias("keyed"))
    out, ck = scratch_path(spark, "bridge"), scratch_path(spark, "bridge-ckpt")
    _drain(counters.start_update(agg, out, ck, ["topic"]))
    return counters.latest_by_key(spark, out, ["topic"])


@register("stream_bridge_sink")
def q_stream_bridge_sink(spark, sf_dir):
    """T1 + K5 + A24: the bridge's keyed sink, its quarantine and its counters, read back by topic."""
    out, ck = scratch_path(spark, "bridge-sink"), scratch_path(spark, "bridge-sink-ckpt")
    _drain(bridge.start_bridge(_topic_streams(spark, sf_dir), out, ck, now=F.lit(BRIDGE_EPOCH)))
    sent, bad, counted = bridge.read_bridge(spark, out)
    names = ["_source_topic", "_bridge_ts", "data", "value", "loan_amount"]
    sent = sent.select("topic", "key", F.json_tuple("value", *names).alias(*[f"f_{n}" for n in names]))     # one parse for all
    field = lambda name: F.col(f"f_{name}")            # noqa: E731
    total = counted.agg(F.struct(F.sum("sent").alias("sent"), F.sum("failed").alias("failed")).alias("c")).scalar()
    good = sent.groupBy("topic").agg(
        F.count(F.lit(1)).alias("sent"), F.countDistinct("key").alias("distinct_keys"), F.min("key").alias("first_key"),
        F.count_if(field("_source_topic") == F.col("topic")).alias("tagged"),
        F.count_if(field("_bridge_ts") == str(BRIDGE_EPOCH)).alias("stamped"),
        F.round(F.sum(F.coalesce(field("data"), field("value"), field("loan_amount")).try_cast("double")), 2).alias("payload_sum"))
    failed = bad.groupBy(F.col("topic").alias("bad_topic")).agg(F.count(F.lit(1)).alias("failed"))
    return good.join(failed, F.col("topic") == F.col("bad_topic"), "left").select(
        *good.columns, F.coalesce("failed", F.lit(0)).alias("failed"), total["sent"].alias("counted_sent"),
        total["failed"].alias("counted_failed"))


@register("stream_landing_to_lake")
def q_stream_landing_to_lake(spark, sf_dir):
    """T1 + T2 + K6 + S1 + S8: topic records -> bridge -> raw JSON landing by topic and arrival day; the landed
    loans are streamed again into running tier counts and read by the batch job, and every topic's landed
    records are counted."""
    landing, ck = scratch_path(spark, "raw-landing"), scratch_path(spark, "raw-landing-ckpt")
    _drain(counters.land_bridged(bridge.bridge_transform(_topic_streams(spark, sf_dir), now=F.lit(BRIDGE_EPOCH)),
                                 landing, ck))
    agg = counters.running_tier_counts(_scored(counters.stream_raw(spark, f"{landing}/_source_topic=loan-applications")))
    out, ck = scratch_path(spark, "landed-tiers"), scratch_path(spark, "landed-tiers-ckpt")
    _drain(counters.start_update(agg, out, ck, ["risk_tier"]))
    tiers = counters.latest_by_key(spark, out, ["risk_tier"]).select(
        F.concat(F.lit("tier:"), "risk_tier").alias("what"), F.col("loan_count").alias("records"))
    topics = spark.read.text(landing).groupBy("_source_topic").agg(F.count(F.lit(1)).alias("records")).select(
        F.concat(F.lit("topic:"), "_source_topic").alias("what"), "records")
    batch = counters.running_tier_counts(_scored(files.read_raw(spark, f"{landing}/_source_topic=loan-applications")))
    batch = batch.select(F.concat(F.lit("batch:"), "risk_tier").alias("what"), F.col("loan_count").alias("records"))
    return files.union_all([tiers, batch, topics])
