"""Registered queries on what leaves the platform: published records and stream metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import marts
from ..session import scratch_path
from ..streaming import bridge, counters
from . import views
from .registry import register
from .streams import _drain, _scored_stream

TOPIC = "high-risk-loans"


@register("published_records")
def q_published_records(spark, sf_dir):
    """K4: high-risk loans published as records of a topic (key and JSON value), to a file sink in the connector's place,
    and read back: by tier the records, their keys, and the amounts in their values."""
    path = scratch_path(spark, "published-records")
    high = marts.mart_high_risk_loans(views.stg(spark, sf_dir))
    bridge.publish(high, TOPIC, key="loan_id", sink="parquet", path=path)
    sent = spark.read.schema("topic string, key string, value string").parquet(path)
    value = F.from_json("value", "loan_id string, risk_tier string, loan_amount float, risk_score double")
    back = sent.select("topic", "key", value.alias("v"))
    return back.groupBy("topic", F.col("v.risk_tier").alias("risk_tier")).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("key") == F.col("v.loan_id")).alias("keyed"),
        F.round(F.sum(F.col("v.loan_amount").cast("double")), 2).alias("amount"), F.round(F.avg("v.risk_score"), 6).alias("avg_risk_score"))


@register("stream_metrics")
def q_stream_metrics(spark, sf_dir):
    """Each micro-batch emits its critical count and its rows; the totals of all batches."""
    out, ck = scratch_path(spark, "metrics"), scratch_path(spark, "metrics-ckpt")
    _drain(counters.start_metrics(_scored_stream(spark, sf_dir), out, ck))
    return counters.read_metrics(spark, out).agg(F.sum("critical_count").alias("critical_count"), F.sum("rows").alias("rows"))
