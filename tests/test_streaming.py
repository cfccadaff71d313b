"""Streaming: bridge transform cases, sinks, and streaming == batch."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tierwise.operators import lake
from tierwise.streaming import bridge, counters, rates


def test_bridge_transform_cases(spark):
    recs = spark.createDataFrame([
        ("loan-applications", '{"loan_id": "L1", "x": 1}'),
        ("mortgage-rates", '{"id": 7}'),
        ("macro-indicators", "3.5"),
        ("macro-indicators", ""),
        ("mortgage-rates", "{}"),
        ("mortgage-rates", '{"k":'),
    ], "topic string, value string")
    out = bridge.bridge_transform(recs, now=F.lit(100)).collect()
    by = [(r.key, r.ok, r.value) for r in out]
    assert by[0][0] == "L1" and json.loads(by[0][2]) == {"loan_id": "L1", "x": 1, "_source_topic": "loan-applications",
                                                          "_bridge_ts": 100}
    assert by[1][0] == "7"
    assert json.loads(by[2][2]) == {"data": 3.5, "_source_topic": "macro-indicators", "_bridge_ts": 100}
    assert json.loads(by[3][2]) == {"_source_topic": "macro-indicators", "_bridge_ts": 100}
    assert json.loads(by[4][2]) == {"_source_topic": "mortgage-rates", "_bridge_ts": 100}
    assert by[5][1] is False and by[5][2] is None and by[5][0] == "mortgage-rates"


def test_bridge_keeps_payloads_that_text_cutting_would_lose(spark):
    recs = spark.createDataFrame([
        ("loan-applications", '{\n  "loan_id": "L1",\n  "note": "a\\nb",\n  "n": {"k": [1, null]}\n}'),
        ("loan-applications", '{"a": 1, "loan_id": "old", "a": 2, "loan_id": "new"}'),
        ("mortgage-rates", '{"id": 7, "_source_topic": "elsewhere", "_bridge_ts": 1}'),
        ("mortgage-rates", "[1, 2]"), ("mortgage-rates", '"text"'), ("mortgage-rates", None),
        ("mortgage-rates", '{"a": 1} trailing'),
    ], "topic string, value string")
    out = bridge.bridge_transform(recs, now=F.lit(100)).collect()
    meta = {"_source_topic": "mortgage-rates", "_bridge_ts": 100}
    loan = {"_source_topic": "loan-applications", "_bridge_ts": 100}
    assert json.loads(out[0].value) == {"loan_id": "L1", "note": "a\nb", "n": {"k": [1, None]}, **loan}
    assert json.loads(out[1].value) == {"a": 2, "loan_id": "new", **loan} and out[1].key == "new"
    assert json.loads(out[2].value) == {"id": 7, **meta} and out[2].value.count("_source_topic") == 1
    assert json.loads(out[3].value) == {"data": [1, 2], **meta} and not out[3].is_object
    assert json.loads(out[4].value) == {"data": "text", **meta}
    assert json.loads(out[5].value) == meta and out[5].ok
    assert not out[6].ok and out[6].raw_value == '{"a": 1} trailing'


def test_bridge_takes_plain_objects_over_as_text(spark):
    from pyspark.sql import Row
    plain = {   # text: (key, the members before the two that the bridge sets)
        '{"loan_id":"L1","a":"x, y:z{}"}': ("L1", '"loan_id":"L1","a":"x, y:z{}",'),
        '{"id":12345678.25,"b":true}': ("12345678.25", '"id":12345678.25,"b":true,'),
        '{"_bridge_ts":3,"a":"_bridge_ts"}': ("t", '"a":"_bridge_ts",'),
        '{"loan_id":"","_source_topic":",","id":5}': ("", '"loan_id":"","id":5,'),
        '{"_source_topic":"q"}': ("t", ""),
    }
    parsed = {  # these have another form when written anew, or are bad
        '{"a":1.50}': '"a":1.5,', '{ "a":1}': '"a":1,', '{"a":1,"a":2}': '"a":2,', '{"a":-0}': '"a":0,',
        '{"a":"\\u0041"}': '"a":"A",', '{"a":01}': None, '{"a":"\t"}': None, '{"a":1} x': None, '{"a":1,}': None,
    }
    recs = spark.createDataFrame([Row(topic="t", value=v) for v in [*plain, *parsed]])
    out = bridge.bridge_transform(recs, now=F.lit(100))
    got = {r.raw_value: r for r in out.collect()}
    end = '"_source_topic":"t","_bridge_ts":100}'
    for text, (key, members) in plain.items():
        assert (got[text].key, got[text].value, got[text].ok, got[text].is_object) == (key, "{" + members + end, True, True)
    for text, members in parsed.items():
        assert (got[text].value, got[text].ok) == (None if members is None else "{" + members + end, members is not None)
    # the text of plain records is not parsed into variants: that is behind a condition
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN NOT _plain" in plan and "RLIKE" in plan


def test_bridge_sink_with_quarantine(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    for i in range(3):
        with open(os.path.join(src, f"part{i}.json"), "w") as f:
            f.write(json.dumps({"topic": "loan-applications", "value": json.dumps({"loan_id": f"L{i}"})}) + "\n")
            f.write(json.dumps({"topic": "mortgage-rates", "value": "{bad"}) + "\n")
    stream = spark.readStream.schema("topic string, value string").option("maxFilesPerTrigger", 1).json(src)
    q = bridge.start_bridge(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck")
    q.awaitTermination()
    sent, bad, counted = bridge.read_bridge(spark, f"{tmp_dir}/out")
    assert {r.key for r in sent.collect()} == {"L0", "L1", "L2"} and sent.count() == 3
    assert [tuple(r) for r in bad.collect()] == [("mortgage-rates", "{bad")] * 3
    assert [tuple(r) for r in counted.groupBy().sum("sent", "failed").collect()] == [(3, 3)]
    # re-running against the same checkpoint processes nothing new (offsets are in the checkpoint)
    bridge.start_bridge(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    assert bridge.read_bridge(spark, f"{tmp_dir}/out")[0].count() == 3


def test_land_raw_by_topic_and_day(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        for i in range(4):
            f.write(json.dumps({"loan_amount": str(1000 * (i + 1)), "_source_topic": "loan-applications",
                                "_bridge_ts": 1712448000 + i}) + "\n")
    stream = counters.stream_raw(spark, src)
    counters.land_raw(stream, f"{tmp_dir}/raw", f"{tmp_dir}/ck").awaitTermination()
    assert os.path.isdir(f"{tmp_dir}/raw/_source_topic=loan-applications/year=2024/month=04/day=07")
    assert spark.read.json(f"{tmp_dir}/raw").count() == 4


def _loan_file(path, rows):
    with open(path, "w") as f:
        for ts, ltv, rate in rows:
            f.write(json.dumps({"loan_id": f"{ts}-{ltv}", "loan_amount": "100000", "loan_type": "1",
                                "action_taken": "1", "ltv": str(ltv), "dti": "55", "interest_rate": str(rate),
                                "ingestion_timestamp": ts}) + "\n")


CRITICAL_FILES = [
    [("2024-01-01T10:05:00", 98, 9.0), ("2024-01-01T10:35:00", 98, 9.0)],
    [("2024-01-01T15:05:00", 98, 9.0), ("2024-01-01T15:06:00", 70, 3.0)],
    [("2024-01-01T11:20:00", 98, 9.0)],
    [("2024-01-01T09:00:00", 98, 9.0), ("2024-01-01T15:20:00", 98, 9.0)]]      # hours after the ones before


def _land_files(tmp_dir, files):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    for i, rows in enumerate(files, 1):
        _loan_file(os.path.join(src, f"{i}.json"), rows)
        os.utime(os.path.join(src, f"{i}.json"), (i, i))
    return src


@pytest.mark.parametrize("max_files", [1, None])
def test_hourly_alerts_count_late_rows_in_any_batching(spark, tmp_dir, max_files):
    src = _land_files(tmp_dir, CRITICAL_FILES)
    scored = lake.score(lake.clean_raw(counters.stream_raw(spark, src, max_files=max_files), as_of="2024-01-01"))
    q = counters.start_hourly_alerts(scored.withColumn("event_ts", F.to_timestamp("ingestion_timestamp")),
                                     f"{tmp_dir}/h", f"{tmp_dir}/hck")
    q.awaitTermination()
    got = {r.hour.hour: (r.current_count, r.previous_count, r.alert)
           for r in counters.read_hourly_alerts(spark, f"{tmp_dir}/h").collect()}
    assert got == {9: (1, 0, True), 10: (2, 1, True), 11: (1, 2, False), 15: (2, 0, True)}
    if max_files:                   # an hour that a late row changed has left the stream more than once
        emitted = counters.keyed_sink(f"{tmp_dir}/h/alerts", ["hour"]).read(spark)
        assert emitted.groupBy("hour").count().where("count > 1").count() >= 1
    assert any("critical_metrics" in (p.get("observedMetrics") or {}) for p in q.recentProgress)

    tiers = counters.running_tier_counts(lake.score(lake.clean_raw(counters.stream_raw(spark, src, max_files=max_files),
                                                                   "2024-01-01")))
    counters.start_update(tiers, f"{tmp_dir}/t", f"{tmp_dir}/tck", ["risk_tier"]).awaitTermination()
    got = {r.risk_tier: r.loan_count for r in counters.latest_by_key(spark, f"{tmp_dir}/t", ["risk_tier"]).collect()}
    assert got == {"CRITICAL": 6, "MEDIUM": 1}


@pytest.mark.parametrize("max_files", [1, None])
def test_quality_of_all_arrivals_is_the_batch_suite(spark, tmp_dir, max_files):
    from tierwise.operators import quality
    src = _land_files(tmp_dir, CRITICAL_FILES)
    stream = lake.score(lake.clean_raw(counters.stream_raw(spark, src, max_files=max_files), "2024-01-01"))
    counters.watch_quality(stream, f"{tmp_dir}/rep", f"{tmp_dir}/ck", as_of="2024-01-02").awaitTermination()
    got = counters.read_quality(spark, f"{tmp_dir}/rep", stream.columns, as_of="2024-01-02")
    batch = quality.run_suite(lake.score(lake.clean_raw(spark.read.schema(counters.RAW_LOAN).json(src), "2024-01-01")),
                              as_of="2024-01-02", layer="silver_arrival")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert spark.read.parquet(f"{tmp_dir}/rep").count() == 28 * (len(CRITICAL_FILES) if max_files else 1)


def test_watch_quality_and_topic_volume(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _loan_file(os.path.join(src, "1.json"), [("2024-01-01T10:05:00", 98, 9.0)])
    stream = lake.score(lake.clean_raw(counters.stream_raw(spark, src), "2024-01-01"))
    counters.watch_quality(stream, f"{tmp_dir}/rep", f"{tmp_dir}/ck", as_of="2024-01-02").awaitTermination()
    rep = spark.read.parquet(f"{tmp_dir}/rep")
    assert rep.count() == 28 and rep.where("check = 'row_count:table' AND NOT passed").count() == 1
    offs = spark.createDataFrame([("t", 0, 4), ("t", 0, 9), ("t", 1, 2), ("_internal", 0, 5)],
                                 "topic string, partition int, offset long")
    assert {r.topic: r.messages for r in bridge.topic_volume(offs).collect()} == {"t": 13}
    assert bridge.match(offs, "topic", "t|x").count() == 3
    k = bridge.to_topic(spark.createDataFrame([("L1", 5)], "loan_id string, v int"), "loan-applications", "loan_id")
    assert json.loads(k.first().value) == {"loan_id": "L1", "v": 5} and k.first().key == "L1"


@pytest.mark.parametrize("max_files", [1, None])
def test_stream_rate_changes_in_any_order_and_batching(spark, tmp_dir, max_files):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    batches = [[("A", "2024-01-03T00:00:00", 1.25), ("A", "2024-01-04T00:00:00", float("nan"))],
               [("A", "2024-01-01T00:00:00", 1.0), ("A", "2024-01-02T00:00:00", 1.5), ("B", "2024-01-01T00:00:00", 7.0)],
               [("B", "2024-01-05T00:00:00", 6.0), (None, "2024-01-05T00:00:00", 2.0)]]
    for i, rows in enumerate(batches, 1):
        with open(os.path.join(src, f"{i}.json"), "w") as f:
            for sid, d, v in rows:
                f.write(json.dumps({"series_id": sid, "label": sid, "date": d,
                                    "value": None if v != v else v}) + "\n")
        os.utime(os.path.join(src, f"{i}.json"), (i, i))
    stream = spark.readStream.schema("series_id string, label string, date timestamp_ntz, value double")
    stream = (stream.option("maxFilesPerTrigger", max_files) if max_files else stream).json(src)
    rates.land_rates(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    got = {(r.series_id, r.date.day): round(r.rate_change_bps, 9)
           for r in rates.read_rate_changes(spark, f"{tmp_dir}/out").collect()}
    assert got == {("A", 1): 0.0, ("A", 2): 50.0, ("A", 3): -25.0, ("B", 1): 0.0, ("B", 5): -100.0, (None, 5): 0.0}


def test_land_bridged_routes_by_topic_and_day(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"topic": "loan-applications", "value": json.dumps({"loan_amount": "5"})}) + "\n")
        f.write(json.dumps({"topic": "mortgage-rates", "value": "2.5"}) + "\n")
        f.write(json.dumps({"topic": "mortgage-rates", "value": "{oops"}) + "\n")
    stream = spark.readStream.schema("topic string, value string").json(src)
    bridged = bridge.bridge_transform(stream, now=F.lit(1_700_000_000))      # 2023-11-14 UTC
    counters.land_bridged(bridged, f"{tmp_dir}/raw", f"{tmp_dir}/ck").awaitTermination()
    loans = f"{tmp_dir}/raw/_source_topic=loan-applications/year=2023/month=11/day=14"
    assert os.path.isdir(loans)
    assert spark.read.json(loans).first().loan_amount == "5"
    landed = spark.read.text(f"{tmp_dir}/raw/_source_topic=mortgage-rates").collect()
    assert len(landed) == 1 and json.loads(landed[0].value)["data"] == 2.5
    assert [r.value for r in spark.read.text(f"{tmp_dir}/raw/_source_topic=_quarantine").collect()] == ["{oops"]


def test_landed_files_are_compressed_and_bounded(spark, tmp_dir):
    """A landing takes a fraction of its JSON's bytes on disk, in files of a bounded number of records."""
    rows = [(i, "loan-applications", json.dumps({"loan_id": str(i), "loan_amount": "5", "property_value": "100000", "state": "VA"})) for i in range(1000)]
    rows += [(1000 + i, "mortgage-rates", "{oops") for i in range(3)]
    spark.createDataFrame(rows, "n long, topic string, value string").coalesce(1).write.parquet(f"{tmp_dir}/src")
    stream = spark.readStream.schema("n long, topic string, value string").parquet(f"{tmp_dir}/src").drop("n")
    bridged = bridge.bridge_transform(stream, now=F.lit(1_700_000_000))
    counters.land_bridged(bridged, f"{tmp_dir}/raw", f"{tmp_dir}/ck", per_file=300).awaitTermination()
    files = [os.path.join(d, f) for d, _, names in os.walk(f"{tmp_dir}/raw") for f in names if f.startswith("part-")]
    assert len(files) == 5 and sum(map(os.path.getsize, files)) < sum(len(v) for _, _, v in rows) / 3
    loans = counters.stream_raw(spark, f"{tmp_dir}/raw/_source_topic=loan-applications")
    q = counters.start_update(loans.groupBy("state").count(), f"{tmp_dir}/out", f"{tmp_dir}/ck2", ["state"])
    q.awaitTermination()
    assert [tuple(r) for r in counters.latest_by_key(spark, f"{tmp_dir}/out", ["state"]).collect()] == [("VA", 1000)]
    assert {int(r.loan_id) for r in spark.read.json(f"{tmp_dir}/raw/_source_topic=loan-applications").collect()} == set(range(1000))
    assert spark.read.text(f"{tmp_dir}/raw/_source_topic=_quarantine").count() == 3
