"""Stream bridge.

One Structured Streaming query replaces the reference's consumer loop:
multi-topic source -> parse/wrap/tag/key -> keyed sink, with offsets in the
checkpoint. Bad JSON is quarantined instead of stopping the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import TOPICS
from . import levels

BRIDGE_GROUP = "tierwise-bridge"
# fixed values: the two fields that the bridge sets
META = ("_source_topic", "_bridge_ts")
# a flat object as it is written anew: no blanks, escapes, nulls, or numbers with another form
_TEXT = r'"[^"\x00-\x1f]*+"'
_MEMBER = _TEXT + r":(?:" + _TEXT + r"|true|false|0|-?+[1-9][0-9]{0,16}+(?![0-9.eE])|-?+(?:0|[1-9][0-9]{0,12}+)\.[0-9]{0,12}[1-9](?![0-9eE]))"
PLAIN = r"\A\{" + _MEMBER + "(?:," + _MEMBER + r")*+\}\z"
PLAIN_BYTES = 4000          # longer ones are parsed: a pattern's stack follows the number of members
_SET = r',"_(?:' + "|".join(m[1:] for m in META) + r')":(?:"[^"]*+"|[^,"]*+)'


def read_topics(spark: SparkSession, topics=TOPICS, bootstrap: str = "localhost:9092",
                starting: str = "earliest", max_offsets: int | None = None) -> DataFrame:
    """One subscription over several topics (needs the Kafka connector jar).

    ``starting="latest"`` gives S8's start-at-latest; ``max_offsets`` bounds
    each micro-batch (T2's batch of 100).
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", ",".join(topics))
         .option("startingOffsets", starting)
         .option("kafka.group.id", BRIDGE_GROUP))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", max_offsets)
    return r.load()


def to_topic(df: DataFrame, topic: str, key: str | None = None) -> DataFrame:
    """K4: rows -> Kafka records (value = UTF-8 JSON of all columns)."""
    cols = [F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"), F.lit(topic).alias("topic")]
    if key:
        cols.append(F.col(key).cast("string").alias("key"))
    return df.select(*cols)


def bridge_transform(records: DataFrame, now: Column | None = None) -> DataFrame:
    """(topic, value[, partition, offset]) -> keyed, tagged JSON records.

    * empty message -> ``{}``; non-object JSON -> ``{"data": <payload>}``;
    * ``_source_topic`` and ``_bridge_ts`` (epoch seconds) are set, replacing any
      that the payload has; of a repeated key the last value stays;
    * key = loan_id, else id, else the topic name;
    * ``ok`` is false for unparseable payloads (quarantined by the sink).

    An object is parsed into a map of variants and written anew: its text is
    never cut or spliced, so line breaks and nesting don't matter. Only a flat
    object that already is what would be written (``PLAIN``: no quote or comma
    of it can be part of another token, no key repeated) is taken over as text.
    """
    v = F.col("value").cast("string")
    v = F.when(v.startswith("{") & v.endswith("}"), v).otherwise(F.trim(v, F.lit(" \t\r\n")))
    ts = (now if now is not None else F.unix_timestamp()).cast("long")
    r = records.withColumn("_v", v)
    flat = (F.octet_length("_v") <= PLAIN_BYTES) & F.col("topic").isNotNull() & ~F.col("_v").contains("\\") & F.col("_v").rlike(PLAIN)
    r = r.withColumn("_names", F.when(flat, F.json_object_keys("_v")))
    r = r.withColumn("_plain", F.coalesce(F.size("_names") == F.size(F.array_distinct("_names")), F.lit(False)))
    plain = F.col("_plain")
    # as the one element of an array: what stands behind a complete value makes it bad JSON
    boxed = F.concat(F.lit("["), "_v", F.lit("]"))
    r = r.withColumn("_map", F.when(~plain & F.col("_v").startswith("{"), F.from_json(boxed, "array<map<string,variant>>")))
    r = r.withColumn("_any", F.when(~plain, F.from_json(boxed, "array<variant>")))
    r = r.withColumns({c: F.when(F.size(c) == 1, F.col(c)[0]) for c in ("_any", "_map")})
    keys = F.map_keys("_map")
    repeated = F.size(keys) > F.size(F.array_distinct(keys))
    # variants reject an object with a repeated key
    is_obj = F.col("_v").startswith("{") & F.col("_map").isNotNull() & (F.col("_any").isNotNull() | repeated)
    empty = F.col("_v").isNull() | (F.col("_v") == "")
    entries = F.map_entries("_map")
    # the last of repeated keys, without the two that the bridge sets
    own = F.filter(entries, lambda e, i: (F.array_position(F.reverse(keys), e["key"]) == F.size(keys) - i)
                   & ~e["key"].isin(*META))
    meta = [F.struct(F.lit(META[0]).alias("key"), F.col("topic").cast("variant").alias("value")),
            F.struct(F.lit(META[1]).alias("key"), ts.cast("variant").alias("value"))]
    data = F.array(F.struct(F.lit("data").alias("key"), F.col("_any").alias("value")), *meta)
    whole = (F.when(empty, F.array(*meta)).when(is_obj, F.concat(own, F.array(*meta)))
              .when(F.col("_any").isNotNull(), data))
    r = r.withColumns({"_new": F.when(~plain, F.map_from_entries(whole)), "_is_obj": plain | F.coalesce(is_obj, F.lit(False)) | empty})

    def field(name: str) -> Column:
        token = F.regexp_extract("_v", rf'[{{,]"{name}":("[^"]*+"|[^,"}}]*+)', 1)
        token = F.when(token != "", F.btrim(token, F.lit('"')))
        return F.when(plain, token).otherwise(F.try_variant_get(F.try_element_at("_new", F.lit(name)), "$", "string"))

    members = F.concat(F.lit(","), F.substring("_v", F.lit(2), F.length("_v") - 2))
    added = F.to_json(F.struct(F.col("topic").alias(META[0]), ts.alias(META[1])))
    text = F.concat(F.regexp_replace(members, _SET, ""), F.lit(","), F.substring(added, 2, 2 ** 31 - 1))
    key = F.coalesce(field("loan_id"), field("id"), F.col("topic"))
    extra = [c for c in ("partition", "offset") if c in records.columns]
    return r.select(
        F.col("topic"), *extra, F.when(F.col("_is_obj") & ~empty, key).otherwise(F.col("topic")).alias("key"),
        F.when(plain, F.concat(F.lit("{"), F.substring(text, 2, 2 ** 31 - 1)))
         .otherwise(F.to_json("_new")).alias("value"),
        (plain | F.col("_new").isNotNull()).alias("ok"),
        F.col("_is_obj").alias("is_object"), ts.alias("_bridge_ts"), F.col("value").cast("string").alias("raw_value"))


SINK = "ok boolean, topic string, key string, value string, raw_value string, _bridge_ts long, _epoch long"


def record_sink(path: str) -> levels.Sink:
    """K5: records by outcome and topic; the folders of many batches merge by levels."""
    return levels.Sink(path, partition_by=["ok", "topic"])


def start_bridge(stream: DataFrame, path: str, checkpoint: str, drain: bool = True, now: Column | None = None) -> StreamingQuery:
    """T1 + K5 + T3: bridge a stream into a keyed landing by outcome and topic.

    A micro-batch is parsed once and written once: bad records stand beside the good ones in a
    partition of their own (the quarantine). The counters of each batch (A24) go to ``<path>_counters``;
    ``read_bridge`` reads all three. A replayed batch rewrites its own files. ``drain=True`` processes
    the backlog and stops (availableNow).
    """
    records, counters = record_sink(path), levels.Sink(f"{path}_counters")

    def write(batch: DataFrame, epoch: int) -> None:
        seen = Observation(f"bridge-{epoch}")
        counted = batch.observe(seen, F.count_if(F.col("ok")).alias("sent"), F.count_if(~F.col("ok")).alias("failed"))
        done = any(a <= epoch <= b and a < b for a, b in levels.runs(batch.sparkSession, path))
        records.write(counted.select("ok", "topic", "key", "value", F.when(~F.col("ok"), F.col("raw_value")).alias("raw_value"), "_bridge_ts"), epoch)
        if done:                # replayed after its records were merged: counted from those
            mine = records.read(batch.sparkSession, SINK).where(F.col("_epoch") == epoch)
            got = mine.agg(F.count_if("ok").alias("sent"), F.count_if(~F.col("ok")).alias("failed")).first().asDict()
        else:
            got = seen.get
        counters.write(batch.sparkSession.range(1).select(*[F.lit(got[c]).cast("long").alias(c) for c in ("sent", "failed")]), epoch)

    w = bridge_transform(stream, now).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if drain else w.trigger(processingTime="10 seconds")
    return w.start()


def read_bridge(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sent records, quarantined records, counters per batch) of a bridge sink."""
    rows = record_sink(path).read(spark, SINK)
    counted = levels.Sink(f"{path}_counters").read(spark, "sent long, failed long, _epoch long")
    return (rows.where("ok").select("topic", "key", "value", "_bridge_ts"), rows.where("NOT ok").select("topic", "raw_value"),
            counted.drop("_epoch"))


def topic_volume(offsets: DataFrame) -> DataFrame:
    """Records per topic = sum over partitions of (max offset + 1).

    Input is a Kafka batch read (topic, partition, offset); F14 internal
    topics (leading underscore) are skipped.
    """
    user = user_topics(offsets)
    per_part = user.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    return per_part.groupBy("topic").agg(F.sum("end_offset").alias("messages"))


def match(df: DataFrame, col: str, regex: str = ".*") -> DataFrame:
    """keep rows whose column matches the pattern (default all)."""
    return df.where(F.col(col).rlike(f"^(?:{regex})$"))


def user_topics(df: DataFrame, col: str = "topic") -> DataFrame:
    """skip internal topics (leading underscore)."""
    return df.where(~F.col(col).startswith("_"))


def publish(df: DataFrame, topic: str, bootstrap: str = "localhost:9092", key: str | None = None, sink: str = "kafka",
            path: str | None = None) -> None:
    """K4: batch-publish rows as JSON records: to the topic (needs the Kafka connector jar), or as the same records to
    files (``sink`` a file format, ``path``)."""
    w = to_topic(df, topic, key).write.format(sink)
    if sink == "kafka":
        w.option("kafka.bootstrap.servers", bootstrap).save()       # the records name their topic
    else:
        w.mode("overwrite").save(path)


def parse_events(df: DataFrame, schema, col: str = "value") -> DataFrame:
    """P20: JSON text -> typed columns, PERMISSIVE; rows that do not parse get
    ``_ok = false`` (to be quarantined) instead of failing the job."""
    parsed = df.withColumn("_parsed", F.from_json(F.col(col).cast("string"), schema,
                                                  {"mode": "PERMISSIVE"}))
    ok = F.try_parse_json(F.col(col).cast("string")).isNotNull()
    return parsed.select("*", ok.alias("_ok")).select(
        *[c for c in df.columns], *[F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields
                                    if f.name not in df.columns], "_ok")
