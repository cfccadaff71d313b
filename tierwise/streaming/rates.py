"""Rate changes on a stream.

An observation that arrives late is the previous one of the observation after
it, so a change can't be settled when a row arrives. The stream therefore lands
its observations by day, exactly once (a batch that runs again overwrites its
own files), and the changes are taken when they are read, by the batch operator
over the landed days. Any order of arrival and any cut into batches or files
gives the same rows, with built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import observations, rate_changes


def land_rates(stream: DataFrame, path: str, checkpoint: str, order_col: str = "date",
               drain: bool = True) -> StreamingQuery:
    """(series_id, label, <order_col>, value) stream -> observations by day."""
    def write(batch: DataFrame, epoch: int) -> None:
        day = F.coalesce(F.to_date(F.col(order_col)).cast("string"), F.lit("unknown"))
        observations(batch, order_col).withColumn("day", day).write.mode("overwrite") \
            .partitionBy("day").parquet(f"{path}/_epoch={epoch}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if drain else w.trigger(processingTime="1 minute")).start()


def read_rate_changes(spark: SparkSession, path: str, order_col: str = "date") -> DataFrame:
    """The changes over all landed observations."""
    return rate_changes(spark.read.parquet(path).drop("_epoch", "day"), order_col)
