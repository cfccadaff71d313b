"""The row before, for any distribution of the order.

Rows are range-partitioned by the whole order (groups, order columns, and a number of the row, so
that equal rows split as well): a partition is an even share of the rows however they
cluster in time or groups. ``lag`` runs within partitions; the first row of a group in a partition takes
the group's last value in the nearest partition before: a prefix scan over
(partition, group) ends, of which there are at most partitions + groups.

The ranged rows are written once to the shared folder: the ends and the rows must come from one partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def ranged(df: DataFrame, group: str, order: list[str], value: str, partitions: int | None = None) -> DataFrame:
    """df with _part (number of its range, in order), _prev (the value before within the range and group),
    _first and _last (whether the row is the group's first or last in the range)."""
    keys = [group, *order, "_row"]
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(partitions, *keys) if partitions else numbered.repartitionByRange(*keys)
    dealt = dealt.withColumn("_part", F.spark_partition_id())
    w = Window.partitionBy("_part", group).orderBy(*order, "_row")
    return dealt.withColumns({"_prev": F.lag(value).over(w), "_first": F.row_number().over(w) == 1,
                              "_last": F.lead(F.lit(True)).over(w).isNull()})


def previous(df: DataFrame, group: str, order: list[str], value: str, name: str = "previous", partitions: int | None = None) -> DataFrame:
    """df with the ``value`` (not null) of the group's row before in the order, null for its first; ties by any of the equal rows."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranged")
    marked = ranged(df, group, order, value, partitions)
    marked.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(marked.schema).parquet(path)
    ends = rows.where("_last").select(F.col(group).alias("_g"), F.col("_part").alias("_p"), F.col(value).alias("_v"))
    carry = ends.withColumn("_carry", F.lag("_v").over(Window.partitionBy("_g").orderBy("_p"))).drop("_v")
    first = rows.where("_first").join(carry, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")), "left")
    extra = ["_row", "_part", "_prev", "_first", "_last"]
    inner = rows.where("NOT _first").withColumn(name, F.col("_prev"))
    return inner.drop(*extra).unionByName(first.withColumn(name, F.col("_carry")).drop(*extra, "_g", "_p", "_carry"))
