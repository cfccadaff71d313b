"""A micro-batch sink that doesn't grow (K5, A23, T4): epochs merged by levels.

A batch is a run of one epoch. After every ``fan``-th epoch the last ``fan`` runs of a level become one of the next, so
after n epochs a read touches at most (fan - 1) runs a level, of which there are log n. Folders carry the
epochs that they cover (``run-<first>-<last>``) and count once Spark has marked them as complete.

Which runs merge follows from the epoch's number alone, so a batch that is replayed writes the same
folders again. A merged run's parts go only at the next batch (nobody reads them then but readers
who listed before), and a replayed epoch that a complete merged run holds is left as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system

FAN = 8


def _epochs(name: str) -> tuple[int, int] | None:
    kind, *ends = name.split("-")
    return (int(ends[0]), int(ends[1])) if kind == "run" and len(ends) == 2 and all(e.isdigit() for e in ends) else None


def runs(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """Complete runs under path, as (first, last) epochs."""
    fs, at = file_system(spark, path)
    if not fs.exists(at(path)):
        return []
    found = [_epochs(s.getPath().getName()) for s in fs.listStatus(at(path))]
    return sorted(r for r in found if r and fs.exists(at(f"{path}/run-{r[0]}-{r[1]}/_SUCCESS")))


def cover(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The widest runs that don't overlap: what a reader takes."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(found, key=lambda r: (r[0], -r[1])):
        if not out or first > out[-1][1]:
            out.append((first, last))
    return out


@dataclass
class Sink:
    """Batches under ``path``. merge: rows of several runs (with ``_epoch``) to those that stay, by default all."""

    path: str
    merge: Callable[[DataFrame], DataFrame] = lambda df: df
    fan: int = FAN
    partition_by: list[str] = field(default_factory=list)

    def _write(self, df: DataFrame, first: int, last: int) -> None:
        df.write.mode("overwrite").partitionBy(*self.partition_by).parquet(f"{self.path}/run-{first}-{last}")

    def _read(self, spark: SparkSession, chosen: list[tuple[int, int]], schema=None) -> DataFrame:
        reader = spark.read if schema is None else spark.read.schema(schema)
        parts = [reader.parquet(f"{self.path}/run-{a}-{b}") for a, b in chosen]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def write(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        found = runs(spark, self.path)
        if any(a <= epoch <= b and a < b for a, b in found):
            return                                          # replayed, and merged already
        held = cover(found)
        fs, at = file_system(spark, self.path)
        for a, b in found:                                  # parts of what was merged before this batch
            if (a, b) not in held:
                fs.delete(at(f"{self.path}/run-{a}-{b}"), True)
        stamped = batch.withColumn("_epoch", F.lit(epoch).cast("long"))
        self._write(stamped, epoch, epoch)
        span = self.fan
        while (epoch + 1) % span == 0:
            first = epoch + 1 - span
            parts = [r for r in cover([r for r in runs(spark, self.path) if r != (first, epoch)]) if first <= r[0] and r[1] <= epoch]
            self._write(self.merge(self._read(spark, parts, stamped.schema)).select(*stamped.columns), first, epoch)
            span *= self.fan

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        """All rows that stay, with ``_epoch``; the newest of a key may still stand beside older ones."""
        return self._read(spark, cover(runs(spark, self.path)), schema)


def newest(df: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the latest epoch for each key."""
    vals = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*vals), "_epoch").alias("_row")).select(*keys, "_row.*")
