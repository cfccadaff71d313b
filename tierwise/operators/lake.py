"""Raw -> silver -> gold (P1-P5, F1, F2, M1-M6) and the lake sinks.

``clean_raw`` and ``score`` are narrow (no shuffle); ``gold = score(clean_raw(raw))``
composes into one scan -> project -> filter stage. Writes are the only
actions here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import decode_dti, na_float, pad2
from ..functions.scoring import apply_score
from ..policies import GOLD, Policy
from ..schemas import (
    GOLD_CARRY, GOLD_COLUMNS, PARTITION_COLS, VALID_ACTIONS, VALID_LOAN_TYPES,
)
from ..sources.files import read_lake


# ---------------------------------------------------------------- silver

def drop_null_amount(df: DataFrame) -> DataFrame:
    """F1."""
    return df.where(F.col("loan_amount").isNotNull())


def valid_codes(df: DataFrame, actions=VALID_ACTIONS, types=VALID_LOAN_TYPES) -> DataFrame:
    """F2: code membership compared as text ("01", "1.0", null are rejected)."""
    return df.where(F.col("action_taken").isin(list(actions)) & F.col("loan_type").isin(list(types)))


def stamp_date(df: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """processing_date = as_of (date text or Column) or today."""
    if as_of is None:
        d = F.current_date()
    elif isinstance(as_of, Column):
        d = as_of.cast("date")
    else:
        d = F.lit(as_of).cast("date")
    return df.withColumn("processing_date", d)


def with_partition_cols(df: DataFrame, date_col: str = "processing_date") -> DataFrame:
    """Year text, zero-padded month/day text."""
    d = F.col(date_col)
    return df.withColumns({"year": F.year(d).cast("string"), "month": pad2(F.month(d)),
                           "day": pad2(F.dayofmonth(d))})


def clean_raw(raw: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Raw loan events -> silver rows.

    Numeric text -> float (NA/unparseable -> null), DTI bands decoded,
    null amounts and invalid codes dropped, date stamped, partition columns
    added. All other raw columns are carried through, as in the reference.
    """
    typed = raw.withColumns({
        "loan_amount": na_float("loan_amount"),
        "ltv": na_float("ltv"),
        "income": na_float("income"),
        "interest_rate": na_float("interest_rate"),
        "dti": decode_dti("dti"),
    })
    out = valid_codes(drop_null_amount(typed))
    return with_partition_cols(stamp_date(out, as_of))


# ---------------------------------------------------------------- gold

def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """P5: keep listed columns that exist, in list order."""
    have = set(df.columns)
    return df.select([c for c in cols if c in have])


def score(silver: DataFrame, policy: Policy = GOLD, carry: list[str] | None = None,
          macro: float | Column | None = None) -> DataFrame:
    """Silver -> gold: sub-scores, weighted score and tier in one projection."""
    keep = list(GOLD_CARRY if carry is None else carry)
    scored = apply_score(silver, policy, macro=macro)
    cols = keep + [c for c in GOLD_COLUMNS if c not in keep]
    return select_existing(scored, cols)


# ---------------------------------------------------------------- sinks

def _partitioned_write(df: DataFrame, path: str, mode: str, max_records: int, dynamic: bool,
                       one_day: bool = False) -> None:
    """Partitioned parquet write with bounded file counts and no hot task.

    The REBALANCE hint shuffles rows by the partition columns and lets AQE
    size the write tasks: a day holding a third of all rows is split over
    several tasks (advisory partition size), and many small days are
    coalesced into one task — so no task writes to every directory and no
    single task writes a whole hot day. ``maxRecordsPerFile`` caps file size.

    ``one_day=True`` (a run that stamps one processing date): every row goes
    to the same directory, so the shuffle would only re-split what it moved;
    each input task writes its own files there instead.
    """
    laid = df if one_day else df.hint("rebalance", *PARTITION_COLS)
    w = (laid.write.mode(mode).option("maxRecordsPerFile", max_records)
         .option("partitionOverwriteMode", "dynamic" if dynamic else "static"))
    w.partitionBy(*PARTITION_COLS).parquet(path)


def write_silver(df: DataFrame, path: str, mode: str = "overwrite",
                 max_records: int = 5_000_000, dynamic: bool = False, one_day: bool = False) -> None:
    """K1: silver parquet by year/month/day. Static overwrite by default."""
    _partitioned_write(df, path, mode, max_records, dynamic, one_day)


def write_gold(df: DataFrame, path: str, mode: str = "overwrite",
               max_records: int = 5_000_000, dynamic: bool = False, one_day: bool = False) -> None:
    """K2: gold parquet by year/month/day."""
    _partitioned_write(df, path, mode, max_records, dynamic, one_day)


def write_lookup(df: DataFrame, out_dir: str) -> None:
    """K3: same rows to parquet and header CSV."""
    df.write.mode("overwrite").parquet(f"{out_dir}/parquet")
    df.write.mode("overwrite").option("header", True).csv(f"{out_dir}/csv")


def materialize(df: DataFrame, name: str, kind: str = "table", path: str | None = None) -> DataFrame:
    """K7/K8: ``view`` -> temp view; ``table`` -> rewritten table each run."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if path is not None:
        df.write.mode("overwrite").parquet(path)
        spark.read.parquet(path).createOrReplaceTempView(name)
        return spark.table(name)
    df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def load_gold(spark: SparkSession, path: str, table: str) -> DataFrame:
    """K9: bulk load gold parquet into a managed table."""
    read_lake(spark, path).write.mode("overwrite").saveAsTable(table)
    return spark.table(table)


def register_layer(spark: SparkSession, path: str, prefix: str, name: str,
                   partitioned: bool = True) -> DataFrame:
    """Register a lake path as table ``{prefix}_{name}``.

    Schema comes from the files (merged across versions); partitions are
    discovered with RECOVER PARTITIONS.
    """
    table = f"{prefix}_{name}"
    schema = spark.read.option("mergeSchema", True).parquet(path).schema
    data_cols = [f for f in schema.fields if f.name not in PARTITION_COLS]
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data_cols)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    if partitioned and all(c in schema.names for c in PARTITION_COLS):
        spark.sql(f"CREATE TABLE {table} ({cols}, year string, month string, day string) "
                  f"USING parquet PARTITIONED BY (year, month, day) LOCATION '{path}'")
        spark.catalog.recoverPartitions(table)
    else:
        spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet LOCATION '{path}'")
    return spark.table(table)


def sql(spark: SparkSession, text: str) -> DataFrame:
    """Ad-hoc SQL over registered layers."""
    return spark.sql(text)


def write_report(df: DataFrame, path: str) -> None:
    """Report rows as JSON (one small file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_silver_path(spark: SparkSession, path: str) -> DataFrame:
    """silver/gold tree with text partition values, whatever the session infers (``files.read_lake``)."""
    return read_lake(spark, path)
