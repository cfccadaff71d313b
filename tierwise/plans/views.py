"""Lazy domain layers over a test-data directory: raw -> silver -> gold -> stg.

Nothing here runs a job; every function returns an unevaluated DataFrame
whose plan starts at the parquet scan of the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lake, marts
from ..policies import GOLD, Policy
from ..sources import testmap

# Fixed timestamp for processed_at / as-of checks so results are repeatable.
AS_OF_TS = "2002-01-01 00:00:00"
AS_OF_DATE = "2002-01-01"


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testmap.raw_loans(spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw(spark, sf_dir)
    return lake.clean_raw(r, as_of=F.col("landed_date")).drop("landed_date")


def gold(spark: SparkSession, sf_dir: str, policy: Policy = GOLD) -> DataFrame:
    return lake.score(silver(spark, sf_dir), policy)


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.stg_loan_risk_scores(gold(spark, sf_dir), as_of_ts=AS_OF_TS)
