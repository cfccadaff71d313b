"""Ingest transforms.

The reference runs these as single-process loops over API responses; here
each is a DataFrame job over landed records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import coerce_double, first_part, iso_now, null_if_negative, state_code
from ..functions.scoring import county_risk_index, macro_index
from ..schemas import EVENT_LOAN, EVENT_MACRO, EVENT_RATE, MACRO_KEYS, OBSERVATION_START
from .ordered import previous
from .quantiles import median


# ---------------------------------------------------------------- loans

def non_empty(df: DataFrame, cols=("loan_amount", "loan_to_value_ratio")) -> DataFrame:
    """skip rows whose trimmed text is empty (null counts as empty); "NA" kept."""
    cond = None
    for c in cols:
        x = F.coalesce(F.trim(F.col(c)), F.lit("")) != F.lit("")
        cond = x if cond is None else cond & x
    return df.where(cond)


def loan_event(csv_rows: DataFrame, ingested_at=None) -> DataFrame:
    """P6 + P7 + P8: loan-register CSV rows -> 13-field loan events (text).

    Renames ltv/dti/state, trims amount and ltv, missing fields -> "".
    """
    def g(c):
        return F.coalesce(F.col(c), F.lit("")) if c in csv_rows.columns else F.lit("")
    rows = non_empty(csv_rows)
    return rows.select(
        F.trim(g("loan_amount")).alias("loan_amount"),
        g("loan_type").alias("loan_type"),
        g("action_taken").alias("action_taken"),
        F.trim(g("loan_to_value_ratio")).alias("ltv"),
        g("debt_to_income_ratio").alias("dti"),
        g("income").alias("income"),
        g("interest_rate").alias("interest_rate"),
        g("denial_reason_1").alias("denial_reason_1"),
        g("state_code").alias("state"),
        g("county_code").alias("county_code"),
        g("property_value").alias("property_value"),
        F.lit(EVENT_LOAN).alias("event_type"),
        (ingested_at if ingested_at is not None else iso_now()).alias("ingestion_timestamp"),
    )


# ---------------------------------------------------------------- rates

def since(df: DataFrame, date_col: str = "date", start: str = OBSERVATION_START) -> DataFrame:
    """drop empty/null dates and dates before ``start`` (text order)."""
    d = F.col(date_col).cast("string")
    return df.where(d.isNotNull() & (d != "") & (d >= F.lit(start)))


def drop_missing(df: DataFrame, col: str = "value", marker: str = ".") -> DataFrame:
    """drop the missing marker and NaN/null values."""
    c = F.col(col)
    if dict(df.dtypes)[col] == "string":
        return df.where(c.isNotNull() & (c != F.lit(marker)))
    return df.where(c.isNotNull() & ~F.isnan(c))


def observations(rates: DataFrame, order_col: str = "date") -> DataFrame:
    """F5 on rate rows: the missing marker, null and NaN go, then text becomes a number."""
    obs = drop_missing(rates.select("series_id", "label", order_col, "value"))
    return drop_missing(obs.withColumn("value", coerce_double("value") if dict(obs.dtypes)["value"] == "string"
                                       else F.col("value").cast("double")))


def rate_changes(rates: DataFrame, order_col: str = "date", ingested_at=None, partitions: int | None = None) -> DataFrame:
    """Change against the previous observation of the same series, in bps.

    (value - previous) * 100, first observation of a series 0.0; missing
    observations dropped first; equal times are ordered by value.

    Skew-safe: rows are dealt out by ranges of (series, time, value), so neither a series that holds
    a third of all rows nor a burst within a second is one task (``ordered.previous``).
    """
    out = previous(observations(rates, order_col), "series_id", [order_col, "value"], "value", "_prev_value", partitions)
    return out.select(
        "series_id", "label", order_col, "value",
        F.coalesce((F.col("value") - F.col("_prev_value")) * F.lit(100.0), F.lit(0.0)).alias("rate_change_bps"),
        F.lit(EVENT_RATE).alias("event_type"),
        (ingested_at if ingested_at is not None else iso_now()).alias("ingestion_timestamp"),
    )


# ---------------------------------------------------------------- macro

def macro_snapshots(indicators_long: DataFrame, keys=MACRO_KEYS, ingested_at=None) -> DataFrame:
    """J1 + F6 + A2 + M11: long indicator rows -> one complete snapshot per date.

    Input (date, indicator, value, seq). One shuffle: group by date with one
    conditional ``max_by`` per indicator (the later observation wins), then
    drop dates lacking any indicator and compute the stress index.
    """
    df = drop_missing(since(indicators_long, "date"), "value")
    if dict(df.dtypes)["value"] == "string":
        df = drop_missing(df.withColumn("value", coerce_double("value")), "value")
    aggs = [F.max_by(F.when(F.col("indicator") == k, F.col("value")),
                     F.when(F.col("indicator") == k, F.col("seq"))).alias(k) for k in keys]
    wide = complete(df.groupBy("date").agg(*aggs), keys)
    return wide.select(
        "date", *keys, macro_index().alias("macro_stress_index"),
        F.lit(EVENT_MACRO).alias("event_type"),
        (ingested_at if ingested_at is not None else iso_now()).alias("ingestion_timestamp"),
    )


# ---------------------------------------------------------------- county

# fixed values: public field codes
NUMERIC_MAP = {"B25077_001E": "median_home_value", "B19013_001E": "median_income",
               "B25003_002E": "owner_occupied_units"}


def median_fill(df: DataFrame, cols: list[str]) -> DataFrame:
    """A16 + A17: fill nulls of each column with that column's exact median.

    The medians are a (len(cols))-row aggregate folded into one struct and
    attached as a scalar subquery (evaluated once, no join).
    """
    med = median(df, cols)
    one = med.agg(F.struct(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c)
                             for c in cols]).alias("m"))
    m = one.scalar()
    return df.select(*[F.coalesce(F.col(c), m.getField(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def county_lookup(census: DataFrame) -> DataFrame:
    """P11-P15 + A16/A17 + M12: census rows (text) -> county dimension."""
    typed = census.select(
        F.concat(F.col("state"), F.col("county")).alias("county_fips"),
        first_part("NAME").alias("county_name"),
        *[null_if_negative(coerce_double(raw)).alias(new) for raw, new in NUMERIC_MAP.items()],
        state_code("state").alias("state_code"),
    )
    filled = median_fill(typed, list(NUMERIC_MAP.values()))
    return filled.select("county_fips", "county_name", "median_home_value", "median_income",
                         "owner_occupied_units", "state_code",
                         county_risk_index().alias("county_risk_index"))


def complete(df: DataFrame, cols=MACRO_KEYS) -> DataFrame:
    """drop rows lacking any of the given columns."""
    return df.dropna("any", subset=list(cols))
