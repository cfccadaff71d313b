"""Declared schemas and fixed domain constants.

Raw data is never schema-inferred: every reader passes one of these.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
F32 = T.FloatType()
F64 = T.DoubleType()

# Raw loan event: all values are text (JSON strings), plus bridge metadata.
RAW_LOAN_FIELDS = [
    "loan_amount", "loan_type", "action_taken", "ltv", "dti", "income",
    "interest_rate", "denial_reason_1", "state", "county_code",
    "property_value", "event_type", "ingestion_timestamp",
]
RAW_LOAN = T.StructType(
    [T.StructField("loan_id", S)]
    + [T.StructField(c, S) for c in RAW_LOAN_FIELDS]
    + [T.StructField("_source_topic", S), T.StructField("_bridge_ts", T.LongType())]
)

# Loan CSV as published by the public loan register: header row, all text.
LOAN_CSV_FIELDS = [
    "loan_amount", "loan_type", "action_taken", "loan_to_value_ratio",
    "debt_to_income_ratio", "income", "interest_rate", "denial_reason_1",
    "state_code", "county_code", "property_value",
]

RATE = T.StructType([
    T.StructField("series_id", S), T.StructField("label", S),
    T.StructField("date", T.DateType()), T.StructField("value", F64),
    T.StructField("rate_change_bps", F64), T.StructField("event_type", S),
    T.StructField("ingestion_timestamp", S),
])

MACRO_KEYS = ["fed_funds_rate", "treasury_yield_10yr", "unemployment_rate", "cpi"]
MACRO = T.StructType(
    [T.StructField("date", S)]
    + [T.StructField(k, F64) for k in MACRO_KEYS]
    + [T.StructField("macro_stress_index", F64), T.StructField("event_type", S),
       T.StructField("ingestion_timestamp", S)]
)

# Indicator payload: {"data": [{"date": ..., "value": ...}, ...]}
INDICATOR_JSON = T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("date", S), T.StructField("value", S)]))),
])

COUNTY = T.StructType([
    T.StructField("county_fips", S), T.StructField("county_name", S),
    T.StructField("median_home_value", F64), T.StructField("median_income", F64),
    T.StructField("owner_occupied_units", F64), T.StructField("state_code", S),
    T.StructField("county_risk_index", F64),
])

# Census-style input columns (all text).
CENSUS_FIELDS = ["NAME", "B25077_001E", "B19013_001E", "B25003_002E", "state", "county"]

GOLD_COLUMNS = [
    "loan_amount", "ltv", "dti", "interest_rate", "income",
    "ltv_score", "dti_score", "rate_spread_score", "macro_stress_score",
    "risk_score", "risk_tier", "processing_date", "action_taken", "loan_type",
    "year", "month", "day",
]
# Columns the reference drops at gold; we carry them by default (see README).
GOLD_CARRY = ["loan_id", "state", "county_code", "ingestion_timestamp"]
PARTITION_COLS = ["year", "month", "day"]

# Fixed values that must equal the reference's.
TIERS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
HIGH_RISK_TIERS = ["CRITICAL", "HIGH"]
VALID_ACTIONS = ["1", "2", "3", "4", "5", "6", "7", "8"]
VALID_LOAN_TYPES = ["1", "2", "3", "4"]
TOPICS = ["loan-applications", "mortgage-rates", "macro-indicators"]
EVENT_LOAN = "loan_application"
EVENT_RATE = "mortgage_rate"
EVENT_MACRO = "macro_indicator"
OBSERVATION_START = "2020-01-01"
RATE_SERIES = {
    "MORTGAGE30US": "30-Year Fixed Mortgage Rate",
    "MORTGAGE15US": "15-Year Fixed Mortgage Rate",
    "DRSFRMACBS": "Mortgage Delinquency Rate",
    "DRCCLACBS": "Credit Card Delinquency Rate",
    "DGS10": "10-Year Treasury Yield",
}
STATE_FIPS_CODE = {"51": "VA", "24": "MD", "11": "DC"}
