"""Raw -> silver cleaning vectors (NA / unparseable / banded DTI / code filter)."""

import pytest
from pyspark.sql import functions as F

from tierwise.functions.cleaning import (
    capped, clamp01, coerce_double, decode_dti, first_part, na_float, null_if_negative, state_code,
)
from tierwise.operators import lake
from tierwise.schemas import RAW_LOAN


@pytest.mark.parametrize("text,num,dti", [
    ("NA", None, None), ("", None, None), ("Exempt", None, None),
    ("<20%", None, 20.0), ("20%-<30%", None, 25.0), ("30%-<36%", None, 33.0),
    ("50%-60%", None, 55.0), (">60%", None, 60.0), ("41", 41.0, 41.0), ("NaN", None, None)])
def test_cleaning_vectors(spark, text, num, dti):
    r = spark.createDataFrame([(text,)], "v string").select(
        na_float("v").alias("n"), decode_dti("v").alias("d")).first()
    assert r.n == num and r.d == dti


def _raw(spark, rows):
    full = []
    for action, ltype in rows:
        d = {c: None for c in RAW_LOAN.fieldNames()}
        d.update(loan_amount="100000", ltv="80", dti="40", income="50", interest_rate="5",
                 action_taken=action, loan_type=ltype)
        full.append(d)
    return spark.createDataFrame(full, RAW_LOAN)


def test_code_filter(spark):
    rows = [("1", "1"), ("", "1"), ("01", "1"), ("1.0", "1"), (" 1", "1"), (None, "1"), ("9", "1"), ("1", "5")]
    out = lake.clean_raw(_raw(spark, rows), as_of="2024-04-07").collect()
    assert len(out) == 1 and out[0].action_taken == "1"
    assert (out[0].year, out[0].month, out[0].day) == ("2024", "04", "07")
    assert str(out[0].processing_date) == "2024-04-07"


def test_null_amount_dropped_and_float_types(spark):
    raw = _raw(spark, [("1", "1"), ("2", "2")]).withColumn(
        "loan_amount", F.when(F.col("action_taken") == "2", F.lit("NA")).otherwise(F.col("loan_amount")))
    s = lake.clean_raw(raw, as_of="2024-01-01")
    assert s.count() == 1
    types = dict(s.dtypes)
    assert types["loan_amount"] == "float" and types["dti"] == "double" and types["ltv"] == "float"


def test_float32_boundary_widening(spark):
    # 79.99999999 parses to 80.0f, so it falls in the 80 band after widening
    raw = _raw(spark, [("1", "1")]).withColumn("ltv", F.lit("79.99999999"))
    g = lake.score(lake.clean_raw(raw, as_of="2024-01-01")).first()
    assert g.ltv_score == 0.5


def test_county_helpers(spark):
    df = spark.createDataFrame([("Fairfax County, Virginia", "51", "-666666666", "200000")],
                               "n string, s string, bad string, inc string")
    r = df.select(first_part("n").alias("name"), state_code("s").alias("st"),
                  null_if_negative(coerce_double("bad")).alias("b"),
                  capped(coerce_double("inc"), 150000).alias("c"), clamp01(F.lit(1.7)).alias("k"),
                  state_code(F.lit("99")).alias("u"), capped(F.lit(None).cast("double"), 1.0).alias("cn")).first()
    assert (r.name, r.st, r.b, r.c, r.k, r.u, r.cn) == ("Fairfax County", "VA", None, 1.0, 1.0, "Unknown", None)
