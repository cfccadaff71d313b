"""Ingest transforms and file sources."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tierwise.operators import ingest
from tierwise.sources import files


def test_rate_changes_across_chunks_matches_sequential(spark):
    rows = []
    for sid, n in (("A", 60), ("B", 5)):
        for i in range(n):
            v = float("nan") if i == 7 else round(3 + (i * 37 % 11) / 10, 2)
            rows.append((sid, sid, pd.Timestamp("2024-01-01") + pd.Timedelta(hours=9 * i), v))
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["series_id", "label", "date", "value"]))
    got = ingest.rate_changes(df, order_col="date").toPandas()
    exp = []
    for sid in ("A", "B"):
        prev = None
        for r in sorted((r for r in rows if r[0] == sid and r[3] == r[3]), key=lambda r: r[2]):
            exp.append((sid, r[2], 0.0 if prev is None else (r[3] - prev) * 100))
            prev = r[3]
    got = sorted(zip(got.series_id, got.date, got.rate_change_bps))
    assert len(got) == len(exp)
    for (a, b, c), (x, y, z) in zip(got, sorted(exp)):
        assert (a, pd.Timestamp(b)) == (x, y) and c == pytest.approx(z, abs=1e-9)


def test_since_and_drop_missing(spark):
    df = spark.createDataFrame([("2019-12-31", "1"), ("2020-01-01", "."), ("", "2"), (None, "3"),
                                ("2021-05-01", "4.5")], "date string, value string")
    out = ingest.drop_missing(ingest.since(df, "date"), "value").collect()
    assert [(r.date, r.value) for r in out] == [("2021-05-01", "4.5")]


def test_macro_snapshots_latest_wins_and_complete(spark):
    rows = [("2024-01", "fed_funds_rate", 5.0, 1), ("2024-01", "fed_funds_rate", 5.5, 2),
            ("2024-01", "treasury_yield_10yr", 4.0, 1), ("2024-01", "unemployment_rate", 3.9, 1),
            ("2024-01", "cpi", 300.0, 1), ("2024-02", "cpi", 301.0, 1)]
    df = spark.createDataFrame(rows, "date string, indicator string, value double, seq int")
    out = ingest.macro_snapshots(df).collect()
    assert len(out) == 1 and out[0].fed_funds_rate == 5.5
    assert out[0].macro_stress_index == pytest.approx(5.5 / 10 * .4 + 3.9 / 10 * .35 + 300 / 500 * .25)
    assert out[0].event_type == "macro_indicator"


def test_county_lookup_sentinel_and_median(spark):
    rows = [("A County, Virginia", "100000", "50000", "10", "51", "001"),
            ("B County, Maryland", "-666666666", "150000", "x", "24", "003"),
            ("C, DC", "300000", "-1", "30", "11", "001"),
            ("D County, Ohio", "900000", "250000", "20", "39", "005")]
    df = spark.createDataFrame(rows, "NAME string, B25077_001E string, B19013_001E string, "
                                     "B25003_002E string, state string, county string")
    out = {r.county_fips: r for r in ingest.county_lookup(df).collect()}
    assert out["24003"].median_home_value == 300000.0      # median of 100k, 300k, 900k
    assert out["11001"].median_income == 150000.0          # median of 50k, 150k, 250k
    assert out["24003"].owner_occupied_units == 20.0
    assert out["39005"].state_code == "Unknown" and out["51001"].county_name == "A County"
    assert out["39005"].county_risk_index == 1.0
    assert out["51001"].county_risk_index == pytest.approx(50000 / 150000 * .6 + 100000 / 800000 * .4)


def test_loan_csv_to_events(spark, tmp_dir):
    p = os.path.join(tmp_dir, "loans.csv")
    with open(p, "w") as f:
        f.write("loan_amount,loan_type,action_taken,loan_to_value_ratio,debt_to_income_ratio,income,"
                "interest_rate,state_code,county_code\n")
        f.write(" 250000 ,1,1, 80.5 ,<20%,90,6.5,VA,51059\n")
        f.write(",1,1,80,40,90,6.5,VA,51059\n")
        f.write("300000,1,1,,40,90,6.5,VA,51059\n")
        f.write("NA,2,3,NA,NA,NA,NA,MD,24031\n")
    ev = ingest.loan_event(files.read_loans_csv(spark, p), ingested_at=F.lit("t")).collect()
    assert len(ev) == 2
    assert (ev[0].loan_amount, ev[0].ltv, ev[0].dti, ev[0].state, ev[0].property_value) == \
        ("250000", "80.5", "<20%", "VA", "")


def test_census_and_indicator_json(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "va.json"), "w") as f:
        json.dump([["NAME", "B25077_001E", "state", "county"], ["A County, Virginia", "1", "51", "001"],
                   ["B County, Virginia", "2", "51", "003"]], f)
    with open(os.path.join(tmp_dir, "bad.json"), "w") as f:
        f.write("not json")
    rows = files.census_fields(files.read_census_json(spark, os.path.join(tmp_dir, "*.json")),
                               ["NAME", "state", "county"]).collect()
    assert sorted(r.county for r in rows) == ["001", "003"]
    d = os.path.join(tmp_dir, "ind")
    os.makedirs(d)
    with open(os.path.join(d, "cpi.json"), "w") as f:
        json.dump({"data": [{"date": "2024-01-01", "value": "300.1"}, {"date": "2019-01-01", "value": "."}]}, f)
    ind = files.read_indicator_json(spark, d).collect()
    assert {(r.indicator, r.date) for r in ind} == {("cpi", "2024-01-01"), ("cpi", "2019-01-01")}


def test_list_files_and_union(spark):
    from conftest import SF_SMALL
    fl = files.list_files(spark, SF_SMALL, glob="*.parquet", recursive=False)
    assert fl.count() == 14 and set(fl.columns) == {"path", "length", "modificationTime"}
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2,)], "a int")
    assert files.union_all([a, b]).count() == 2


def test_rate_text_with_missing_marker_and_ties(spark):
    rows = [("A", "2024-01-02", "."), ("A", "2024-01-01", "1.0"), ("A", "2024-01-03", "2.0"), ("A", "2024-01-03", "1.5"),
            (None, "2024-01-01", "9"), (None, "2024-01-02", "bad"), (None, "2024-01-02", "8")]
    df = spark.createDataFrame(rows, "series_id string, date string, value string").selectExpr("*", "series_id AS label")
    got = {(r.series_id, r.date, r.value): round(r.rate_change_bps, 6) for r in ingest.rate_changes(df, "date").collect()}
    assert got == {("A", "2024-01-01", 1.0): 0.0, ("A", "2024-01-03", 1.5): 50.0, ("A", "2024-01-03", 2.0): 50.0,
                   (None, "2024-01-01", 9.0): 0.0, (None, "2024-01-02", 8.0): -100.0}
    assert ingest.rate_changes(df.limit(0), "date").count() == 0


def test_census_arrays_ragged_empty_and_bad(spark, tmp_dir):
    import os

    from tierwise.sources import files
    os.makedirs(f"{tmp_dir}/c")
    with open(f"{tmp_dir}/c/a.txt", "w") as f:
        f.write('[["NAME","state"],["x"],["y","51","extra"],["z",null]]\n[]\n\nnot json\n[["NAME"]]\n')
    rows = files.census_fields(files.read_census_json(spark, f"{tmp_dir}/c", lines=True), ["NAME", "state", "none"]).collect()
    assert [tuple(r) for r in rows] == [("x", None, None), ("y", "51", None), ("z", None, None)]


def test_indicator_payloads_reach_the_snapshot_as_numbers(spark, tmp_dir):
    import json
    import os

    from tierwise.schemas import MACRO_KEYS
    from tierwise.sources import files
    os.makedirs(f"{tmp_dir}/i")
    for i, k in enumerate(MACRO_KEYS):
        with open(f"{tmp_dir}/i/{k}.json", "w") as f:
            json.dump({"data": [{"date": "2024-01-01", "value": "9"}, {"date": "2024-01-01", "value": str(i + 1)},
                                {"date": "2024-01-02", "value": "."}]}, f, indent=1)
    m = ingest.macro_snapshots(files.read_indicator_json(spark, f"{tmp_dir}/i"))
    assert [t for c, t in m.dtypes if c in MACRO_KEYS] == ["double"] * 4
    assert [r["date"] for r in m.collect()] == ["2024-01-01"] and m.first()[MACRO_KEYS[1]] == 2.0
