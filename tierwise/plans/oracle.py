"""DuckDB-runnable SQL for every registered query (the correctness oracle).

Written directly in SQL over the pre-registered test tables. Hygiene rules
shared with the Spark side: decimal literals are cast to DOUBLE, float32
columns are widened before output, averages are rounded to 6 places.
"""

from __future__ import annotations



def D(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


RAW_LOANS = """
raw_loans AS (
  SELECT
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
              CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS loan_id,
    CASE WHEN l_partkey % 97 = 0 THEN 'NA' WHEN l_partkey % 89 = 0 THEN ''
         ELSE CAST(l_extendedprice AS VARCHAR) END AS loan_amount,
    CAST(l_suppkey % 6 AS VARCHAR) AS loan_type,
    CAST(l_orderkey % 10 AS VARCHAR) AS action_taken,
    CASE WHEN l_partkey % 23 = 0 THEN 'NA' WHEN l_partkey % 29 = 0 THEN 'Exempt'
         ELSE CAST(60 + CAST(l_quantity AS INTEGER) AS VARCHAR) END AS ltv,
    CASE l_partkey % 20 WHEN 0 THEN 'NA' WHEN 1 THEN '<20%' WHEN 2 THEN '20%-<30%'
         WHEN 3 THEN '30%-<36%' WHEN 4 THEN '50%-60%' WHEN 5 THEN '>60%'
         ELSE CAST(30 + l_partkey % 20 AS VARCHAR) END AS dti,
    CAST(20 + l_partkey * 37 % 200 AS VARCHAR) AS income,
    CASE WHEN l_orderkey % 19 = 0 THEN 'NA'
         ELSE concat(CAST(2 + CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR), '.',
                     CAST(l_linenumber % 4 * 25 AS VARCHAR)) END AS interest_rate,
    CASE l_suppkey % 3 WHEN 0 THEN 'VA' WHEN 1 THEN 'MD' ELSE 'DC' END AS state,
    lpad(CAST(l_suppkey % 200 AS VARCHAR), 3, '0') AS county_code,
    strftime(l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) + to_minutes(CAST(l_linenumber AS INTEGER)),
             '%Y-%m-%dT%H:%M:%S') AS ingestion_timestamp,
    CAST(l_shipdate AS DATE) AS landed_date
  FROM lineitem
)"""

SILVER = """
silver AS (
  SELECT loan_id, state, county_code, ingestion_timestamp, action_taken, loan_type,
    CASE WHEN loan_amount = 'NA' THEN NULL ELSE TRY_CAST(loan_amount AS FLOAT) END AS loan_amount,
    CASE WHEN ltv = 'NA' THEN NULL ELSE TRY_CAST(ltv AS FLOAT) END AS ltv,
    CASE WHEN income = 'NA' THEN NULL ELSE TRY_CAST(income AS FLOAT) END AS income,
    CASE WHEN interest_rate = 'NA' THEN NULL ELSE TRY_CAST(interest_rate AS FLOAT) END AS interest_rate,
    CASE WHEN dti = 'NA' THEN NULL WHEN dti = '<20%' THEN CAST(20 AS DOUBLE)
         WHEN dti = '20%-<30%' THEN CAST(25 AS DOUBLE) WHEN dti = '30%-<36%' THEN CAST(33 AS DOUBLE)
         WHEN dti = '50%-60%' THEN CAST(55 AS DOUBLE) WHEN dti = '>60%' THEN CAST(60 AS DOUBLE)
         ELSE CAST(TRY_CAST(dti AS FLOAT) AS DOUBLE) END AS dti,
    landed_date AS processing_date
  FROM raw_loans
  WHERE (CASE WHEN loan_amount = 'NA' THEN NULL ELSE TRY_CAST(loan_amount AS FLOAT) END) IS NOT NULL
    AND action_taken IN ('1','2','3','4','5','6','7','8')
    AND loan_type IN ('1','2','3','4')
)"""


# The scoring rules, written out (fixed values): not taken from the code that they check.
_GOLD_SUBS = """
CASE WHEN ltv IS NULL THEN 0.5 WHEN ltv < 80 THEN 0.2 WHEN ltv <= 90 THEN 0.5 WHEN ltv <= 95 THEN 0.8 ELSE 1.0 END AS ltv_score,
CASE WHEN dti IS NULL THEN 0.5 WHEN dti < 36 THEN 0.2 WHEN dti <= 43 THEN 0.5 WHEN dti <= 50 THEN 0.8 ELSE 1.0 END AS dti_score,
CASE WHEN interest_rate IS NULL THEN 0.5 WHEN interest_rate < 4 THEN 0.2 WHEN interest_rate <= 6 THEN 0.5
     WHEN interest_rate <= 8 THEN 0.8 ELSE 1.0 END AS rate_spread_score"""
_API_SUBS = """
CASE WHEN ltv IS NULL THEN NULL WHEN ltv < 80 THEN 0.2 WHEN ltv < 90 THEN 0.5 WHEN ltv < 95 THEN 0.8 ELSE 1.0 END AS ltv_score,
CASE WHEN dti IS NULL THEN NULL WHEN dti < 36 THEN 0.2 WHEN dti < 43 THEN 0.5 WHEN dti < 50 THEN 0.8 ELSE 1.0 END AS dti_score,
CASE WHEN interest_rate IS NULL THEN NULL WHEN interest_rate < 4 THEN 0.2 WHEN interest_rate < 6 THEN 0.5
     WHEN interest_rate < 8 THEN 0.8 ELSE 1.0 END AS rate_spread_score"""
_SCORE = (f"ltv_score * {D(0.3)} + dti_score * {D(0.25)} + rate_spread_score * {D(0.25)}"
          f" + macro_stress_score * {D(0.2)}")


def _scored(name: str, src: str, subs: str, score: str, tiers: str) -> str:
    return f"""
{name}_sub0 AS (SELECT *, {subs}, 0.6 AS macro_stress_score FROM {src}),
{name}_sub AS (SELECT * REPLACE (CAST(ltv_score AS DOUBLE) AS ltv_score, CAST(dti_score AS DOUBLE) AS dti_score,
    CAST(rate_spread_score AS DOUBLE) AS rate_spread_score, CAST(macro_stress_score AS DOUBLE) AS macro_stress_score)
  FROM {name}_sub0),
{name}_s AS (SELECT *, {score} AS risk_score FROM {name}_sub),
{name} AS (SELECT *, CASE WHEN risk_score IS NULL THEN NULL {tiers} ELSE 'CRITICAL' END AS risk_tier FROM {name}_s)"""


GOLD_CTE = _scored("gold", "silver", _GOLD_SUBS, _SCORE,
                   f"WHEN risk_score < {D(0.3)} THEN 'LOW' WHEN risk_score <= {D(0.6)} THEN 'MEDIUM' "
                   f"WHEN risk_score <= {D(0.8)} THEN 'HIGH'")
_API_CTE = _scored("api", "valid", _API_SUBS, f"round({_SCORE}, 4)",
                   f"WHEN risk_score < {D(0.3)} THEN 'LOW' WHEN risk_score < {D(0.6)} THEN 'MEDIUM' "
                   f"WHEN risk_score < {D(0.85)} THEN 'HIGH'")
_TESTS_CTE = _scored("tp", "valid", _API_SUBS, f"round({_SCORE}, 3)",
                     f"WHEN risk_score < {D(0.3)} THEN 'LOW' WHEN risk_score < {D(0.6)} THEN 'MEDIUM' "
                     f"WHEN risk_score < {D(0.8)} THEN 'HIGH'")
STG = """
stg AS (
  SELECT loan_id, state, county_code, ingestion_timestamp, loan_amount, ltv, dti, interest_rate, income,
         ltv_score, dti_score, rate_spread_score, macro_stress_score, risk_score, risk_tier,
         processing_date, action_taken AS action_code, loan_type AS loan_type_code
  FROM gold
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = with_(RAW_LOANS, SILVER, GOLD_CTE, STG)


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


SQL: dict[str, str] = {}

SQL["silver_loans"] = with_(RAW_LOANS, SILVER) + f"""
SELECT loan_id, state, action_taken, loan_type, processing_date,
       CAST(loan_amount AS DOUBLE) AS loan_amount, CAST(ltv AS DOUBLE) AS ltv,
       {r6('dti')} AS dti, CAST(interest_rate AS DOUBLE) AS interest_rate,
       CAST(income AS DOUBLE) AS income
FROM silver"""

SQL["gold_scores"] = BASE + f"""
SELECT loan_id, ltv_score, dti_score, rate_spread_score, macro_stress_score,
       {r6('risk_score')} AS risk_score, risk_tier, processing_date
FROM gold"""

SQL["risk_summary"] = BASE + f"""
SELECT risk_tier, count(*) AS loan_count, {r6('avg(risk_score)')} AS avg_risk_score,
       {r6('avg(CAST(loan_amount AS DOUBLE))')} AS avg_loan_amount,
       {r6('avg(CAST(ltv AS DOUBLE))')} AS avg_ltv, {r6('avg(dti)')} AS avg_dti,
       {r6('avg(CAST(interest_rate AS DOUBLE))')} AS avg_interest_rate
FROM stg GROUP BY risk_tier"""

SQL["high_risk_loans"] = BASE + f"""
SELECT loan_id, {r6('risk_score')} AS risk_score, risk_tier, CAST(loan_amount AS DOUBLE) AS loan_amount,
       processing_date, action_code, loan_type_code
FROM stg WHERE risk_tier IN ('CRITICAL', 'HIGH')"""

SQL["daily_trend"] = BASE + f"""
SELECT processing_date, risk_tier, count(*) AS loan_count, {r6('avg(risk_score)')} AS avg_risk_score
FROM stg GROUP BY processing_date, risk_tier"""


# ------------------------------------------------------------ analytics

SQL["portfolio_stats"] = BASE + """
SELECT count(*) AS total_loans,
       coalesce(round(avg(risk_score), 3), 0.0) AS avg_risk_score,
       coalesce(round(avg(CAST(loan_amount AS DOUBLE)), 0), 0.0) AS avg_loan_amount,
       round(coalesce(sum(CASE WHEN risk_tier IN ('CRITICAL','HIGH') THEN CAST(loan_amount AS DOUBLE) END), 0.0)
             / CAST(1e9 AS DOUBLE), 2) AS high_risk_exposure_billions,
       max(processing_date) AS last_updated
FROM stg"""

SQL["tier_distribution"] = BASE + f"""
, c AS (SELECT risk_tier, count(*) AS loan_count FROM stg GROUP BY risk_tier)
SELECT risk_tier, loan_count,
       {r6("CASE WHEN risk_tier IS NOT NULL THEN loan_count / sum(CASE WHEN risk_tier IS NOT NULL THEN loan_count END) OVER () END")} AS share
FROM c"""

SQL["totals_bounds"] = BASE + f"""
SELECT count(*) AS total_loans, {r6('avg(risk_score)')} AS mean_risk_score,
       round(sum(CAST(loan_amount AS DOUBLE)), 2) AS total_amount,
       min(processing_date) AS min_date, max(processing_date) AS max_date,
       min(CAST(loan_amount AS DOUBLE)) AS min_amount, max(CAST(loan_amount AS DOUBLE)) AS max_amount
FROM stg"""

SQL["top_critical"] = BASE + f"""
SELECT loan_id, {r6('risk_score')} AS risk_score, risk_tier, CAST(loan_amount AS DOUBLE) AS loan_amount,
       CAST(ltv AS DOUBLE) AS ltv, {r6('dti')} AS dti, CAST(interest_rate AS DOUBLE) AS interest_rate
FROM stg WHERE risk_tier = 'CRITICAL'
ORDER BY risk_score DESC, loan_id ASC LIMIT 10"""

SQL["high_risk_head"] = BASE + f"""
SELECT loan_id, {r6('risk_score')} AS risk_score, risk_tier, CAST(loan_amount AS DOUBLE) AS loan_amount
FROM stg WHERE risk_tier IN ('CRITICAL', 'HIGH')
ORDER BY risk_score DESC, loan_id ASC LIMIT 100"""

SQL["segment_filter"] = BASE + """
SELECT loan_id, state, CAST(loan_amount AS DOUBLE) AS loan_amount, risk_tier
FROM stg WHERE state IN ('VA', 'MD')
  AND CAST(loan_amount AS DOUBLE) BETWEEN CAST(10000.0 AS DOUBLE) AND CAST(60000.0 AS DOUBLE)"""

_DESC = ["loan_amount", "ltv", "dti", "interest_rate", "risk_score"]
SQL["describe_stats"] = BASE + ", long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS metric, CAST({c} AS DOUBLE) AS v FROM stg" for c in _DESC) + f""")
SELECT metric, count(v) AS count, {r6('avg(v)')} AS mean, {r6('stddev_samp(v)')} AS std,
       {r6('min(v)')} AS min, {r6('quantile_cont(v, 0.25)')} AS q25, {r6('quantile_cont(v, 0.5)')} AS q50,
       {r6('quantile_cont(v, 0.75)')} AS q75, {r6('max(v)')} AS max
FROM long GROUP BY metric"""

_CORR = ["ltv", "dti", "interest_rate", "risk_score"]
SQL["corr_matrix"] = BASE + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr FROM stg"
    for a in _CORR for b in _CORR)

SQL["daily_stats"] = BASE + f"""
SELECT processing_date AS date, {r6('avg(risk_score)')} AS mean, {r6('max(risk_score)')} AS max,
       {r6('min(risk_score)')} AS min
FROM stg GROUP BY processing_date"""

SQL["trend_delta"] = BASE + f"""
, d AS (SELECT processing_date AS date, avg(risk_score) AS mean, max(risk_score) AS mx FROM stg GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY date DESC) AS rn FROM d),
a AS (SELECT max(CASE WHEN rn = 1 THEN date END) AS latest_date,
             max(CASE WHEN rn = 1 THEN mean END) AS latest,
             coalesce(max(CASE WHEN rn = 2 THEN mean END), max(CASE WHEN rn = 1 THEN mean END)) AS previous
      FROM r WHERE rn <= 2)
SELECT latest_date, {r6('latest')} AS latest, {r6('previous')} AS previous, {r6('latest - previous')} AS delta,
       {r6('(SELECT max(mx) FROM d)')} AS peak, {r6('latest * CAST(1.05 AS DOUBLE)')} AS projected_30d,
       {r6('latest - CAST(0.45 AS DOUBLE)')} AS vs_benchmark
FROM a"""

SQL["state_tier_rollup"] = BASE + """
SELECT state, risk_tier, round(sum(CAST(loan_amount AS DOUBLE)), 2) AS total_amount,
       CAST(GROUPING(state, risk_tier) AS BIGINT) AS level
FROM stg GROUP BY ROLLUP (state, risk_tier)"""

SQL["box_by_type"] = BASE + f"""
, q AS (SELECT loan_type_code, count(risk_score) AS n, min(risk_score) AS mn,
               quantile_cont(risk_score, 0.25) AS q1, quantile_cont(risk_score, 0.5) AS med,
               quantile_cont(risk_score, 0.75) AS q3, max(risk_score) AS mx
        FROM stg GROUP BY loan_type_code)
  , f AS (SELECT *, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lf, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS uf FROM q),
  w AS (SELECT s.loan_type_code, min(CASE WHEN s.risk_score >= f.lf THEN s.risk_score END) AS wl,
               max(CASE WHEN s.risk_score <= f.uf THEN s.risk_score END) AS wh,
               count(*) FILTER (WHERE NOT (s.risk_score BETWEEN f.lf AND f.uf)) AS outliers
        FROM stg s JOIN f ON s.loan_type_code = f.loan_type_code WHERE s.risk_score IS NOT NULL
        GROUP BY s.loan_type_code)
SELECT f.loan_type_code, n, {r6('mn')} AS min, {r6('q1')} AS q1, {r6('med')} AS median, {r6('q3')} AS q3,
       {r6('mx')} AS max, {r6('lf')} AS lower_fence, {r6('uf')} AS upper_fence,
       {r6('wl')} AS whisker_low, {r6('wh')} AS whisker_high, outliers
FROM f LEFT JOIN w ON f.loan_type_code = w.loan_type_code"""

_PROBES = [0.3, 0.45, 0.52, 0.6, 0.75, 0.85]
SQL["pct_rank"] = BASE + " UNION ALL ".join(
    f"SELECT {D(x)} AS score, {r6(f'avg(CASE WHEN risk_score < {D(x)} THEN 1.0 ELSE 0.0 END) * 100')} AS pct_rank FROM stg"
    for x in _PROBES)

SQL["exposure_by_tier"] = BASE + f"""
SELECT risk_tier, count(*) AS loan_count, {r6('avg(CAST(loan_amount AS DOUBLE))')} AS avg_amount,
       {r6('sum(CAST(loan_amount AS DOUBLE)) / CAST(1e9 AS DOUBLE)')} AS exposure_billions
FROM stg GROUP BY risk_tier"""


# ------------------------------------------------------------ ingest

SQL["rate_bps"] = f"""
SELECT event_type AS series_id, ts, value,
       {r6("coalesce((value - lag(value) OVER (PARTITION BY event_type ORDER BY ts)) * CAST(100.0 AS DOUBLE), CAST(0.0 AS DOUBLE))")} AS rate_change_bps
FROM events WHERE value IS NOT NULL AND NOT isnan(value)"""

_IND = {"click": "fed_funds_rate", "view": "treasury_yield_10yr", "purchase": "unemployment_rate", "signup": "cpi"}
SQL["macro_snapshots"] = f"""
WITH obs AS (
  SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS date,
         CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _IND.items())} END AS indicator,
         value, ts AS seq
  FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup')),
w AS (
  SELECT date, {', '.join(f"arg_max(value, seq) FILTER (WHERE indicator = '{v}') AS {v}" for v in _IND.values())}
  FROM obs WHERE date IS NOT NULL AND date <> '' AND date >= '2020-01-01'
    AND value IS NOT NULL AND NOT isnan(value)
  GROUP BY date)
SELECT date, {r6('fed_funds_rate')} AS fed_funds_rate, {r6('treasury_yield_10yr')} AS treasury_yield_10yr,
       {r6('unemployment_rate')} AS unemployment_rate, {r6('cpi')} AS cpi,
       {r6("least(greatest(fed_funds_rate / CAST(10.0 AS DOUBLE) * CAST(0.40 AS DOUBLE) + unemployment_rate / CAST(10.0 AS DOUBLE) * CAST(0.35 AS DOUBLE) + cpi / CAST(500.0 AS DOUBLE) * CAST(0.25 AS DOUBLE), CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE))")} AS macro_stress_index
FROM w
WHERE fed_funds_rate IS NOT NULL AND treasury_yield_10yr IS NOT NULL AND unemployment_rate IS NOT NULL
  AND cpi IS NOT NULL"""

SQL["county_lookup"] = f"""
WITH c AS (
  SELECT concat(c_name, ' County, X') AS NAME, CAST(c_acctbal * 80 AS VARCHAR) AS home_t,
         CAST(c_acctbal * 15 AS VARCHAR) AS inc_t, CAST(c_custkey % 1000 AS VARCHAR) AS occ_t,
         CASE c_nationkey % 4 WHEN 0 THEN '51' WHEN 1 THEN '24' WHEN 2 THEN '11' ELSE '99' END AS state,
         CAST(c_custkey AS VARCHAR) AS county
  FROM customer),
t AS (
  SELECT concat(state, county) AS county_fips, trim(split_part(NAME, ',', 1)) AS county_name,
         CASE WHEN TRY_CAST(home_t AS DOUBLE) >= 0 THEN TRY_CAST(home_t AS DOUBLE) END AS median_home_value,
         CASE WHEN TRY_CAST(inc_t AS DOUBLE) >= 0 THEN TRY_CAST(inc_t AS DOUBLE) END AS median_income,
         CASE WHEN TRY_CAST(occ_t AS DOUBLE) >= 0 THEN TRY_CAST(occ_t AS DOUBLE) END AS owner_occupied_units,
         coalesce(CASE state WHEN '51' THEN 'VA' WHEN '24' THEN 'MD' WHEN '11' THEN 'DC' END, 'Unknown') AS state_code
  FROM c),
m AS (SELECT median(median_home_value) AS mh, median(median_income) AS mi, median(owner_occupied_units) AS mo FROM t),
f AS (
  SELECT county_fips, county_name, coalesce(median_home_value, mh) AS median_home_value,
         coalesce(median_income, mi) AS median_income, coalesce(owner_occupied_units, mo) AS owner_occupied_units,
         state_code
  FROM t, m)
SELECT county_fips, county_name, {r6('median_home_value')} AS median_home_value, {r6('median_income')} AS median_income,
       {r6('owner_occupied_units')} AS owner_occupied_units, state_code,
       {r6("least(greatest(least(median_income / CAST(150000.0 AS DOUBLE), CAST(1.0 AS DOUBLE)) * CAST(0.6 AS DOUBLE) + least(median_home_value / CAST(800000.0 AS DOUBLE), CAST(1.0 AS DOUBLE)) * CAST(0.4 AS DOUBLE), CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE))")} AS county_risk_index
FROM f"""


# ------------------------------------------------------------ scenarios

_VALID = """
valid AS (
  SELECT * FROM silver
  WHERE loan_amount IS NOT NULL AND CAST(loan_amount AS DOUBLE) > 0 AND CAST(loan_amount AS DOUBLE) <= 10000000
    AND ltv IS NOT NULL AND CAST(ltv AS DOUBLE) >= 0 AND CAST(ltv AS DOUBLE) <= 200
    AND dti IS NOT NULL AND dti >= 0 AND dti <= 100
    AND interest_rate IS NOT NULL AND CAST(interest_rate AS DOUBLE) >= 0 AND CAST(interest_rate AS DOUBLE) <= 30
    AND income IS NOT NULL AND CAST(income AS DOUBLE) >= 0)"""

SQL["api_scores"] = with_(RAW_LOANS, SILVER, _VALID, _API_CTE) + f"""
SELECT loan_id, ltv_score, dti_score, rate_spread_score, {r6('risk_score')} AS risk_score, risk_tier,
       CASE risk_tier WHEN 'CRITICAL' THEN 'Immediate rejection recommended. Exceeds all risk thresholds.'
                      WHEN 'HIGH' THEN 'Loan requires senior underwriter review. High default probability.'
                      WHEN 'MEDIUM' THEN 'Standard underwriting process. Monitor LTV and DTI closely.'
                      WHEN 'LOW' THEN 'Approve with standard terms. Low default risk.' END AS recommendation
FROM api"""

_RULES = [("loan_amount", "CAST(loan_amount AS DOUBLE) <= 0 OR CAST(loan_amount AS DOUBLE) > 10000000"),
          ("ltv", "CAST(ltv AS DOUBLE) < 0 OR CAST(ltv AS DOUBLE) > 200"),
          ("dti", "dti < 0 OR dti > 100"),
          ("interest_rate", "CAST(interest_rate AS DOUBLE) < 0 OR CAST(interest_rate AS DOUBLE) > 30"),
          ("income", "CAST(income AS DOUBLE) < 0")]
_REASONS = [f"CASE WHEN {c} IS NULL OR {cond} THEN '{c} out of range' END" for c, cond in _RULES]
SQL["validated_input"] = with_(RAW_LOANS, SILVER) + f"""
SELECT loan_id, CAST({' + '.join(f'(CASE WHEN ({r}) IS NOT NULL THEN 1 ELSE 0 END)' for r in _REASONS)} AS INTEGER) AS n_reasons,
       concat_ws(';', {', '.join(_REASONS)}) AS reasons
FROM silver"""

_REFRESH_MACRO = "least(greatest(CAST(5.25 AS DOUBLE) * CAST(0.1 AS DOUBLE) + CAST(3.9 AS DOUBLE) * CAST(0.05 AS DOUBLE) - CAST(2.1 AS DOUBLE) * CAST(0.05 AS DOUBLE), CAST(0.0 AS DOUBLE)), CAST(1.0 AS DOUBLE))"
_REFRESHED = f"""
ref_s AS (SELECT loan_id, {_REFRESH_MACRO} AS macro_stress_score,
                 ltv_score * CAST(0.3 AS DOUBLE) + dti_score * CAST(0.25 AS DOUBLE) + rate_spread_score * CAST(0.25 AS DOUBLE)
                 + {_REFRESH_MACRO} * CAST(0.2 AS DOUBLE) AS risk_score FROM gold),
refreshed AS (SELECT *, CASE WHEN risk_score IS NULL THEN NULL WHEN risk_score < CAST(0.3 AS DOUBLE) THEN 'LOW'
                 WHEN risk_score < CAST(0.6 AS DOUBLE) THEN 'MEDIUM' WHEN risk_score < CAST(0.85 AS DOUBLE) THEN 'HIGH'
                 ELSE 'CRITICAL' END AS risk_tier FROM ref_s)"""
SQL["refreshed_scores"] = BASE + "," + _REFRESHED + f"""
SELECT loan_id, {r6('macro_stress_score')} AS macro_stress_score, {r6('risk_score')} AS risk_score, risk_tier
FROM refreshed"""

SQL["refresh_report"] = BASE + "," + _REFRESHED + """
, b AS (SELECT risk_tier, count(*) AS before_count FROM gold GROUP BY risk_tier),
a AS (SELECT risk_tier, count(*) AS after_count FROM refreshed GROUP BY risk_tier)
SELECT coalesce(b.risk_tier, a.risk_tier) AS risk_tier, coalesce(before_count, 0) AS before_count,
       coalesce(after_count, 0) AS after_count
FROM b FULL OUTER JOIN a ON b.risk_tier = a.risk_tier"""

_CONT = ("CAST(ltv AS DOUBLE) / CAST(100.0 AS DOUBLE) * CAST(0.3 AS DOUBLE) + dti / CAST(65.0 AS DOUBLE) * CAST(0.25 AS DOUBLE)"
         " + CAST(interest_rate AS DOUBLE) / CAST(10.0 AS DOUBLE) * CAST(0.25 AS DOUBLE) + CAST(0.12 AS DOUBLE)")


def _cont_tier(s: str) -> str:
    return (f"CASE WHEN {s} IS NULL THEN NULL WHEN {s} < CAST(0.3 AS DOUBLE) THEN 'LOW' WHEN {s} < CAST(0.55 AS DOUBLE) "
            f"THEN 'MEDIUM' WHEN {s} < CAST(0.75 AS DOUBLE) THEN 'HIGH' ELSE 'CRITICAL' END")


SQL["continuous_scores"] = BASE + f"""
, c AS (SELECT loan_id, {_CONT} AS s FROM stg)
SELECT loan_id, {r6('s')} AS continuous_score, {_cont_tier('s')} AS continuous_tier FROM c"""

SQL["contributions"] = BASE + f"""
, h AS (SELECT * FROM stg WHERE risk_tier IN ('CRITICAL', 'HIGH'))
SELECT loan_id, 'LTV' AS factor, {r6('CAST(ltv AS DOUBLE) / CAST(100.0 AS DOUBLE) * CAST(0.3 AS DOUBLE)')} AS impact FROM h
UNION ALL SELECT loan_id, 'DTI', {r6('dti / CAST(65.0 AS DOUBLE) * CAST(0.25 AS DOUBLE)')} FROM h
UNION ALL SELECT loan_id, 'Int Rate', {r6('CAST(interest_rate AS DOUBLE) / CAST(10.0 AS DOUBLE) * CAST(0.25 AS DOUBLE)')} FROM h
UNION ALL SELECT loan_id, 'Macro Stress', CAST(0.12 AS DOUBLE) FROM h"""

_WI = ("CAST(75.0 AS DOUBLE) / CAST(100.0 AS DOUBLE) * CAST(0.3 AS DOUBLE) + dti / CAST(65.0 AS DOUBLE) * CAST(0.25 AS DOUBLE)"
       " + CAST(interest_rate AS DOUBLE) / CAST(10.0 AS DOUBLE) * CAST(0.25 AS DOUBLE) + CAST(0.12 AS DOUBLE)")
SQL["what_if"] = BASE + f"""
, c AS (SELECT loan_id, risk_tier, {_WI} AS s FROM stg),
t AS (SELECT *, {_cont_tier('s')} AS new_tier FROM c)
SELECT loan_id, risk_tier, {r6('s')} AS new_score, new_tier, new_tier <> risk_tier AS tier_changed FROM t"""

SQL["rate_hike"] = BASE + f"""
, m AS (SELECT avg(risk_score) AS mean_score FROM stg),
h AS (SELECT * FROM (VALUES (0.0), (0.5), (1.0), (2.0), (5.0)) v(hike))
SELECT CAST(hike AS DOUBLE) AS hike, {r6('mean_score')} AS mean_score,
       {r6('mean_score + CASE WHEN hike > 0 THEN CAST(hike AS DOUBLE) / CAST(10.0 AS DOUBLE) * CAST(0.25 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END')} AS impacted_score
FROM m, h"""

SQL["critical_count"] = BASE + """
SELECT CAST(count(*) FILTER (WHERE risk_tier = 'CRITICAL' AND processing_date = (SELECT max(processing_date) FROM stg)) AS BIGINT) AS critical_count
FROM stg"""

SQL["hourly_alerts"] = BASE + """
, c AS (SELECT date_trunc('hour', CAST(ingestion_timestamp AS TIMESTAMP)) AS hour, count(*) AS current_count
        FROM stg WHERE risk_tier = 'CRITICAL' GROUP BY 1),
j AS (SELECT c.hour, c.current_count, coalesce(p.current_count, 0) AS previous_count
      FROM c LEFT JOIN c p ON p.hour + INTERVAL 1 HOUR = c.hour)
SELECT hour, current_count, previous_count, current_count - previous_count AS new_critical,
       current_count > previous_count AS alert,
       CASE WHEN current_count > previous_count THEN
         printf('%d new CRITICAL risk loans detected at %s', current_count - previous_count,
                strftime(hour, '%Y-%m-%d %H:%M:%S')) END AS message
FROM j"""


# ------------------------------------------------------------ quality

# The 28 checks, written out (fixed values): kind, column, then their bounds, set or category.
_SUITE = [("exists", c) for c in (
    "loan_amount", "ltv", "dti", "interest_rate", "income", "ltv_score", "dti_score", "rate_spread_score",
    "macro_stress_score", "risk_score", "risk_tier", "processing_date")] + [
    ("not_null", "risk_score"),
    ("not_null", "risk_tier"),
    ("not_null", "loan_amount"),
    ("between", "risk_score", 0.0, 1.0),
    ("between", "ltv", 0.0, 205.0),
    ("between", "dti", 0.0, 100.0),
    ("between", "interest_rate", 0.0, 30.0),
    ("in_set", "risk_tier", "'LOW', 'MEDIUM', 'HIGH', 'CRITICAL'"),
    ("row_count", None, 100.0, 1000000.0),
    ("mean_between", "risk_score", 0.05, 0.95),
    ("share_between", "risk_tier", 0.0, 0.3, "CRITICAL"),
    ("share_between", "risk_tier", 0.0, 0.5, "HIGH"),
    ("share_between", "risk_tier", 0.2, 0.99, "MEDIUM"),
    ("share_between", "risk_tier", 0.0, 0.2, "LOW"),
    ("mean_between", "loan_amount", 50000.0, 2000000.0),
    ("fresh", "processing_date", 30)]


def _suite_sql() -> str:
    parts = []
    for i, (kind, col, *more) in enumerate(_SUITE):
        name = f"{kind}:{col or 'table'}" + (f"={more[2]}" if kind == "share_between" else "")
        tgt = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
        bad = "0"
        if kind == "exists":
            obs, ok = "1.0", "true"
        elif kind in ("not_null", "between", "in_set"):
            cond = {"not_null": lambda: f"{col} IS NULL",
                    "between": lambda: f"{col} IS NOT NULL AND NOT (CAST({col} AS DOUBLE) BETWEEN {D(more[0])} AND {D(more[1])})",
                    "in_set": lambda: f"{col} IS NOT NULL AND {col} NOT IN ({more[0]})"}[kind]()
            bad = f"count(*) FILTER (WHERE {cond})"
            obs, ok = f"CAST({bad} AS DOUBLE)", f"{bad} = 0"
        elif kind == "fresh":
            obs = f"CAST(date_diff('day', max(CAST({col} AS DATE)), DATE '2002-01-01') AS DOUBLE)"
            ok = f"coalesce(({obs}) <= {more[0]}, false)"
        else:
            obs = {"row_count": lambda: "CAST(count(*) AS DOUBLE)",
                   "mean_between": lambda: f"avg(CAST({col} AS DOUBLE))",
                   "share_between": lambda: f"coalesce(count(*) FILTER (WHERE {col} = '{more[2]}') / count({col}), 0.0)"}[kind]()
            ok = f"coalesce(({obs}) BETWEEN {D(more[0])} AND {D(more[1])}, false)"
        src = "" if kind == "exists" else " FROM stg"
        parts.append(f"SELECT {i} AS check_id, '{name}' AS \"check\", {tgt} AS target, {r6(obs)} AS observed, "
                     f"{ok} AS passed, CAST({bad} AS BIGINT) AS unexpected_count{src}")
    return "\nUNION ALL ".join(parts)


SQL["quality_suite"] = BASE + _suite_sql()

SQL["quality_summary"] = BASE + ", s AS (" + _suite_sql() + """)
SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed,
       CASE WHEN count(*) = 0 THEN 1 ELSE count(*) - count(*) FILTER (WHERE passed) END AS failed,
       CASE WHEN count(*) = 0 THEN 0.0 ELSE round(count(*) FILTER (WHERE passed) / count(*) * 100, 1) END AS success_rate
FROM s"""


# The 12 model tests, written out (fixed values): model, column, accepted values (none: not null).
_MODEL_TESTS = [
    ("stg_loan_risk_scores", "risk_score", None),
    ("stg_loan_risk_scores", "risk_tier", None),
    ("stg_loan_risk_scores", "risk_tier", "'LOW', 'MEDIUM', 'HIGH', 'CRITICAL'"),
    ("stg_loan_risk_scores", "loan_amount", None),
    ("mart_risk_summary", "risk_tier", None),
    ("mart_risk_summary", "risk_tier", "'LOW', 'MEDIUM', 'HIGH', 'CRITICAL'"),
    ("mart_high_risk_loans", "risk_score", None),
    ("mart_high_risk_loans", "risk_tier", None),
    ("mart_high_risk_loans", "risk_tier", "'CRITICAL', 'HIGH'"),
    ("mart_high_risk_loans", "loan_amount", None),
    ("mart_daily_risk_trend", "risk_tier", None),
    ("mart_daily_risk_trend", "risk_tier", "'LOW', 'MEDIUM', 'HIGH', 'CRITICAL'")]


def _model_sql() -> str:
    rels = {"stg_loan_risk_scores": "stg",
            "mart_risk_summary": "(SELECT risk_tier, count(*) AS loan_count FROM stg GROUP BY risk_tier)",
            "mart_high_risk_loans": "(SELECT * FROM stg WHERE risk_tier IN ('CRITICAL', 'HIGH'))",
            "mart_daily_risk_trend": "(SELECT processing_date, risk_tier, count(*) AS n FROM stg GROUP BY 1, 2)"}
    return "\nUNION ALL ".join(
        f"SELECT '{model}' AS model, '{col}' AS \"column\", '{'accepted_values' if accepted else 'not_null'}' AS test, "
        f"count(*) FILTER (WHERE {f'{col} IS NOT NULL AND {col} NOT IN ({accepted})' if accepted else f'{col} IS NULL'}) "
        f"AS failures FROM {rels[model]} m" for model, col, accepted in _MODEL_TESTS)


SQL["model_tests"] = BASE + ", t AS (" + _model_sql() + """)
SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM t"""

SQL["warehouse_check"] = BASE + """
, a AS (SELECT count(*) AS cnt, count(*) FILTER (WHERE risk_score IS NULL) AS null_cnt,
               count(*) FILTER (WHERE risk_tier NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')) AS invalid_tier_cnt,
               max(processing_date) AS max_date FROM stg),
e AS (SELECT *, list_filter([
        CASE WHEN cnt <= 100000 THEN printf('Row count %d is not > %d', cnt, 100000) END,
        CASE WHEN null_cnt > 0 THEN printf('Found %d records with NULL risk_score', null_cnt) END,
        CASE WHEN invalid_tier_cnt > 0 THEN printf('Found %d records with invalid risk_tier', invalid_tier_cnt) END,
        CASE WHEN max_date IS NULL OR max_date <> DATE '2002-01-01' THEN
          printf('Max processing_date %s != %s', coalesce(CAST(max_date AS VARCHAR), 'None'), '2002-01-01') END],
        lambda x: x IS NOT NULL) AS errs FROM a)
SELECT cnt, null_cnt, invalid_tier_cnt, max_date,
       CASE WHEN len(errs) = 0 THEN 'PASS' ELSE 'FAIL: ' || array_to_string(errs, ', ') END AS status
FROM e"""


# ------------------------------------------------------------ streaming (must equal batch)

SQL["stream_tier_counts"] = BASE + """
SELECT risk_tier, count(*) AS loan_count FROM gold GROUP BY risk_tier"""

SQL["stream_hourly_alerts"] = SQL["hourly_alerts"]

SQL["stream_bridge"] = """
SELECT 'loan-applications' AS topic, count(*) AS records, count(*) AS sent, CAST(0 AS BIGINT) AS failed,
       CAST(0 AS BIGINT) AS wrapped, count(*) AS keyed FROM lineitem
UNION ALL
SELECT 'mortgage-rates', count(*), count(*) FILTER (WHERE event_type <> 'error'),
       count(*) FILTER (WHERE event_type = 'error'), count(*) FILTER (WHERE event_type = 'signup'),
       count(*) FILTER (WHERE event_type NOT IN ('error', 'signup')) FROM events"""


# ------------------------------------------------------------ more sources / scenarios

SQL["loan_events_csv"] = with_(RAW_LOANS) + """
SELECT trim(loan_amount) AS loan_amount, loan_type, action_taken, trim(ltv) AS ltv, dti, income, interest_rate,
       state, county_code, 'loan_application' AS event_type
FROM raw_loans
WHERE coalesce(trim(loan_amount), '') <> '' AND coalesce(trim(ltv), '') <> ''"""

_WIS = ("s_ltv / CAST(100.0 AS DOUBLE) * CAST(0.3 AS DOUBLE) + dti / CAST(65.0 AS DOUBLE) * CAST(0.25 AS DOUBLE)"
        " + CAST(interest_rate AS DOUBLE) / CAST(10.0 AS DOUBLE) * CAST(0.25 AS DOUBLE) + CAST(0.12 AS DOUBLE)")
SQL["what_if_sweep"] = BASE + f"""
, sc AS (SELECT * FROM (VALUES (60.0), (80.0), (95.0)) v(x)),
c AS (SELECT loan_id, risk_tier, CAST(x AS DOUBLE) AS s_ltv, dti, interest_rate FROM stg, sc),
t AS (SELECT loan_id, risk_tier, s_ltv, {_WIS} AS s FROM c),
u AS (SELECT *, {_cont_tier('s')} AS new_tier FROM t)
SELECT loan_id, s_ltv AS scenario_ltv, {r6('s')} AS new_score, new_tier, new_tier <> risk_tier AS tier_changed FROM u"""


# ------------------------------------------------------------ canonical text for dates and timestamps

_TEXT_COLS = {
    "silver_loans": (["processing_date"], []),
    "gold_scores": (["processing_date"], []),
    "high_risk_loans": (["processing_date"], []),
    "daily_trend": (["processing_date"], []),
    "portfolio_stats": (["last_updated"], []),
    "totals_bounds": (["min_date", "max_date"], []),
    "daily_stats": (["date"], []),
    "trend_delta": (["latest_date"], []),
    "warehouse_check": (["max_date"], []),
    "rate_bps": ([], ["ts"]),
    "hourly_alerts": ([], ["hour"]),
    "stream_hourly_alerts": ([], ["hour"]),
}


def _canonical(sql: str, dates: list[str], stamps: list[str]) -> str:
    repl = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates] + \
           [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in stamps]
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{sql}\n) AS _q"


for _name, (_d, _t) in _TEXT_COLS.items():
    SQL[_name] = _canonical(SQL[_name], _d, _t)

SQL["stream_rate_bps"] = SQL["rate_bps"]

SQL["catalog_sql"] = BASE + f"""
SELECT risk_tier, count(*) AS loan_count, {r6('avg(risk_score)')} AS avg_risk_score FROM gold GROUP BY risk_tier"""

SQL["stream_quality_watch"] = SQL["quality_suite"]

SQL["stream_landing_to_lake"] = BASE + """
SELECT leg || risk_tier AS what, count(*) AS records FROM gold, (VALUES ('tier:'), ('batch:')) l(leg) GROUP BY leg, risk_tier
UNION ALL SELECT 'topic:loan-applications', count(*) FROM lineitem
UNION ALL SELECT 'topic:mortgage-rates', count(*) FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'topic:_quarantine', count(*) FROM events WHERE event_type = 'error' HAVING count(*) > 0"""

SQL["stream_bridge_sink"] = with_(RAW_LOANS) + """
, sent AS (
  SELECT 'loan-applications' AS topic, loan_id AS key, TRY_CAST(loan_amount AS DOUBLE) AS v FROM raw_loans
  UNION ALL
  SELECT 'mortgage-rates', CASE WHEN event_type = 'signup' THEN 'mortgage-rates' ELSE CAST(event_id AS VARCHAR) END, value
  FROM events WHERE event_type <> 'error'),
bad AS (SELECT count(*) AS failed FROM events WHERE event_type = 'error')
SELECT topic, count(*) AS sent, count(DISTINCT key) AS distinct_keys, min(key) AS first_key, count(*) AS tagged,
       count(*) AS stamped, round(sum(v), 2) AS payload_sum,
       CASE WHEN topic = 'mortgage-rates' THEN (SELECT failed FROM bad) ELSE 0 END AS failed,
       (SELECT count(*) FROM sent) AS counted_sent, (SELECT failed FROM bad) AS counted_failed
FROM sent GROUP BY topic"""

SQL["county_from_arrays"] = SQL["county_lookup"]

SQL["macro_from_files"] = SQL["macro_snapshots"]

SQL["rates_from_files"] = SQL["rate_bps"]

SQL["layer_report"] = BASE + """
, w AS (SELECT count(*) AS cnt, count(*) FILTER (WHERE risk_score IS NULL) AS null_cnt,
               count(*) FILTER (WHERE risk_tier NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')) AS odd_cnt,
               max(processing_date) AS max_date FROM stg),
e AS (SELECT list_filter([
        CASE WHEN cnt <= 100000 THEN printf('Row count %d is not > %d', cnt, 100000) END,
        CASE WHEN null_cnt > 0 THEN printf('Found %d records with NULL risk_score', null_cnt) END,
        CASE WHEN odd_cnt > 0 THEN printf('Found %d records with invalid risk_tier', odd_cnt) END,
        CASE WHEN max_date IS NULL OR max_date <> DATE '2002-01-01' THEN
          printf('Max processing_date %s != %s', coalesce(CAST(max_date AS VARCHAR), 'None'), '2002-01-01') END],
        lambda x: x IS NOT NULL) AS errs FROM w),
r AS (
  SELECT '2002-01-01' AS date,
    (SELECT CASE WHEN count(*) = 0 THEN 'FAIL: no rows' ELSE 'PASS' END FROM raw_loans) AS raw_check,
    (SELECT CASE WHEN count(*) = 0 THEN 'FAIL: no rows' ELSE 'PASS' END FROM silver) AS silver_check,
    (SELECT CASE WHEN count(*) = 0 THEN 'FAIL: no rows' ELSE 'PASS' END FROM gold) AS gold_check,
    (SELECT CASE WHEN len(errs) = 0 THEN 'PASS' ELSE 'FAIL: ' || array_to_string(errs, ', ') END FROM e) AS warehouse_check),
n AS (SELECT array_to_string(list_filter([
        CASE WHEN contains(raw_check, 'FAIL') THEN 'raw_check' END, CASE WHEN contains(silver_check, 'FAIL') THEN 'silver_check' END,
        CASE WHEN contains(gold_check, 'FAIL') THEN 'gold_check' END,
        CASE WHEN contains(warehouse_check, 'FAIL') THEN 'warehouse_check' END], lambda x: x IS NOT NULL), ', ') AS checks FROM r)
SELECT r.*, CASE WHEN checks = '' THEN '' ELSE 'Data Quality Alert! Failed checks: ' || checks END AS alert FROM r, n"""

SQL["lake_round_trip"] = BASE + """
SELECT 'silver' AS leg, strftime(processing_date, '%Y-%m') AS part, count(*) AS "rows" FROM silver GROUP BY 2
UNION ALL SELECT 'one_day', '1995-06-01', count(*) FROM silver WHERE strftime(processing_date, '%Y-%m') = '1995-06'
UNION ALL SELECT 'gold', state, count(*) FROM gold GROUP BY state
UNION ALL SELECT leg, risk_tier, count(*) FROM gold,
  (VALUES ('lookup_parquet'), ('lookup_csv'), ('report')) legs(leg) GROUP BY leg, risk_tier"""

_SEGMENT = """
, seg AS (SELECT * FROM stg WHERE state IN ('VA', 'MD')
  AND CAST(loan_amount AS DOUBLE) BETWEEN CAST(10000.0 AS DOUBLE) AND CAST(60000.0 AS DOUBLE))"""

SQL["segment_tiers"] = BASE + _SEGMENT + f"""
, c AS (SELECT risk_tier, count(*) AS loan_count FROM seg GROUP BY risk_tier)
SELECT risk_tier, loan_count, {r6('loan_count / sum(loan_count) OVER ()')} AS share FROM c"""

SQL["segment_corr"] = BASE + _SEGMENT + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr FROM seg"
    for a in _CORR for b in _CORR)

SQL["segment_describe"] = BASE + _SEGMENT + ", long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS metric, CAST({c} AS DOUBLE) AS v FROM seg" for c in _DESC) + f""")
SELECT metric, count(v) AS count, {r6('avg(v)')} AS mean, {r6('stddev_samp(v)')} AS std,
       {r6('min(v)')} AS min, {r6('quantile_cont(v, 0.25)')} AS q25, {r6('quantile_cont(v, 0.5)')} AS q50,
       {r6('quantile_cont(v, 0.75)')} AS q75, {r6('max(v)')} AS max
FROM long GROUP BY metric"""

SQL["loan_drilldown"] = BASE + f"""
, one AS (SELECT * FROM stg WHERE loan_id = (SELECT min(loan_id) FROM stg)),
i AS (
  SELECT loan_id, 'LTV' AS item, CAST(ltv AS DOUBLE) / CAST(100.0 AS DOUBLE) * CAST(0.3 AS DOUBLE) AS v FROM one
  UNION ALL SELECT loan_id, 'DTI', dti / CAST(65.0 AS DOUBLE) * CAST(0.25 AS DOUBLE) FROM one
  UNION ALL SELECT loan_id, 'Int Rate', CAST(interest_rate AS DOUBLE) / CAST(10.0 AS DOUBLE) * CAST(0.25 AS DOUBLE) FROM one
  UNION ALL SELECT loan_id, 'Macro Stress', CAST(0.12 AS DOUBLE) FROM one
  UNION ALL SELECT loan_id, 'LTV ' || CAST(CAST(x AS INTEGER) AS VARCHAR),
    CAST(x AS DOUBLE) / CAST(100.0 AS DOUBLE) * CAST(0.3 AS DOUBLE) + dti / CAST(65.0 AS DOUBLE) * CAST(0.25 AS DOUBLE)
    + CAST(interest_rate AS DOUBLE) / CAST(10.0 AS DOUBLE) * CAST(0.25 AS DOUBLE) + CAST(0.12 AS DOUBLE)
  FROM one, (VALUES (60.0), (80.0), (95.0)) s(x))
SELECT loan_id, item, {r6('v')} AS value FROM i"""

SQL["topic_volume"] = """
WITH o AS (SELECT event_type AS topic, user_id % 8 AS part, max(event_id) + 1 AS n FROM events
           WHERE event_type IN ('click', 'view', 'signup') GROUP BY 1, 2)
SELECT topic, CAST(sum(n) AS BIGINT) AS messages FROM o GROUP BY topic"""

SQL["ordered_marts"] = BASE + """
SELECT 'summary' AS mart, risk_tier AS item, row_number() OVER (ORDER BY a DESC, risk_tier) AS place
FROM (SELECT risk_tier, avg(risk_score) AS a FROM stg GROUP BY 1)
UNION ALL
SELECT 'tiers', risk_tier, row_number() OVER (ORDER BY n DESC, risk_tier) FROM (SELECT risk_tier, count(*) AS n FROM stg GROUP BY 1)
UNION ALL
SELECT 'trend', CAST(processing_date AS VARCHAR) || ' ' || risk_tier, row_number() OVER (ORDER BY processing_date, risk_tier)
FROM (SELECT DISTINCT processing_date, risk_tier FROM stg)"""

SQL["state_union"] = with_(RAW_LOANS) + """
SELECT state, loan_type, count(*) AS loan_count FROM raw_loans GROUP BY 1, 2"""

SQL["hourly_faked_previous"] = _canonical(BASE + """
, c AS (SELECT date_trunc('hour', CAST(ingestion_timestamp AS TIMESTAMP)) AS hour, count(*) AS current_count
        FROM stg WHERE risk_tier = 'CRITICAL' GROUP BY 1)
SELECT hour, current_count, CASE WHEN current_count > 5 THEN current_count - 5 ELSE 0 END AS previous_count FROM c""", [], ["hour"])


SQL["tests_policy_scores"] = with_(RAW_LOANS, SILVER, _VALID, _TESTS_CTE) + f"""
SELECT loan_id, {r6('risk_score')} AS risk_score, risk_tier,
       CASE risk_tier WHEN 'CRITICAL' THEN 'Immediate rejection recommended.'
                      WHEN 'HIGH' THEN 'Requires senior underwriter review.'
                      WHEN 'MEDIUM' THEN 'Standard underwriting process.'
                      WHEN 'LOW' THEN 'Approve with standard terms.' END AS recommendation
FROM tp"""


# ------------------------------------------------------------ layers kept as versions (a run a month)

_MONTHLY = ", mg AS (SELECT * REPLACE (CAST(date_trunc('month', processing_date) AS DATE) AS processing_date) FROM gold)"


def _rescored(name: str, src: str, macro: str) -> str:
    score = (f"ltv_score * {D(0.3)} + dti_score * {D(0.25)} + rate_spread_score * {D(0.25)} + ({macro}) * {D(0.2)}")
    return f"""
, {name}_s AS (SELECT * REPLACE ({score} AS risk_score, {macro} AS macro_stress_score) FROM {src}),
{name} AS (SELECT * REPLACE (CASE WHEN risk_score IS NULL THEN NULL WHEN risk_score < {D(0.3)} THEN 'LOW'
    WHEN risk_score < {D(0.6)} THEN 'MEDIUM' WHEN risk_score < {D(0.85)} THEN 'HIGH' ELSE 'CRITICAL' END AS risk_tier) FROM {name}_s)"""


_NEW_MACRO = (f"CASE WHEN processing_date >= DATE '1997-01-01' THEN {D(4.5)} * {D(0.1)} + {D(4.2)} * {D(0.05)} - {D(2.8)} * {D(0.05)} "
              "ELSE macro_stress_score END")
SQL["refresh_versions"] = (BASE + _MONTHLY + _rescored("m2", "mg", _REFRESH_MACRO) + _rescored("m3", "m2", _NEW_MACRO) + """
, w AS (SELECT count(DISTINCT processing_date) AS all_parts,
               count(DISTINCT CASE WHEN processing_date >= DATE '1997-01-01' THEN processing_date END) AS new_parts FROM mg),
c AS (SELECT 1 AS version, risk_tier, count(*) AS n FROM mg GROUP BY 2 UNION ALL SELECT 2, risk_tier, count(*) FROM m2 GROUP BY 2
      UNION ALL SELECT 3, risk_tier, count(*) FROM m3 GROUP BY 2),
t AS (SELECT DISTINCT v.version, risk_tier FROM c, (VALUES (2), (3)) v(version) WHERE c.version IN (v.version, v.version - 1))
SELECT t.version, t.risk_tier, coalesce(b.n, 0) AS before_count, coalesce(a.n, 0) AS after_count, coalesce(a.n, 0) AS stored_count,
       CASE t.version WHEN 2 THEN all_parts ELSE new_parts END AS written,
       CASE t.version WHEN 2 THEN 0 ELSE all_parts - new_parts END AS kept
FROM t LEFT JOIN c b ON b.version = t.version - 1 AND b.risk_tier IS NOT DISTINCT FROM t.risk_tier
       LEFT JOIN c a ON a.version = t.version AND a.risk_tier IS NOT DISTINCT FROM t.risk_tier, w""")

_AMT = "CAST(loan_amount AS DOUBLE)"
_TXT = "coalesce(CAST({} AS VARCHAR), '')"


def _cells(answer: str, item: str, values: dict, rest: str) -> str:
    return " UNION ALL ".join(f"SELECT '{answer}' AS answer, {item} AS item, '{k}' AS measure, CAST({v} AS DOUBLE) AS value FROM {rest}"
                              for k, v in values.items())


_HI = f"sum(CASE WHEN risk_tier IN ('CRITICAL','HIGH') THEN {_AMT} END)"
SQL["cube_answers"] = BASE + _MONTHLY + "\n" + " UNION ALL ".join([
    _cells("trend", f"{_TXT.format('processing_date')} || '|' || {_TXT.format('risk_tier')}",
           {"loan_count": "count(*)", "avg_risk_score": r6("avg(risk_score)")}, "mg GROUP BY processing_date, risk_tier"),
    _cells("stats", _TXT.format("max(processing_date)"),
           {"total_loans": "count(*)", "avg_risk_score": "round(avg(risk_score), 3)", "avg_loan_amount": f"round(avg({_AMT}), 0)",
            "high_risk_exposure_billions": f"round({_HI} / {D(1e9)}, 2)"}, "mg"),
    _cells("tiers", _TXT.format("risk_tier"),
           {"loan_count": "count(*)", "share": f"CASE WHEN risk_tier IS NOT NULL THEN {r6('count(*) / (SELECT count(risk_tier) FROM mg)')} END"},
           "mg GROUP BY risk_tier"),
    _cells("totals", f"{_TXT.format('min(processing_date)')} || '|' || {_TXT.format('max(processing_date)')}",
           {"total_loans": "count(*)", "mean_risk_score": r6("avg(risk_score)"), "total_amount": f"round(sum({_AMT}), 2)",
            "min_amount": f"round(min({_AMT}), 2)", "max_amount": f"round(max({_AMT}), 2)"}, "mg"),
    _cells("daily", _TXT.format("processing_date"),
           {"mean": r6("avg(risk_score)"), "max": r6("max(risk_score)"), "min": r6("min(risk_score)")}, "mg GROUP BY processing_date"),
    _cells("rollup", f"{_TXT.format('state')} || '|' || {_TXT.format('risk_tier')} || '|' || {_TXT.format('GROUPING(state, risk_tier)')}",
           {"total_amount": f"round(sum({_AMT}), 2)"}, "mg GROUP BY ROLLUP (state, risk_tier)"),
    _cells("update", "''", {"written": "count(DISTINCT 1)", "kept": "count(DISTINCT processing_date) - 1"}, "mg")])

SQL["merged_quantiles"] = BASE + ", long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS metric, CAST({c} AS DOUBLE) AS v FROM stg" for c in _DESC) + f""")
SELECT metric, count(v) AS n, p AS probability, round({D(2.296)} / power(400, {D(0.9723)}), 6) AS rank_error, true AS within
FROM long, (VALUES ({D(0.25)}), ({D(0.5)}), ({D(0.75)})) q(p) GROUP BY metric, p"""

SQL["compacted_layer"] = BASE + _MONTHLY + """
SELECT strftime(processing_date, '%Y-%m') AS month, count(*) AS rows, CAST(ceil(count(*) / 200.0) AS BIGINT) AS files_before,
       CAST(1 AS BIGINT) AS files_after, count(*) > 200 AS merged
FROM mg GROUP BY processing_date"""

_BY_MONTH = SILVER.replace("landed_date AS processing_date", "CAST(date_trunc('month', landed_date) AS DATE) AS processing_date")
SQL["audited_publish"] = with_(RAW_LOANS, _BY_MONTH, GOLD_CTE, STG) + ", suite AS (" + _suite_sql() + """)
SELECT suite.*, 1 AS held_files, (SELECT count(*) FROM stg WHERE processing_date = DATE '1995-06-01' AND state = 'VA') AS held_rows,
       (SELECT count(*) FROM stg) AS published_rows
FROM suite"""

SQL["crawled_layer"] = BASE + _MONTHLY + """
SELECT 'partition added' AS what, strftime(processing_date, '%Y-%m-%d') AS item, count(*) AS rows FROM mg
WHERE processing_date >= DATE '1998-01-01' GROUP BY processing_date
UNION ALL SELECT 'column added', 'is_high', count(*) FROM mg WHERE processing_date >= DATE '1998-01-01'"""

_API_ALL = _API_CTE.replace("FROM valid", "FROM silver")
SQL["sql_scoring"] = with_(RAW_LOANS, SILVER, GOLD_CTE, _API_ALL) + f"""
SELECT policy, state, risk_tier, count(*) AS loan_count, {r6('avg(risk_score)')} AS avg_risk_score
FROM (SELECT 'gold' AS policy, state, risk_tier, risk_score FROM gold UNION ALL SELECT 'api', state, risk_tier, risk_score FROM api)
GROUP BY policy, state, risk_tier"""

SQL["clustered_lookup"] = BASE + f"""
SELECT 'segment' AS what, loan_id, state, {_AMT} AS loan_amount, {r6('risk_score')} AS risk_score, risk_tier
FROM stg WHERE state IN ('VA', 'MD') AND {_AMT} BETWEEN {D(10000.0)} AND {D(60000.0)}
UNION ALL SELECT 'loan', loan_id, state, {_AMT}, {r6('risk_score')}, risk_tier
FROM stg WHERE loan_id = (SELECT min(loan_id) FROM stg)"""

SQL["published_records"] = BASE + f"""
SELECT 'high-risk-loans' AS topic, risk_tier, count(*) AS records, count(*) AS keyed, round(sum({_AMT}), 2) AS amount,
       {r6('avg(risk_score)')} AS avg_risk_score
FROM stg WHERE risk_tier IN ('CRITICAL', 'HIGH') GROUP BY risk_tier"""

SQL["stream_metrics"] = BASE + """
SELECT count(*) FILTER (WHERE risk_tier = 'CRITICAL') AS critical_count, count(*) AS rows FROM gold"""
