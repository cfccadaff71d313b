"""Declarative data-quality checks.

A suite is a list of ``Check`` specs. ``run_suite`` compiles all of them
into ONE aggregation over the table (one scan, partial aggregation), then
unpivots the single result row into one row per check:
(layer, check, column, observed, expected, passed, unexpected_count).
Range and set checks ignore nulls; bounds are inclusive.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import HIGH_RISK_TIERS, TIERS


@dataclass(frozen=True)
class Check:
    kind: str                 # exists | not_null | between | in_set | row_count | mean_between | share_between | fresh
    column: str | None = None
    lo: float | None = None
    hi: float | None = None
    values: tuple = field(default_factory=tuple)
    value: str | None = None  # share_between: the category
    days: int | None = None   # fresh

    @property
    def name(self) -> str:
        tail = f"{self.column}" if self.column else "table"
        if self.kind == "share_between":
            tail = f"{self.column}={self.value}"
        return f"{self.kind}:{tail}"

    @property
    def expected(self) -> str:
        if self.kind in ("between", "row_count", "mean_between", "share_between"):
            return f"[{self.lo}, {self.hi}]"
        if self.kind == "in_set":
            return ",".join(self.values)
        if self.kind == "fresh":
            return f"<= {self.days} days"
        return "present" if self.kind == "exists" else "0 nulls"


# constructors (Q1-Q9)
def exists(col): return Check("exists", col)
def not_null(col): return Check("not_null", col)
def between(col, lo, hi): return Check("between", col, float(lo), float(hi))
def in_set(col, values): return Check("in_set", col, values=tuple(values))
def row_count(lo, hi): return Check("row_count", None, float(lo), float(hi))
def mean_between(col, lo, hi): return Check("mean_between", col, float(lo), float(hi))
def share_between(col, value, lo, hi): return Check("share_between", col, float(lo), float(hi), value=value)
def fresh(col, days): return Check("fresh", col, days=int(days))


# The reference's suite — fixed values: columns, ranges, sets, shares, bounds.
SUITE_COLUMNS = ["loan_amount", "ltv", "dti", "interest_rate", "income", "ltv_score",
                 "dti_score", "rate_spread_score", "macro_stress_score", "risk_score",
                 "risk_tier", "processing_date"]
REFERENCE_SUITE = (
    [exists(c) for c in SUITE_COLUMNS]
    + [not_null("risk_score"), not_null("risk_tier"), not_null("loan_amount")]
    + [between("risk_score", 0.0, 1.0), between("ltv", 0.0, 205.0), between("dti", 0.0, 100.0),
       between("interest_rate", 0.0, 30.0)]
    + [in_set("risk_tier", TIERS), row_count(100, 1_000_000), mean_between("risk_score", 0.05, 0.95)]
    + [share_between("risk_tier", "CRITICAL", 0.0, 0.30), share_between("risk_tier", "HIGH", 0.0, 0.50),
       share_between("risk_tier", "MEDIUM", 0.20, 0.99), share_between("risk_tier", "LOW", 0.0, 0.20),
       mean_between("loan_amount", 50_000, 2_000_000)]
    + [fresh("processing_date", 30)]
)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(x: float) -> str:
    return f"{float(x)!r}D"


def _sql_str(v) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + str(v).replace("'", "\\'") + "'"


def _partials(c: Check, i: int, cols: set[str]) -> list[tuple[str, str, str]]:
    """(name, aggregate, merge) of the partial results of one check: counts and sums, which add up
    over any cut of the rows, and the latest date."""
    if c.kind in ("exists", "row_count") or c.column not in cols:
        return [(f"n{i}", "count(1)", "sum")] if c.kind == "row_count" else []
    col = _q(c.column)
    x = f"CAST({col} AS DOUBLE)"
    if c.kind == "not_null":
        return [(f"b{i}", f"count_if({col} IS NULL)", "sum")]
    if c.kind == "between":
        return [(f"b{i}", f"count_if({x} IS NOT NULL AND NOT ({x} BETWEEN {_lit(c.lo)} AND {_lit(c.hi)}))", "sum")]
    if c.kind == "in_set":
        vals = ", ".join(_sql_str(v) for v in c.values)
        return [(f"b{i}", f"count_if({col} IS NOT NULL AND NOT ({col} IN ({vals})))", "sum")]
    if c.kind == "mean_between":
        return [(f"s{i}", f"sum({x})", "sum"), (f"c{i}", f"count({x})", "sum")]
    if c.kind == "share_between":
        return [(f"v{i}", f"count_if({col} = {_sql_str(c.value)})", "sum"), (f"c{i}", f"count({col})", "sum")]
    if c.kind == "fresh":
        return [(f"d{i}", f"max(CAST({col} AS DATE))", "max")]
    raise ValueError(c.kind)


def _finished(c: Check, i: int, cols: set[str], as_of: str) -> tuple[str, str]:
    """(observed, unexpected_count) from merged partial results."""
    if c.kind == "exists":
        return ("1.0D", "0L") if c.column in cols else ("0.0D", "1L")
    if c.kind == "row_count":
        return f"CAST(n{i} AS DOUBLE)", "0L"
    if c.column not in cols:
        return "CAST(NULL AS DOUBLE)", "CAST(NULL AS BIGINT)"
    if c.kind in ("not_null", "between", "in_set"):
        return f"CAST(b{i} AS DOUBLE)", f"b{i}"
    if c.kind == "mean_between":
        return f"try_divide(s{i}, c{i})", "0L"
    if c.kind == "share_between":
        # an empty input gives null (-> 0.0), not a division error under ANSI
        return f"coalesce(try_divide(v{i}, c{i}), 0.0D)", "0L"
    return f"CAST(datediff({as_of}, d{i}) AS DOUBLE)", "0L"


def _passed(c: Check, observed: str) -> str:
    if c.kind == "exists":
        return f"({observed} = 1.0D)"
    if c.kind in ("not_null", "between", "in_set"):
        return f"coalesce({observed} = 0.0D, false)"
    if c.kind in ("row_count", "mean_between", "share_between"):
        return f"coalesce({observed} BETWEEN {_lit(c.lo)} AND {_lit(c.hi)}, false)"
    if c.kind == "fresh":
        return f"coalesce({observed} <= {int(c.days)}, false)"
    raise ValueError(c.kind)


def suite_partials(df: DataFrame, checks=REFERENCE_SUITE) -> DataFrame:
    """One row of partial results, in one aggregation over the table. Rows of several batches merge
    (``finish_suite``) to the results over all of their rows."""
    cols = set(df.columns)
    return df.selectExpr(*[f"{expr} AS {name}" for i, c in enumerate(checks) for name, expr, _ in _partials(c, i, cols)]
                         or ["count(1) AS n"])


ROW_KINDS = ("not_null", "between", "in_set")


def partials_by(df: DataFrame, keys: list[str], checks=REFERENCE_SUITE) -> DataFrame:
    """Q13/Q14 on content: the partial results of each group (a file, a day), its rows, and in ``failed`` the checks on single
    rows that it breaks. Checks on the whole (counts, means, shares, dates) are no group's own fault; they follow from
    the groups' merged partial results."""
    cols = set(df.columns) - set(keys)
    parts = [(i, c, p) for i, c in enumerate(checks) for p in _partials(c, i, cols)]
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *[F.expr(expr).alias(name) for _, _, (name, expr, _) in parts])
    broken = [F.when(F.col(name) > 0, F.lit(c.name)) for _, c, (name, _, _) in parts if c.kind in ROW_KINDS]
    missing = [F.lit(c.name) for c in checks if c.column is not None and c.column not in cols]
    return out.withColumn("failed", F.array_compact(F.array(*broken, *missing)) if broken or missing else F.array().cast("array<string>"))


def finish_suite(partials: DataFrame, columns, checks=REFERENCE_SUITE, as_of: str | None = None,
                 layer: str = "gold") -> DataFrame:
    """Partial result rows of a table with these columns -> one row per check."""
    cols = set(columns)
    ao = "current_date()" if as_of is None else f"DATE'{as_of}'"
    merged = partials.selectExpr(*[f"{how}({name}) AS {name}" for i, c in enumerate(checks)
                                   for name, _, how in _partials(c, i, cols)] or ["sum(n) AS n"])
    obs = [_finished(c, i, cols, ao) for i, c in enumerate(checks)]
    row = merged.selectExpr(*[x for i, (o, u) in enumerate(obs) for x in (
        f"CAST({o} AS DOUBLE) AS o{i}", f"CAST(coalesce({u}, 0L) AS BIGINT) AS u{i}" if u != "CAST(NULL AS BIGINT)"
        else f"{u} AS u{i}")])
    cells = ", ".join(
        f"{i}, {_sql_str(layer)}, {_sql_str(c.name)}, {_sql_str(c.column)}, o{i}, {_sql_str(c.expected)}, "
        f"{_passed(c, f'o{i}')}, u{i}" for i, c in enumerate(checks))
    return row.selectExpr(f"stack({len(checks)}, {cells}) AS "
                          "(check_id, layer, `check`, `column`, observed, expected, passed, unexpected_count)")


def run_suite(df: DataFrame, checks=REFERENCE_SUITE, as_of: str | None = None,
              layer: str = "gold") -> DataFrame:
    """Evaluate every check in one pass; one output row per check. The checks compile to SQL text: a few
    plan-building calls whatever the number of checks."""
    return finish_suite(suite_partials(df, checks), df.columns, checks, as_of, layer)


def summarize(results: DataFrame) -> DataFrame:
    """Q10: total, passed, failed, success % (1 dp); empty input -> 0/0/1/0."""
    s = results.agg(F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"))
    return s.select(
        "total", "passed",
        F.when(F.col("total") == 0, F.lit(1)).otherwise(F.col("total") - F.col("passed")).cast("long").alias("failed"),
        F.when(F.col("total") == 0, F.lit(0.0))
         .otherwise(F.round(F.col("passed") / F.col("total") * 100, 1)).alias("success_rate"))


# ---------------------------------------------------------------- model tests (Q11, Q12)

# Fixed values that must equal the reference's model tests.
MODEL_TESTS = {
    "stg_loan_risk_scores": [("risk_score", "not_null", None), ("risk_tier", "not_null", None),
                             ("risk_tier", "accepted_values", TIERS), ("loan_amount", "not_null", None)],
    "mart_risk_summary": [("risk_tier", "not_null", None), ("risk_tier", "accepted_values", TIERS)],
    "mart_high_risk_loans": [("risk_score", "not_null", None), ("risk_tier", "not_null", None),
                             ("risk_tier", "accepted_values", HIGH_RISK_TIERS), ("loan_amount", "not_null", None)],
    "mart_daily_risk_trend": [("risk_tier", "not_null", None), ("risk_tier", "accepted_values", TIERS)],
}


def model_tests(models: dict[str, DataFrame], tests: dict = MODEL_TESTS) -> DataFrame:
    """Failing-row count per (model, column, test); one aggregation per model,
    compiled to SQL text (no per-test Column objects)."""
    out = None
    for model, specs in tests.items():
        aggs = []
        for i, (col, test, values) in enumerate(specs):
            c = _q(col)
            bad = (f"{c} IS NULL" if test == "not_null"
                   else f"{c} IS NOT NULL AND NOT ({c} IN ({', '.join(_sql_str(v) for v in values)}))")
            aggs.append(f"count_if({bad}) AS f{i}")
        cells = ", ".join(f"{_sql_str(model)}, {_sql_str(col)}, {_sql_str(test)}, f{i}"
                          for i, (col, test, _) in enumerate(specs))
        part = models[model].selectExpr(*aggs).selectExpr(
            f"stack({len(specs)}, {cells}) AS (model, `column`, test, failures)")
        out = part if out is None else out.unionByName(part)
    return out.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


# ---------------------------------------------------------------- table and file checks

def null_count(col: str) -> Column:
    """F11."""
    return F.count_if(F.col(col).isNull())


def not_in_count(col: str, allowed) -> Column:
    """NOT IN semantics — a null value is not counted."""
    return F.count_if(~F.col(col).isin(list(allowed)))


def check_table(df: DataFrame, as_of: str, min_rows: int = 100_000) -> DataFrame:
    """Q15: row count > min, no null score, no invalid tier, max date = as_of.

    One aggregation; every failed rule is collected into the status text.
    The message formats below are fixed values that must equal the reference's.
    """
    a = df.agg(F.count(F.lit(1)).alias("cnt"), null_count("risk_score").alias("null_cnt"),
               not_in_count("risk_tier", TIERS).alias("invalid_tier_cnt"),
               F.max("processing_date").alias("max_date"))
    d = F.lit(as_of).cast("date")
    errs = F.array_compact(F.array(
        F.when(F.col("cnt") <= min_rows, F.format_string("Row count %d is not > %d", F.col("cnt"), F.lit(min_rows))),
        F.when(F.col("null_cnt") > 0, F.format_string("Found %d records with NULL risk_score", F.col("null_cnt"))),
        F.when(F.col("invalid_tier_cnt") > 0,
               F.format_string("Found %d records with invalid risk_tier", F.col("invalid_tier_cnt"))),
        F.when(F.col("max_date").isNull() | (F.col("max_date") != d),
               F.format_string("Max processing_date %s != %s", F.coalesce(F.col("max_date").cast("string"),
                                                                            F.lit("None")), d.cast("string")))))
    return a.select("cnt", "null_cnt", "invalid_tier_cnt", "max_date",
                    F.when(F.size(errs) == 0, F.lit("PASS"))
                     .otherwise(F.concat(F.lit("FAIL: "), F.array_join(errs, ", "))).alias("status"))


def check_files(files: DataFrame, min_bytes: int = 0, ext: str | None = None,
                layer: str = "files") -> DataFrame:
    """Q13/Q14: at least one (matching) file and total size >= min_bytes."""
    f = files if ext is None else files.where(F.col("path").endswith(ext))
    a = f.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))
    status = (F.when(F.col("n_files") == 0, F.lit("FAIL: no files"))
               .when(F.col("total_bytes") < min_bytes,
                     F.format_string("FAIL: total size %d bytes < %d", F.col("total_bytes"), F.lit(min_bytes)))
               .otherwise(F.lit("PASS")))
    return a.select(F.lit(layer).alias("layer"), "n_files", "total_bytes", status.alias("status"))


def check_rows(df: DataFrame, layer: str, min_rows: int = 1) -> DataFrame:
    """Q13/Q14 on a layer's rows: PASS with at least ``min_rows`` of them."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    status = (F.when(F.col("n_rows") == 0, F.lit("FAIL: no rows"))
               .when(F.col("n_rows") < min_rows, F.format_string("FAIL: %d rows < %d", F.col("n_rows"), F.lit(min_rows)))
               .otherwise(F.lit("PASS")))
    return n.select(F.lit(layer).alias("layer"), "n_rows", status.alias("status"))


def layer_report(statuses: DataFrame, layers=("raw_check", "silver_check", "gold_check", "warehouse_check"),
                 date: str | None = None) -> DataFrame:
    """Q16: (layer, status) rows -> one report row; a missing layer is FAIL."""
    one = statuses.groupBy().pivot("layer", list(layers)).agg(F.first("status"))
    d = F.lit(date) if date is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return one.select(d.alias("date"), *[F.coalesce(F.col(x), F.lit("FAIL")).alias(x) for x in layers])


def failed(report: DataFrame) -> DataFrame:
    """F16: report fields whose text contains FAIL, as (date, check, status) rows in field order."""
    fields = [c for c in report.columns if c != "date"]
    cells = [F.struct(F.lit(i).alias("place"), F.lit(c).alias("check"), F.col(c).alias("status")) for i, c in enumerate(fields)]
    long = report.select("date", F.explode(F.array(*cells)).alias("f")).select("date", "f.*")
    return long.where(F.col("status").contains("FAIL"))


def quality_alerts(report: DataFrame) -> DataFrame:
    """Q17: per report date, one alert message naming its failed checks in field order."""
    names = F.transform(F.array_sort(F.collect_list(F.struct("place", "check"))), lambda x: x["check"])
    # fixed value: the alert text equals the reference's
    return failed(report).groupBy("date").agg(names.alias("checks")).select(
        "date", F.concat(F.lit("Data Quality Alert! Failed checks: "), F.array_join("checks", ", ")).alias("message"))


# ---------------------------------------------------------------- files

def older_than(files: DataFrame, days: int, as_of: str | None = None) -> DataFrame:
    """last modified strictly before as_of - days."""
    ref = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return files.where(F.col("modificationTime") < ref - F.make_interval(days=F.lit(days)))


def with_suffix(files: DataFrame, ext: str = ".parquet") -> DataFrame:
    """F13."""
    return files.where(F.col("path").endswith(ext))


def storage_report(files: DataFrame, days: int = 30, as_of: str | None = None,
                   rate: float = 0.019) -> DataFrame:
    """GB of files older than ``days`` (4 dp) and estimated saving."""
    old = older_than(files, days, as_of)
    month = (F.date_format(F.current_date(), "yyyy-MM") if as_of is None
             else F.date_format(F.lit(as_of).cast("date"), "yyyy-MM"))
    gb = F.coalesce(F.sum("length"), F.lit(0)) / F.lit(float(1024 ** 3))
    return old.agg(gb.alias("gb")).select(month.alias("month"), F.round("gb", 4).alias("gb_archived"),
                                          (F.col("gb") * F.lit(rate)).alias("estimated_savings"))
