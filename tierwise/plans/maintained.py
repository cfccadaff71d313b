"""Registered queries on layers that are kept as versions: refresh, late days, merged quantiles, compaction.

The gold layer here is that of the given tables with one run a month (the processing date is the month's first day),
so that partitions have a lake's size against the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sql_functions
from ..functions.scoring import macro_stress
from ..operators import analytics, catalog, cube, lake, layout, marts, quality, scenarios, versions
from ..policies import API, GOLD
from ..schemas import PARTITION_COLS
from ..session import scratch_path
from ..sources import files
from . import views
from .registry import SEGMENT_AMOUNT, SEGMENT_STATES, dbl, r6, register

NEW_MACRO_FROM = "1997-01-01"
LATE = ("1995-06-01", "VA")
SMALL_FILE_ROWS = 200
QUANTILES = [0.25, 0.5, 0.75]
SECOND_DELIVERY = "1998-01-01"


def monthly_gold(spark, sf_dir: str) -> DataFrame:
    runs = lake.clean_raw(views.raw(spark, sf_dir), as_of=F.trunc("landed_date", "month")).drop("landed_date")
    return lake.score(runs)


@register("refresh_versions")
def q_refresh_versions(spark, sf_dir):
    """M9 + M10 + K7: the scored layer refreshed twice, the second time with a macro score that holds from a date on, so
    that only later partitions are rewritten. Each version against the one before, from the manifests, beside
    the rows that a reader as of that version finds."""
    root = scratch_path(spark, "scores")
    versions.create(spark, root, monthly_gold(spark, sf_dir))
    versions.rewrite(spark, root, scenarios.refresh_scores, "refresh")
    newer = F.when(F.col("processing_date") >= F.lit(NEW_MACRO_FROM).cast("date"), macro_stress(F.lit(4.5), F.lit(4.2), F.lit(2.8)))
    macro = newer.otherwise(F.col("macro_stress_score"))
    versions.rewrite(spark, root, lambda df: scenarios.refresh_scores(df, macro), "refresh")
    out = []
    for v in (2, 3):
        stored = versions.read(spark, root, v).groupBy(F.col("risk_tier").alias("tier")).agg(F.count(F.lit(1)).alias("stored_count"))
        report = versions.compare(spark, root, v - 1, v)
        report = report.join(stored, F.col("risk_tier").eqNullSafe(F.col("tier")), "left").drop("tier")
        w = versions.partitions_written(spark, root, v).select(F.struct("written", "kept").alias("w")).scalar()
        out.append(report.select(F.lit(v).alias("version"), "risk_tier", "before_count", "after_count",
                                 F.coalesce("stored_count", F.lit(0).cast("long")).alias("stored_count"),
                                 w["written"].alias("written"), w["kept"].alias("kept")))
    return files.union_all(out)


def _answer(name: str, df: DataFrame, item: list, values: dict[str, Column]) -> DataFrame:
    """Rows (answer, item, measure, value) of a small result."""
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), v.cast("double").alias("value")) for k, v in values.items()]))
    at = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in item]) if item else F.lit("")
    return df.select(F.lit(name).alias("answer"), at.alias("item"), cells.alias("c")).select("answer", "item", "c.*")


def _amount(c: str) -> Column:
    return F.round(F.col(c), 2)


@register("cube_answers")
def q_cube_answers(spark, sf_dir):
    """A3 + A4 + A5/A6 + A7/A8 + A11 + A13 from the cube, after loans of one state arrived late for one month: the cube
    was built without them, then brought up to date from that month's partition alone."""
    root, at = scratch_path(spark, "scores"), scratch_path(spark, "cube")
    gold = monthly_gold(spark, sf_dir)
    late = F.coalesce((F.col("processing_date") == F.lit(LATE[0]).cast("date")) & (F.col("state") == LATE[1]), F.lit(False))
    versions.create(spark, root, gold.where(~late))
    cube.update_sums(spark, root, at)
    versions.append(spark, root, gold.where(late))
    version = cube.update_sums(spark, root, at)["version"]
    c = versions.read(spark, at)
    date = F.col("processing_date")
    stats = ["total_loans", "avg_risk_score", "avg_loan_amount", "high_risk_exposure_billions"]
    return files.union_all([
        _answer("trend", cube.daily_trend(c), [date, F.col("risk_tier")], {"loan_count": F.col("loan_count"), "avg_risk_score": r6("avg_risk_score")}),
        _answer("stats", cube.portfolio_stats(c), [F.col("last_updated")], {x: F.col(x) for x in stats}),
        _answer("tiers", cube.tier_distribution(c), [F.col("risk_tier")], {"loan_count": F.col("loan_count"), "share": r6("share")}),
        _answer("totals", cube.totals(c), [F.col("min_date"), F.col("max_date")], {
            "total_loans": F.col("total_loans"), "mean_risk_score": r6("mean_risk_score"), "total_amount": _amount("total_amount"),
            "min_amount": _amount("min_amount"), "max_amount": _amount("max_amount")}),
        _answer("daily", cube.daily_stats(c), [F.col("date")], {x: r6(x) for x in ("mean", "max", "min")}),
        _answer("rollup", cube.hierarchy_sum(c), [F.col("state"), F.col("risk_tier"), F.col("level")], {"total_amount": _amount("total_amount")}),
        _answer("update", versions.partitions_written(spark, at, version), [], {"written": F.col("written"), "kept": F.col("kept")}),
    ])


@register("merged_quantiles")
def q_merged_quantiles(spark, sf_dir):
    """A9/A16 approximately: KLL sketches per month and column, merged over all months. The sketch's error is
    random, so the result holds whether each value's true rank is within twice the (99 %) bound, that is five
    standard errors."""
    root, at = scratch_path(spark, "scores"), scratch_path(spark, "sketches")
    versions.create(spark, root, monthly_gold(spark, sf_dir))
    cube.update_sketches(spark, root, at)
    got = cube.merged_quantiles(versions.read(spark, at), QUANTILES)
    gold = versions.read(spark, root)
    cells = F.array(*[F.struct(F.lit(c).alias("of"), F.col(c).cast("double").alias("v")) for c in cube.analytics.DESCRIBE_COLS])
    values = gold.select(F.explode(cells).alias("x")).select("x.*").groupBy("of", "v").agg(F.count(F.lit(1)).alias("m"))
    ranks = got.join(values, F.col("column") == F.col("of")).groupBy("column", "n", "probability", "rank_error").agg(
        F.sum(F.when(F.col("v") < F.col("value"), F.col("m")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("v") <= F.col("value"), F.col("m")).otherwise(0)).alias("upto"))
    p, most = F.col("probability"), 2 * F.col("rank_error")
    near = (F.col("below") / F.col("n") <= p + most) & (F.col("upto") / F.col("n") >= p - most)
    return ranks.select(F.col("column").alias("metric"), "n", "probability", "rank_error", near.alias("within"))


@register("compacted_layer")
def q_compacted_layer(spark, sf_dir):
    """The scored layer landed in small files, then compacted: by month its rows, its files before and after, and
    whether it was rewritten (a month of a single file is not)."""
    root = scratch_path(spark, "scores")
    first = versions.create(spark, root, monthly_gold(spark, sf_dir), max_records=SMALL_FILE_ROWS)
    last = versions.compact(spark, root)
    month = F.concat_ws("-", "year", "month").alias("month")
    rows = versions.read(spark, root).groupBy(month).agg(F.count(F.lit(1)).alias("rows"))

    def count(version: int, name: str) -> DataFrame:
        return versions.file_sizes(spark, root, version).groupBy(month).agg(
            F.count(F.lit(1)).alias(f"files_{name}"), F.max(F.col("run") != first["manifest"]).alias(f"merged_{name}"))

    out = rows.join(count(first["version"], "before"), "month").join(count(last["version"], "after"), "month")
    return out.select("month", "rows", "files_before", "files_after", F.col("merged_after").alias("merged"))


@register("audited_publish")
def q_audited_publish(spark, sf_dir):
    """Q13 + Q14 + Q18: two deliveries, audited by file before they are published. The second holds a planted file: one
    month's loans of one state again, without a score and with an unknown tier. The suite over what was published, merged
    from the ledger's partial results, and what was held back."""
    root = scratch_path(spark, "published")
    gold = monthly_gold(spark, sf_dir)
    second = F.col("processing_date") >= F.lit(SECOND_DELIVERY).cast("date")
    bad = gold.where((F.col("processing_date") == F.lit(LATE[0]).cast("date")) & (F.col("state") == LATE[1]))
    bad = bad.withColumns({"risk_score": F.lit(None).cast("double"), "risk_tier": F.lit("UNKNOWN")})
    versions.publish(spark, root, gold.where(~second))
    versions.publish(spark, root, gold.where(second).unionByName(bad))
    books = versions.ledger(spark, root)
    held = books.where(F.size("failed") > 0).agg(F.struct(F.count(F.lit(1)).alias("files"), F.sum("n_rows").alias("rows")).alias("h")).scalar()
    there = versions.read(spark, root)
    suite = quality.finish_suite(books.where(F.size("failed") == 0), there.columns, as_of=views.AS_OF_DATE)
    n = there.agg(F.count(F.lit(1))).scalar()
    return suite.select("check_id", "check", F.col("column").alias("target"), r6("observed").alias("observed"), "passed", "unexpected_count",
                        held["files"].alias("held_files"), held["rows"].alias("held_rows"), n.alias("published_rows"))


@register("crawled_layer")
def q_crawled_layer(spark, sf_dir):
    """The scored layer crawled twice; before the second crawl later months arrive, with one more column. The second
    crawl's log, each partition with its rows and the column with its values in the table."""
    path = scratch_path(spark, "crawled")
    name = "crawled_" + path.rsplit("-", 1)[-1]
    gold = monthly_gold(spark, sf_dir)
    second = F.col("processing_date") >= F.lit(SECOND_DELIVERY).cast("date")
    lake.write_gold(gold.where(~second), path)
    catalog.crawl(spark, path, name)
    newer = gold.where(second).withColumn("is_high", F.col("risk_tier").isin("HIGH", "CRITICAL"))
    lake.write_gold(newer, path, mode="append")
    log = catalog.crawl(spark, path, name)
    t = spark.table(name)
    rows = t.groupBy(F.concat_ws("-", "year", "month", "day").alias("place")).agg(F.count(F.lit(1)).alias("n"))
    columns = t.agg(F.count("is_high").alias("n")).select(F.lit("is_high").alias("place"), "n")
    return log.join(rows.unionByName(columns), F.col("item") == F.col("place")).select("what", "item", F.col("n").alias("rows"))


@register("sql_scoring")
def q_sql_scoring(spark, sf_dir):
    """K11 + M1-M6: raw columns scored in SQL under two policies, by functions made from the policies."""
    views.silver(spark, sf_dir).createOrReplaceTempView("silver_for_sql")
    for p in (GOLD, API):
        sql_functions.register(spark, p)
    one, two = (sql_functions.scored_select(p, "silver_for_sql", "loan_id, state") for p in (GOLD, API))
    return lake.sql(spark, f"""
        SELECT policy, state, risk_tier, count(*) AS loan_count, round(avg(risk_score), 6) AS avg_risk_score
        FROM (SELECT 'gold' AS policy, * FROM ({one}) UNION ALL SELECT 'api' AS policy, * FROM ({two}))
        GROUP BY policy, state, risk_tier""")


CLUSTER_BY = ["state", "loan_amount", "risk_score"]


@register("clustered_lookup")
def q_clustered_lookup(spark, sf_dir):
    """F9 + F17 on the clustered layer: a segment's loans and one loan by its key, read through statistics and Bloom filters."""
    path = scratch_path(spark, "clustered")
    layout.write_clustered(views.stg(spark, sf_dir), path, CLUSTER_BY, "loan_id")
    there = spark.read.parquet(path)
    segment = analytics.segment(there, SEGMENT_STATES, SEGMENT_AMOUNT)
    first = there.agg(F.min("loan_id")).scalar()
    cols = ["loan_id", "state", dbl("loan_amount"), r6("risk_score").alias("risk_score"), "risk_tier"]
    return files.union_all([segment.select(F.lit("segment").alias("what"), *cols),
                            marts.loan_by_id(there, first).select(F.lit("loan").alias("what"), *cols)])
