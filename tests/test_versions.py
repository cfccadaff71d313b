"""Layers kept as versions: copy on write, the pointer, compaction, layers that follow."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierwise.operators import cube, scenarios, versions
from tierwise.plans import maintained


def rows_of(spark, days, tier="LOW", n=3):
    data = [(f"{d}-{i}", float(i), tier, "2024", "04", d) for d in days for i in range(n)]
    return spark.createDataFrame(data, "loan_id string, risk_score double, risk_tier string, year string, month string, day string")


def ids(df):
    return sorted(r.loan_id for r in df.select("loan_id").collect())


def test_only_changed_partitions_are_rewritten_and_old_versions_stay(spark, tmp_dir):
    root = f"{tmp_dir}/v"
    versions.create(spark, root, rows_of(spark, ["01", "02", "03"]))
    before = ids(versions.read(spark, root))
    raised = F.when(F.col("day") == "02", F.lit("HIGH")).otherwise(F.col("risk_tier"))
    e = versions.rewrite(spark, root, lambda df: df.withColumn("risk_tier", raised))
    assert e["version"] == 2 and e["parent"] == 1
    assert versions.partitions_written(spark, root, 2).first().asDict() == {"written": 1, "kept": 2}
    assert ids(versions.read(spark, root)) == before
    assert {(r.day, r.risk_tier) for r in versions.read(spark, root).collect()} == {("01", "LOW"), ("02", "HIGH"), ("03", "LOW")}
    assert {r.risk_tier for r in versions.read(spark, root, 1).collect()} == {"LOW"}
    got = {r.risk_tier: (r.before_count, r.after_count) for r in versions.compare(spark, root, 1, 2).collect()}
    assert got == {"LOW": (9, 6), "HIGH": (0, 3)}
    # nothing changes: no version
    assert versions.rewrite(spark, root, lambda df: df.withColumn("risk_tier", raised))["version"] == 2
    with pytest.raises(LookupError):
        versions.read(spark, root, 9)


def test_a_run_that_dies_before_the_pointer_moves_leaves_the_version(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/v"
    versions.create(spark, root, rows_of(spark, ["01", "02"]))
    change = lambda df: df.withColumn("risk_tier", F.lit("CRITICAL"))

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "_commit", dies)
        with pytest.raises(OSError):
            versions.rewrite(spark, root, change)
    assert versions.current(spark, root)["version"] == 1
    assert {r.risk_tier for r in versions.read(spark, root).collect()} == {"LOW"}
    assert versions.rewrite(spark, root, change)["version"] == 2
    assert {r.risk_tier for r in versions.read(spark, root).collect()} == {"CRITICAL"}
    assert len(os.listdir(f"{root}/data")) == 3
    # version 1 and the dead run go, version 2 stays whole
    assert len(versions.expire(spark, root, keep=1)) == 2
    assert len(os.listdir(f"{root}/data")) == 1 and versions.read(spark, root).count() == 6
    assert [e["version"] for e in versions.log(spark, root)] == [2]


def test_of_two_runs_from_one_parent_the_second_is_refused(spark, tmp_dir):
    root = f"{tmp_dir}/v"
    versions.create(spark, root, rows_of(spark, ["01"]))
    parent = versions.current(spark, root)
    versions.append(spark, root, rows_of(spark, ["02"]))
    with pytest.raises(versions.Conflict):
        versions._write_version(spark, root, parent, versions.manifest(spark, root, 1), rows_of(spark, ["03"]))
    assert {r.day for r in versions.read(spark, root).collect()} == {"01", "02"}
    assert not [f for f in os.listdir(f"{root}/log") if f.startswith("_")]


def test_marts_are_built_before_the_pointer_moves(spark, tmp_dir):
    root, seen = f"{tmp_dir}/v", []
    versions.create(spark, root, rows_of(spark, ["01"]))

    def marts(df, entry):
        seen.append((versions.current(spark, root)["version"], entry["version"], {r.risk_tier for r in df.collect()}))
        return {"marts": "there"}

    e = versions.rewrite(spark, root, lambda df: df.withColumn("risk_tier", F.lit("HIGH")), before_commit=marts)
    assert seen == [(1, 2, {"HIGH"})] and versions.current(spark, root) == e and e["marts"] == "there"


def test_compaction_leaves_large_and_single_files(spark, tmp_dir):
    root = f"{tmp_dir}/v"
    versions.create(spark, root, rows_of(spark, ["01"], n=40000))               # one large file
    versions.append(spark, root, rows_of(spark, ["01"], n=5))
    versions.append(spark, root, rows_of(spark, ["01"], "HIGH", n=6))
    versions.append(spark, root, rows_of(spark, ["02"], n=4))                   # a single small one
    before = {(r.run, r.day, r.file): r.length for r in versions.file_sizes(spark, root).collect()}
    assert len(before) == 4
    large = max(before.values())
    e = versions.compact(spark, root, target=large)
    after = {(r.run, r.day, r.file) for r in versions.file_sizes(spark, root).collect()}
    assert len(after) == 3 and {k for k, n in before.items() if n == large or k[1] == "02"} <= after
    assert [k[1] for k in after if k[0] == e["manifest"]] == ["01"]
    for v in (4, 5):
        assert versions.read(spark, root, v).groupBy("day", "risk_tier").count().orderBy("day", "risk_tier").collect() == [
            ("01", "HIGH", 6), ("01", "LOW", 40005), ("02", "LOW", 4)]
    assert {r.risk_tier: (r.before_count, r.after_count) for r in versions.compare(spark, root, 4, 5).collect()} == {
        "LOW": (40009, 40009), "HIGH": (6, 6)}
    assert versions.compact(spark, root, target=large)["version"] == 5          # nothing left to merge
    assert versions.rewrite(spark, root, lambda df: df.withColumn("risk_tier", F.lit("LOW")))["version"] == 6
    assert versions.read(spark, root).where("risk_tier = 'LOW'").count() == 40015


def test_bins_hold_at_most_about_the_target(spark):
    sizes = spark.createDataFrame([("2024", "04", "01", "r", f"f{i}", 30) for i in range(11)] + [("2024", "04", "02", "r", "big", 90)],
                                  "year string, month string, day string, run string, file string, length long")
    got = versions.bins(sizes, 100).groupBy("day", "bin").agg(F.sum("length").alias("s")).collect()
    assert {r.day for r in got} == {"01"} and max(r.s for r in got) <= 130 and sum(r.s for r in got) >= 300


def test_a_late_day_reads_one_partition(spark, tmp_dir):
    gold = maintained.monthly_gold(spark, SF_SMALL)
    late = (F.col("processing_date") == F.lit("1995-06-01").cast("date")) & (F.col("state") == "VA")
    root, at = f"{tmp_dir}/gold", f"{tmp_dir}/cube"
    versions.create(spark, root, gold.where(~late))
    cube.update_sums(spark, root, at)
    old = versions.read(spark, at).count()
    versions.append(spark, root, gold.where(late))
    parts = versions.changed_since(spark, root, 1)
    source = versions.read(spark, root, 2, parts)
    assert {os.path.dirname(f).split("/data/")[1].split("/", 1)[1] for f in source.inputFiles()} == {"year=1995/month=06/day=01"}
    e = cube.update_sums(spark, root, at)
    assert e["source"] == 2 and cube.update_sums(spark, root, at) == e
    whole = cube.sums(versions.read(spark, root))
    got = versions.read(spark, at).select(*whole.columns)
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in whole.dtypes]
    assert got.select(*rounded).exceptAll(whole.select(*rounded)).isEmpty() and got.count() == whole.count() >= old
    # a partition that is replaced by nothing goes
    versions.create(spark, root, gold.where("month = '06'"))
    cube.update_sums(spark, root, at)
    assert {r.month for r in versions.read(spark, at).select("month").distinct().collect()} == {"06"}


def test_sketches_of_any_dates_merge_within_the_bound(spark, tmp_dir):
    n = 20000
    data = spark.range(n).select(
        F.concat(F.lit("1-"), "id").alias("loan_id"), *[F.pmod(F.xxhash64("id"), F.lit(n)).cast("double").alias(c) for c in
                                                       ("loan_amount", "ltv", "dti", "interest_rate", "risk_score")],
        F.lit("LOW").alias("risk_tier"), F.make_date(F.lit(2024), F.lit(4), (F.col("id") % 9 + 1).cast("int")).alias("processing_date"),
        F.lit("2024").alias("year"), F.lit("04").alias("month"), F.concat(F.lit("0"), F.col("id") % 9 + 1).alias("day"))
    versions.create(spark, f"{tmp_dir}/g", data)
    cube.update_sketches(spark, f"{tmp_dir}/g", f"{tmp_dir}/s")
    layer = versions.read(spark, f"{tmp_dir}/s")
    for dates in (None, ("2024-04-02", "2024-04-04")):
        of = data if dates is None else data.where(F.col("processing_date").between(*[F.lit(d).cast("date") for d in dates]))
        total = of.count()
        for r in cube.merged_quantiles(layer, [0.1, 0.5, 0.99], dates).collect():
            assert r.n == total
            below, upto = of.select(F.count_if(F.col(r.column) < r.value), F.count_if(F.col(r.column) <= r.value)).first()
            assert below / total <= r.probability + 2 * r.rank_error and upto / total >= r.probability - 2 * r.rank_error


def test_refresh_policy_reaches_stored_scores(spark, tmp_dir):
    root = f"{tmp_dir}/v"
    versions.create(spark, root, maintained.monthly_gold(spark, SF_SMALL))
    versions.rewrite(spark, root, scenarios.refresh_scores)
    got = versions.read(spark, root)
    want = scenarios.refresh_scores(versions.read(spark, root, 1))
    assert got.select("loan_id", "risk_tier").exceptAll(want.select("loan_id", "risk_tier")).isEmpty()
    assert {round(r[0], 6) for r in got.select("macro_stress_score").distinct().collect()} == {0.615}
