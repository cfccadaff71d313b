"""Layers kept as versions (K7, K13, M9, M10): copy-on-write partitions, a manifest a version, one atomic pointer.

Layout under ``root`` (a shared folder):

* ``data/run=<id>/year=/month=/day=``: the files that one run wrote, never changed afterwards;
* ``manifests/<id>``: of a version, a row per partition and run: the folder, its files (null: all), rows, rows by tier;
* ``ledger/run=<id>``: the audit of a published run, a row per file;
* ``log/<version>.json``: names a version's manifest and its parent. The highest number is the current
  version. A log file appears by a rename that fails if the number is taken, so a version is there
  whole or not at all, and of two runs from one parent the second is refused.

A run that dies before the rename leaves folders that no manifest names; ``expire`` removes them.
The unit of rewriting is a partition, so manifests grow with days, not with rows.

Layers that follow from another one partition by partition (sums, sketches) are versions as well and note the
version that they were made from: ``follow`` reads only the partitions that changed since.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PARTITION_COLS, TIERS
from ..session import file_system
from . import lake, quality

MANIFEST = "year string, month string, day string, run string, files array<string>, rows long, tiers map<string,bigint>"
FIELDS = [*PARTITION_COLS, "run", "files", "rows", "tiers"]


class Conflict(RuntimeError):
    """Another run has committed from the same parent."""


# ---------------------------------------------------------------- the pointer

def _log_number(name: str) -> int | None:
    stem, _, ending = name.partition(".")
    return int(stem) if ending == "json" and stem.isdigit() else None


def log(spark: SparkSession, root: str) -> list[dict]:
    """Committed versions, oldest first: version, parent, manifest and what the run noted."""
    fs, path = file_system(spark, root)
    folder = path(f"{root}/log")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = sorted(n for n in map(_log_number, names) if n is not None)
    if not numbers:
        return []
    text = spark.read.option("wholetext", True).text([f"{root}/log/{n:08d}.json" for n in numbers]).collect()
    return sorted((json.loads(r["value"]) for r in text), key=lambda e: e["version"])


def current(spark: SparkSession, root: str) -> dict | None:
    """The pointer: the last committed version."""
    entries = log(spark, root)
    return entries[-1] if entries else None


def _commit(spark: SparkSession, root: str, entry: dict) -> None:
    """The log file is written beside its place and renamed to it, which fails if it is taken."""
    fs, path = file_system(spark, root)
    fs.mkdirs(path(f"{root}/log"))
    draft, place = path(f"{root}/log/_{uuid.uuid4().hex}"), path(f"{root}/log/{entry['version']:08d}.json")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(draft, place, options)
    except Exception as e:
        if not fs.exists(place):
            raise
        raise Conflict(f"version {entry['version']} is there already") from e
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)


# ---------------------------------------------------------------- reading

def _entry(spark: SparkSession, root: str, version: int | None) -> dict:
    entries = {e["version"]: e for e in log(spark, root)}
    if not entries or (version is not None and version not in entries):
        raise LookupError(f"no version {version if version is not None else ''} under {root}")
    return entries[max(entries) if version is None else version]


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A row per partition of a version (the current one by default)."""
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{_entry(spark, root, version)['manifest']}")


def _paths(root: str, parts: list) -> list[str]:
    out = []
    for p in parts:
        folder = f"{root}/data/run={p['run']}/" + "/".join(f"{c}={p[c]}" for c in PARTITION_COLS)
        out += [folder] if p["files"] is None else [f"{folder}/{f}" for f in p["files"]]
    return out


def _read(spark: SparkSession, root: str, parts: list, schema: T.StructType) -> DataFrame:
    """The rows of some manifest rows, partition values as text; run names the run that wrote them."""
    full = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    if not parts:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", f"{root}/data").parquet(*_paths(root, parts))


def read(spark: SparkSession, root: str, version: int | None = None, parts: DataFrame | None = None) -> DataFrame:
    """A version's rows, whatever has been committed since; ``parts``: only those of its manifest."""
    e = _entry(spark, root, version)
    rows = (manifest(spark, root, e["version"]) if parts is None else parts).select(*FIELDS).collect()      # a row per day and run
    return _read(spark, root, rows, T.StructType.fromJson(e["schema"])).drop("run")


# ---------------------------------------------------------------- writing

def _counted(rows: DataFrame, *more: Column) -> DataFrame:
    """rows and rows by tier (a null tier is ''; no tiers without the column) of each partition."""
    label = F.coalesce(F.col("risk_tier"), F.lit("")) if "risk_tier" in rows.columns else None
    tiers = [x for t in ([*TIERS, ""] if label is not None else []) for x in (F.lit(t), F.count_if(label == t))]
    tiers = F.create_map(*tiers) if tiers else F.lit(None).cast("map<string,bigint>")
    return rows.groupBy(*PARTITION_COLS).agg(F.count(F.lit(1)).alias("rows"), tiers.alias("tiers"), *more)


def _write_version(spark: SparkSession, root: str, parent: dict | None, kept: DataFrame | None, rows: DataFrame, counts: DataFrame | None = None,
                   note: dict | None = None, before_commit: Callable[[DataFrame, dict], dict] | None = None,
                   write: Callable[[DataFrame, str], None] = lake.write_gold) -> dict:
    """``rows`` become data of a run; the manifest is ``kept`` and a row for each of their partitions; then the pointer moves.

    counts: the new manifest rows if they are known already."""
    run = uuid.uuid4().hex
    data = f"{root}/data/run={run}"
    columns = [c for c in rows.columns if c not in PARTITION_COLS] + PARTITION_COLS
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in columns])
    write(rows.select(*columns), data)
    if counts is None:
        back = spark.read.schema(schema).parquet(data)
        counts = _counted(back)
    entries = counts.select(*PARTITION_COLS, F.lit(run).alias("run"), F.lit(None).cast("array<string>").alias("files"), "rows", "tiers")
    if kept is not None:
        entries = entries.unionByName(kept.select(*FIELDS))
    entries.coalesce(1).write.parquet(f"{root}/manifests/{run}")        # a row per day and run
    entry = {"version": (parent["version"] if parent else 0) + 1, "parent": parent["version"] if parent else None,
             "manifest": run, "schema": schema.jsonValue(), **(note or {})}
    if before_commit is not None:
        parts = spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{run}").collect()
        entry |= before_commit(_read(spark, root, parts, schema).drop("run"), entry)
    _commit(spark, root, entry)
    return entry


def create(spark: SparkSession, root: str, rows: DataFrame, max_records: int = 5_000_000, **how) -> dict:
    """A version with all partitions new (the first, or one that replaces all)."""
    return _write_version(spark, root, current(spark, root), None, rows, note={"what": "create"},
                          write=lambda df, path: lake.write_gold(df, path, max_records=max_records), **how)


def append(spark: SparkSession, root: str, rows: DataFrame, **how) -> dict:
    """A version with further rows, in new or present partitions; nothing is rewritten."""
    parent = _entry(spark, root, None)
    return _write_version(spark, root, parent, manifest(spark, root, parent["version"]), rows, note={"what": "append"}, **how)


def rewrite(spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame], what: str = "rewrite", before_commit=None) -> dict:
    """The next version: ``change`` applied to the current one, which keeps its columns, rows and partitions.

    One scan tells which partitions have a changed row, and counts them as they will be; only those are
    read again and written. Without any, no version is made."""
    parent = _entry(spark, root, None)
    parts = manifest(spark, root, parent["version"])
    before = read(spark, root, parent["version"])
    after = change(before.withColumn("_before", F.struct(*before.columns)))
    same = F.lit(True)
    for c in before.columns:
        same = same & F.col(c).eqNullSafe(F.col("_before")[c])
    found = _counted(after, F.count_if(~same).alias("changed"))
    path = f"{root}/manifests/_found-{uuid.uuid4().hex}"
    found.coalesce(1).write.parquet(path)
    hit = spark.read.schema(found.schema).parquet(path).where("changed > 0")
    todo = parts.join(hit.select(*PARTITION_COLS), PARTITION_COLS, "left_semi")
    n = todo.count()
    if not n:
        return parent
    kept = parts.join(hit.select(*PARTITION_COLS), PARTITION_COLS, "left_anti")
    return _write_version(spark, root, parent, kept, change(read(spark, root, parent["version"], todo)), hit,
                          {"what": what}, before_commit)


# ---------------------------------------------------------------- write, audit, publish

def publish(spark: SparkSession, root: str, rows: DataFrame, checks=quality.REFERENCE_SUITE) -> dict:
    """Q13, Q14, Q18: rows are written, audited file by file, and only the files that pass are published, as further rows of
    the next version. A file that breaks a check on single rows is held back: it stays where it is, and the ledger
    (``root/ledger/run=<id>``: a row per file with its partial results) says why. One scan audits and counts.

    Returns the log entry; without a passing file the version stays (``{}`` if there is none)."""
    run, parent = uuid.uuid4().hex, current(spark, root)
    columns = [c for c in rows.columns if c not in PARTITION_COLS] + PARTITION_COLS
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in columns])
    lake.write_gold(rows.select(*columns), f"{root}/data/run={run}")
    keys = [*PARTITION_COLS, "file"]
    staged = spark.read.schema(schema).parquet(f"{root}/data/run={run}").withColumn("file", F.col("_metadata.file_name"))
    tiers = "risk_tier" in columns
    by_tier = staged.select(*keys, F.coalesce("risk_tier", F.lit("")).alias("tier")).groupBy(*keys, "tier").agg(F.count(F.lit(1)).alias("n")) if tiers else None
    place = f"{root}/ledger/run={run}"
    quality.partials_by(staged, keys, checks).write.parquet(place)
    good = spark.read.parquet(place).withColumns({c: F.col(c).cast("string") for c in PARTITION_COLS}).where(F.size("failed") == 0)
    entries = good.groupBy(*PARTITION_COLS).agg(F.collect_list("file").alias("files"), F.sum("n_rows").alias("rows"))
    if tiers:
        mine = by_tier.join(good.select(*keys), keys, "left_semi").groupBy(*PARTITION_COLS, "tier").agg(F.sum("n").alias("n"))
        mine = mine.groupBy(*PARTITION_COLS).agg(F.map_from_entries(F.collect_list(F.struct("tier", "n"))).alias("tiers"))
        entries = entries.join(mine, PARTITION_COLS)
    else:
        entries = entries.withColumn("tiers", F.lit(None).cast("map<string,bigint>"))
    entries = entries.withColumn("run", F.lit(run)).select(*FIELDS)
    if good.isEmpty():
        return parent or {}
    if parent:
        entries = entries.unionByName(manifest(spark, root, parent["version"]).select(*FIELDS))
    entries.coalesce(1).write.parquet(f"{root}/manifests/{run}")
    entry = {"version": (parent["version"] if parent else 0) + 1, "parent": parent["version"] if parent else None, "manifest": run,
             "schema": schema.jsonValue(), "what": "publish"}
    _commit(spark, root, entry)
    return entry


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """A row per audited file: run, partition, file, n_rows, failed (checks; empty: published) and its partial results."""
    return spark.read.option("basePath", f"{root}/ledger").option("mergeSchema", True).parquet(f"{root}/ledger")


# ---------------------------------------------------------------- compaction

def file_sizes(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """year, month, day, run, file, length of a version's files, from the listing of its folders; no file is opened."""
    parts = manifest(spark, root, version).select(*FIELDS)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(_paths(root, parts.collect())).select("path", "length")
    at = [F.regexp_extract("path", f"/{c}=([^/]+)/", 1).alias(c) for c in ("run", *PARTITION_COLS)]
    return listed.select(*at, F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "length")


def bins(sizes: DataFrame, target: int, small: float = 0.75) -> DataFrame:
    """The files under ``small`` of ``target`` bytes that go together, with the number of their bin.

    A partition's small files are lined up by size and cut at multiples of the target; a bin of one file is left out."""
    line = Window.partitionBy(*PARTITION_COLS).orderBy(F.col("length").desc(), "file")
    x = sizes.where(F.col("length") < small * target)
    x = x.withColumn("bin", F.floor((F.sum("length").over(line.rowsBetween(Window.unboundedPreceding, 0)) - 1) / target).cast("int"))
    return x.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*PARTITION_COLS, "bin"))).where("_n > 1").drop("_n")


def compact(spark: SparkSession, root: str, target: int = 256 << 20, small: float = 0.75) -> dict:
    """The next version, with small files merged into files of about ``target`` bytes.

    Files at or over ``small`` of the target, and small ones that have no partner, are neither read nor moved:
    the manifest goes on naming them. A partition's counts stand with its merged files."""
    parent = _entry(spark, root, None)
    parts = manifest(spark, root, parent["version"])
    path = f"{root}/manifests/_bins-{uuid.uuid4().hex}"
    sizes = file_sizes(spark, root, parent["version"])
    merged = bins(sizes, target, small)
    sizes.join(merged.select("run", "file", "bin", *PARTITION_COLS), [*PARTITION_COLS, "run", "file"], "left").write.parquet(path)
    sizes = spark.read.schema(
        "year string, month string, day string, run string, file string, length long, bin int").parquet(path)
    plan = sizes.where("bin IS NOT NULL")
    hit = plan.select(*PARTITION_COLS).distinct()
    todo = plan.groupBy(*PARTITION_COLS, "run").agg(F.collect_list("file").alias("files"), F.lit(0).cast("long").alias("rows"),
                                                    F.lit(None).cast("map<string,bigint>").alias("tiers"))
    chosen = todo.select(*FIELDS).collect()
    if not chosen:
        return parent
    schema = T.StructType.fromJson(parent["schema"])
    # a task gives its files in several partitions one name
    rows = _read(spark, root, chosen, schema).withColumn("file", F.col("_metadata.file_name"))
    binned = rows.join(plan.select(*PARTITION_COLS, "run", "file", "bin"), [*PARTITION_COLS, "run", "file"]).drop("run", "file")

    def write(_: DataFrame, to: str) -> None:
        dealt = binned.repartition(*PARTITION_COLS, "bin").sortWithinPartitions(*PARTITION_COLS, "bin").drop("bin")
        dealt.write.partitionBy(*PARTITION_COLS).parquet(to)

    left = sizes.where("bin IS NULL").join(hit, PARTITION_COLS, "left_semi").groupBy(*PARTITION_COLS, "run").agg(F.collect_list("file").alias("files"))
    left = left.select("*", F.lit(0).cast("long").alias("rows"), F.lit(None).cast("map<string,bigint>").alias("tiers"))
    kept = parts.join(hit, PARTITION_COLS, "left_anti").select(*FIELDS).unionByName(left.select(*FIELDS))
    tier = F.explode_outer("tiers").alias("tier", "n")
    of = parts.join(hit, PARTITION_COLS, "left_semi").select(*PARTITION_COLS, "run", "rows", tier)
    by_tier = of.where("tier IS NOT NULL").groupBy(*PARTITION_COLS, "tier").agg(F.sum("n").alias("n")).groupBy(*PARTITION_COLS).agg(
        F.map_from_entries(F.collect_list(F.struct("tier", "n"))).alias("tiers"))
    counts = parts.join(hit, PARTITION_COLS, "left_semi").groupBy(*PARTITION_COLS).agg(F.sum("rows").alias("rows")).join(by_tier, PARTITION_COLS, "left")
    return _write_version(spark, root, parent, kept, binned.select(*schema.names), counts, {"what": "compact"}, write=write)


# ---------------------------------------------------------------- layers that follow another

def changed_since(spark: SparkSession, source: str, seen: int | None) -> DataFrame:
    """Manifest rows of the partitions of ``source`` that are not as they were in version ``seen``."""
    now = manifest(spark, source)
    if seen is None:
        return now
    old = manifest(spark, source, seen)
    keys = [*PARTITION_COLS, "run"]
    new = now.join(old.select(*keys), keys, "left_anti").select(*PARTITION_COLS)
    less = old.join(now.select(*keys), keys, "left_anti").select(*PARTITION_COLS)
    return now.join(new.unionByName(less).distinct(), PARTITION_COLS, "left_semi").select(*FIELDS)


def follow(spark: SparkSession, source: str, root: str, build: Callable[[DataFrame], DataFrame]) -> dict:
    """Brings the layer at ``root`` up to the current version of ``source``: ``build`` makes a partition's rows from the
    source's rows of that partition. Only changed partitions are read and written."""
    head, parent = _entry(spark, source, None), current(spark, root)
    seen = parent["source"] if parent else None
    if seen == head["version"]:
        return parent
    parts = changed_since(spark, source, seen)
    rows = build(read(spark, source, head["version"], parts))
    kept = None
    if parent:
        mine, now = manifest(spark, root), manifest(spark, source)
        kept = mine.join(parts.select(*PARTITION_COLS).distinct(), PARTITION_COLS, "left_anti").join(
            now.select(*PARTITION_COLS).distinct(), PARTITION_COLS, "left_semi")
    return _write_version(spark, root, parent, kept, rows, note={"what": "follow", "source": head["version"]})


# ---------------------------------------------------------------- reports from manifests

def compare(spark: SparkSession, root: str, before: int, after: int) -> DataFrame:
    """Rows by tier of two versions, from their manifests alone."""
    def side(version: int, name: str) -> DataFrame:
        return manifest(spark, root, version).select(F.explode("tiers").alias("risk_tier", name))

    both = side(before, "b").withColumn("a", F.lit(0)).unionByName(side(after, "a").withColumn("b", F.lit(0)))
    t = both.groupBy("risk_tier").agg(F.sum("b").alias("before_count"), F.sum("a").alias("after_count"))
    return t.where("before_count + after_count > 0").withColumn("risk_tier", F.nullif("risk_tier", F.lit("")))


def partitions_written(spark: SparkSession, root: str, version: int) -> DataFrame:
    """written and kept partitions of a version, one row."""
    mine = F.col("run") == F.lit(_entry(spark, root, version)["manifest"])
    days = manifest(spark, root, version).groupBy(*PARTITION_COLS).agg(F.max(mine).alias("mine"))
    return days.agg(F.count_if("mine").alias("written"), F.count_if(~F.col("mine")).alias("kept"))


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Removes what only versions before the last ``keep`` name, and what no version names. Returns the removed runs.

    Not to be run beside a writer: the folders of a run that has not yet committed look like those of a dead one."""
    entries = log(spark, root)
    stay = entries[-keep:]
    fs, path = file_system(spark, root)
    used = set()
    for e in stay:
        used |= {r["run"] for r in manifest(spark, root, e["version"]).select("run").distinct().collect()}
    manifests = {e["manifest"] for e in stay}
    gone = []
    for folder, alive in (("data", {f"run={r}" for r in used}), ("manifests", manifests)):
        at = path(f"{root}/{folder}")
        for s in (fs.listStatus(at) if fs.exists(at) else []):
            if s.getPath().getName() not in alive:
                fs.delete(s.getPath(), True)
                gone += [s.getPath().getName().removeprefix("run=")] if folder == "data" else []
    for e in entries[:-keep]:
        fs.delete(path(f"{root}/log/{e['version']:08d}.json"), False)
    return sorted(gone)
