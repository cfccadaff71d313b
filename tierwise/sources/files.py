"""File and table sources.

Every reader declares its schema; nothing is inferred from data.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import INDICATOR_JSON, OBSERVATION_START, PARTITION_COLS, RAW_LOAN


def read_raw(spark: SparkSession, path: str, schema: T.StructType = RAW_LOAN) -> DataFrame:
    """Raw loan JSON tree (``year=/month=/day=`` dirs become columns)."""
    return (spark.read.schema(schema)
            .option("mode", "PERMISSIVE")
            .option("recursiveFileLookup", "false")
            .json(path))


def read_lake(spark: SparkSession, path: str, folders: list[str] | None = None) -> DataFrame:
    """A parquet tree by year/month/day (or some of its folders) with partition values as text.

    The partition columns are declared, so ``month=04`` stays "04" whatever the session infers."""
    def load(reader):
        return reader.option("basePath", path).parquet(*(folders or [path]))

    found = load(spark.read).schema
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in PARTITION_COLS else f for f in found])
    return load(spark.read.schema(text))


def read_silver(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Silver (or gold) parquet; ``day='YYYY-MM-DD'`` prunes partitions."""
    df = read_lake(spark, path)
    if day is not None:
        y, m, d = day.split("-")
        df = df.where((F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d))
    return df


def read_loans_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3: header CSV, UTF-8, every column text (no inference)."""
    return (spark.read.option("header", True).option("encoding", "UTF-8")
            .option("inferSchema", False).csv(path))


def read_census_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Header-row JSON array (``[[h1,h2..],[v1,v2..],..]``) -> rows.

    Each payload is one array; its first inner array names the columns. A
    payload is a whole file, or with ``lines`` one line of a file (the form for
    large landings: bounded payloads, files that split). Bad or empty payloads
    yield no rows; a short row has nulls, what is beyond the header is ignored.
    """
    txt = spark.read.text(path) if lines else spark.read.option("wholetext", True).text(path)
    parsed = txt.select(F.input_file_name().alias("_file"),
                        F.from_json("value", "array<array<string>>", {"mode": "PERMISSIVE"}).alias("a"))
    rows = parsed.where(F.size("a") > 1).select(
        "_file", F.col("a")[0].alias("header"), F.posexplode(F.slice("a", 2, F.size("a") - 1)).alias("pos", "r"))
    cells = F.transform("header", lambda h, i: F.struct(h.alias("key"), F.get("r", i).alias("value")))
    return rows.select("_file", "pos", F.map_from_entries(cells).alias("fields"))


def census_fields(rows: DataFrame, names: list[str]) -> DataFrame:
    """Pick named fields out of ``read_census_json`` output."""
    return rows.select(*[F.try_element_at("fields", F.lit(n)).alias(n) for n in names])


def read_indicator_json(spark: SparkSession, path: str, key: str | None = None, lines: bool = False) -> DataFrame:
    """``{"data":[{date,value},..]}`` payloads -> (indicator, date, value, seq), value as text.

    A payload is a whole file, or with ``lines`` one line. ``key`` names the
    indicator; by default it is a partition column ``indicator`` or else the
    file's base name. seq is the place in the payload: of one date the later
    observation counts.
    """
    by_folder = key is None and "indicator" in spark.read.text(path).columns
    schema = T.StructType([*INDICATOR_JSON.fields, *([T.StructField("indicator", T.StringType())] if by_folder else [])])
    df = spark.read.schema(schema).option("multiLine", not lines).json(path)
    name = (F.lit(key) if key else F.col("indicator") if by_folder
            else F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.json)?$", 1))
    return df.select(name.alias("indicator"), F.posexplode("data").alias("seq", "d")).select(
        "indicator", F.col("d.date").alias("date"), F.col("d.value").alias("value"), F.col("seq").cast("long").alias("seq"))


def read_rates(spark: SparkSession, path: str, start: str = OBSERVATION_START) -> DataFrame:
    """Rate series CSV (series_id,date,value) from ``start``."""
    schema = "series_id string, date string, value string"
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.where(F.col("date") >= F.lit(start))


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = True) -> DataFrame:
    """(path, length, modificationTime) of every file under ``path``; a path that isn't there has none.

    Uses the binaryFile source but never selects ``content``, so no file body
    is read — the listing is distributed by Spark's file index.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    try:
        return r.load(path).select("path", "length", "modificationTime")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.sql("SELECT '' AS path, 0L AS length, current_timestamp() AS modificationTime WHERE false")


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Append frames by column name, no dedup."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or view by name (``source``/``ref``)."""
    return spark.table(name)


ref = table
source = table


def sample_rows(df: DataFrame, n: int = 10_000) -> DataFrame:
    """Bounded, unordered sample (the quality suite itself runs on the full table)."""
    return df.limit(n)


def fold_names(df: DataFrame, how: str = "lower") -> DataFrame:
    """P10: fold column-name case (cosmetic: Spark resolves names case-insensitively)."""
    f = str.lower if how == "lower" else str.upper
    return df.toDF(*[f(c) for c in df.columns])
