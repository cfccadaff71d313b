"""The nightly crawl (K10): a lake path against its catalog table.

A crawl lists the partition folders and compares them with the table's: new ones are added, and
their schema alone is read for columns that the table doesn't have yet. Partitions whose folder has gone are logged
and stay in the catalog (``vanished="drop"`` takes them out). What was done is returned as rows, a folder or
a column each; a crawl that finds nothing new returns none and touches no file's footer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import PARTITION_COLS
from ..session import file_system

LOG = "what string, item string"
BATCH = 500                     # partitions per statement


def partition_folders(spark: SparkSession, path: str) -> dict[tuple[str, ...], str]:
    """Partition values -> folder, from the listing (a folder per day)."""
    fs, at = file_system(spark, path)
    found = fs.globStatus(at(path + "".join(f"/{c}=*" for c in PARTITION_COLS))) or []
    out = {}
    for s in found:
        folder = s.getPath()
        values = tuple(part.split("=", 1)[1] for part in folder.toString().rsplit("/", len(PARTITION_COLS))[1:])
        out[values] = folder.toString()
    return out


def _spec(values: tuple[str, ...]) -> str:
    return ", ".join(f"{c} = '{v}'" for c, v in zip(PARTITION_COLS, values))


def _known(spark: SparkSession, table: str) -> set[tuple[str, ...]]:
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return {tuple(p.split("=", 1)[1] for p in r[0].split("/")) for r in rows}


def _types(schema) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema if f.name not in PARTITION_COLS}


def crawl(spark: SparkSession, path: str, table: str, vanished: str = "log") -> DataFrame:
    """Brings ``table`` up to the tree at ``path``; gives the log (what, item)."""
    if vanished not in ("log", "drop"):
        raise ValueError("vanished: log or drop")
    folders, log = partition_folders(spark, path), []
    exists = spark.catalog.tableExists(table)
    known = _known(spark, table) if exists else set()
    new = sorted(set(folders) - known)
    if new:
        # columns may differ between days: the new ones' footers, not the old ones'
        have = _types(spark.table(table).schema) if exists else {}
        merged = _types(spark.read.option("mergeSchema", True).option("basePath", path).parquet(*[folders[v] for v in new]).schema)
        more = {c: t for c, t in merged.items() if c not in have}
        if not exists:
            cols = ", ".join(f"`{c}` {t}" for c, t in more.items())
            parts = ", ".join(f"{c} string" for c in PARTITION_COLS)
            spark.sql(f"CREATE TABLE {table} ({cols}, {parts}) USING parquet PARTITIONED BY ({', '.join(PARTITION_COLS)}) LOCATION '{path}'")
            log.append(("table created", table))
        elif more:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{c}` {t}' for c, t in more.items())})")
            log += [("column added", c) for c in sorted(more)]
        for i in range(0, len(new), BATCH):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({_spec(v)})" for v in new[i:i + BATCH]))
        log += [("partition added", "-".join(v)) for v in new]
    for v in sorted(known - set(folders)):
        log.append(("partition vanished" if vanished == "log" else "partition dropped", "-".join(v)))
        if vanished == "drop":
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(v)})")
    if log:
        spark.catalog.refreshTable(table)
    return spark.createDataFrame(log, LOG)
