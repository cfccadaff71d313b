"""A layout for lookups and segments (F9, F17, O1, O3): rows along a space-filling curve, Bloom filters on the key.

Each clustering column is cut into ``2 ** BITS`` ranges of about equal rows (bounds from one approximate-percentile
aggregate; text by its first bytes), and the ranges' numbers are interleaved bit by bit (Morton order). Files are
ranges of the curve, so a row group holds a small box of all columns at once and its statistics rule it out for
filters on any of them. Rows of one cell are dealt on by the first column's value and the key, so a hot cell is not
one task. A Bloom filter per row group rules out all but one group for a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 4
GROUP_BYTES = 64 << 20


def _number(df: DataFrame, c: str) -> Column:
    """An order-preserving number: text by its first 6 bytes."""
    if dict(df.dtypes)[c] == "string":
        head = F.rpad(F.hex(F.substring(F.col(c).cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    return F.col(c).cast("double")


def curve(df: DataFrame, columns: list[str], bits: int = BITS) -> DataFrame:
    """df with _curve: the place of each row's cell along the Morton curve of these columns; nulls come first."""
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    numbers = {c: _number(df, c) for c in columns}
    # a few numbers per column, whatever the table's size
    bounds = df.agg(*[F.approx_percentile(n, shares, 10000).alias(c) for c, n in numbers.items()]).first()
    cell = []
    for c, n in numbers.items():
        over = [F.when(n > F.lit(float(b)), 1).otherwise(0) for b in sorted(set(bounds[c] or []))]
        cell.append(sum(over, F.lit(0)))
    place = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for n in cell:
            place = place * 2 + F.shiftright(n, bit).bitwiseAND(F.lit(1)).cast("long")
    return df.withColumn("_curve", place)


def write_clustered(df: DataFrame, path: str, columns: list[str], key: str, files: int | None = None,
                    group_bytes: int = GROUP_BYTES, distinct_keys: int = 1_000_000) -> None:
    """Writes df along the curve of ``columns`` with Bloom filters on ``key``; ``distinct_keys``: per row group, sizes the filter."""
    order = ["_curve", columns[0], key]
    placed = curve(df, columns)
    dealt = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    (dealt.sortWithinPartitions(*order).drop("_curve").write.mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(distinct_keys))
     .option("parquet.block.size", str(group_bytes)).parquet(path))
