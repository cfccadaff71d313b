"""Exact top-k inner products by a three-phase uniform threshold.

A score is the sum of one partial score per slice of the dimensions, so each
slice is a list of local scores.

1. Every block of rows gathers, for each query, the ``k`` best of each list, and
   sends the ``k`` best full scores among them. The k-th best of all that was
   sent is the query's cutoff: at least ``k`` rows reach it.
2. The cutoff goes back to the blocks. A row whose score reaches the cutoff has
   a partial score of at least cutoff / lists in some list, so those entries are
   sufficient; all of them are collected, ties included.
3. Their remaining partial scores are resolved exactly, and those that reach the
   cutoff compete for the k ranks.

Queries and rows are dealt out in blocks of ``BLOCK``; a unit is one block of
queries against one block of rows, in one matrix product per list. A unit's
memory is bounded whatever the table's size, and from a phase k rows per query
and block leave.

Components are floor(256 * x) as integers; scores must fit a long. Products are added up in doubles
while every sum stays under 2**53, else in 64-bit integers: both are exact.

Defined cases: vectors that are null or hold null or non-finite components, and
rows without vec_id, take no part; a row is a candidate for queries of its own
dimension; rows with the query's vec_id are its own; a repeated query id is
answered once (for its least vector), repeated candidates are ranked each; fewer
candidates than k give fewer rows; an empty table gives none; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 5
LISTS = 4
BLOCK = 2048
SCALE = 256
UNIT = ("dim", "rb", "qb")
_SENT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(rows: DataFrame) -> DataFrame:
    """vec_id, q (integer components), dim of the rows that take part."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    q = F.transform(e, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    return (rows.where(F.col("vec_id").isNotNull() & e.isNotNull() & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"), F.size(e).alias("dim")))


def _dealt(df: DataFrame, own: str, other: str, n_own: int, n_other: int) -> DataFrame:
    """df dealt to n_own blocks by its id, each row to all n_other blocks of the other side."""
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_own)).cast("int")
    return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))


def _matrix(t: pa.Table, dim: int) -> np.ndarray:
    return t["q"].combine_chunks().flatten().to_numpy().reshape(-1, dim)


def _parts(x: np.ndarray, q: np.ndarray, lists: int) -> list[np.ndarray]:
    """Partial scores (rows x queries) per list."""
    top = max(float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(q.astype(float)).max(initial=0)), 1.0)
    kind = np.float64 if top * x.shape[1] < 2.0 ** 53 else np.int64
    x, q = x.astype(kind), q.astype(kind).T
    edge = [x.shape[1] * i // lists for i in range(lists + 1)]
    return [x[:, a:b] @ q[a:b] for a, b in zip(edge, edge[1:]) if b > a]


def _best(query_ids, vec_ids, row, col, score, k: int) -> pa.Table:
    """The k best of the entries (row, col, score) of each query column."""
    order = np.lexsort((vec_ids[row], -score, col))
    row, col, score = row[order], col[order], score[order]
    first = np.flatnonzero(np.r_[True, col[1:] != col[:-1]]) if len(col) else np.empty(0, np.int64)
    nth = np.arange(len(col)) - np.repeat(first, np.diff(np.r_[first, len(col)]))
    row, col, score = row[nth < k], col[nth < k], score[nth < k]
    return pa.Table.from_arrays([pa.array(query_ids[col]), pa.array(vec_ids[row]), pa.array(score.astype(np.int64))],
                                schema=_SENT)


def _unit(k: int, lists: int, cut: bool):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return _SENT.empty_table()
        dim = rows["dim"][0].as_py()
        if not dim:
            return _SENT.empty_table()
        vec_ids, query_ids = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        parts = _parts(_matrix(rows, dim), _matrix(queries, dim), lists)
        other = vec_ids[:, None] != query_ids[None, :]
        if cut:                                             # phases 2 and 3
            cutoff = queries["cutoff"].combine_chunks().fill_null(-2 ** 62).to_numpy()
            least = cutoff / len(parts)
            some = np.zeros(other.shape, bool)
            for p in parts:
                some |= p >= least
        else:                                               # phase 1
            some = np.zeros(other.shape, bool)
            n = min(k + 1, len(vec_ids))                    # the query's own row may be among them
            for p in parts:
                some[np.argpartition(p, len(vec_ids) - n, axis=0)[-n:], np.arange(len(query_ids))] = True
        row, col = np.nonzero(some & other)
        score = sum(p[row, col] for p in parts)
        if cut:
            reach = score >= cutoff[col]
            row, col, score = row[reach], col[reach], score[reach]
        return _best(query_ids, vec_ids, row, col, score, k)

    return run


def _ranked(sent: DataFrame) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    return sent.withColumn("rank", F.row_number().over(by))


def search(rows: DataFrame, queries: DataFrame, k: int = K, lists: int = LISTS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each query. Both sides: vec_id, embedding."""
    x = quantised(rows)
    q = quantised(queries).groupBy("vec_id").agg(F.min("q").alias("q")).withColumn("dim", F.size("q"))
    n_rows, n_queries = x.count(), q.count()
    rb, qb = max(1, -(-n_rows // block)), max(1, -(-n_queries // block))
    dealt = _dealt(x, "rb", "qb", rb, qb)

    def phase(queries: DataFrame, cut: bool) -> DataFrame:
        sides = dealt.groupBy(*UNIT).cogroup(_dealt(queries, "qb", "rb", qb, rb).groupBy(*UNIT))
        return sides.applyInArrow(_unit(k, lists, cut), "query_id long, vec_id long, score long")

    cutoff = _ranked(phase(q, False)).where(F.col("rank") == k).select(F.col("query_id").alias("of"), F.col("score").alias("cutoff"))
    q = q.join(cutoff, F.col("vec_id") == F.col("of"), "left").drop("of")
    return _ranked(phase(q, True)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
