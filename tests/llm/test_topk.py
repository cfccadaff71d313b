"""Exact top-k against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tierwise.llm import topk


def brute(rows, queries, k):
    def q(e):
        return None if e is None or any(x is None or not np.isfinite(x) for x in e) else [int(np.floor(256 * np.float64(np.float32(x)))) for x in e]

    cand = [(v, q(e)) for v, e in rows if v is not None and q(e) is not None]
    asked = {}
    for v, e in queries:
        if v is not None and q(e) is not None:
            asked[v] = min(asked.get(v, q(e)), q(e))
    out = []
    for v, a in asked.items():
        got = sorted(((-sum(x * y for x, y in zip(a, b)), w) for w, b in cand if w != v and len(a) == len(b)))[:k] if a else []
        out += [(v, i + 1, w, -s) for i, (s, w) in enumerate(got)]
    return sorted(out)


@pytest.mark.parametrize("block,scale", [(2048, 1.0), (37, 1.0), (37, 3e6)])
def test_search_is_brute_force(spark, block, scale):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 0.2, (160, 10))
    base[60:110] = base[60]                                  # one very common vector: ties by vec_id
    base[110] = 0
    rows = [(int(i), [float(np.float32(x * scale)) for x in v]) for i, v in enumerate(base)]
    rows += [(200, None), (201, [None] * 10), (202, [float("nan")] * 10), (203, [float("inf")] * 10), (None, rows[0][1]),
             (204, [1.0, 2.0]), (205, [2.0, -1.0]), (5, rows[5][1]), (206, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS dim", "3 AS q")
    asked = df.where("vec_id % 5 = 0 OR vec_id > 200 OR vec_id IS NULL")
    want = brute(rows, [(v, e) for v, e in rows if v is None or v % 5 == 0 or v > 200], 5)
    got = sorted(map(tuple, topk.search(df, asked, block=block).collect()))
    assert got == want


def test_few_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.search(df, df.where("vec_id = 0")).collect()))
    assert got == [(0, 1, 1, 128 * 256 + 128 * 512), (0, 2, 2, -256 * 256)]
    assert topk.search(df.limit(0), df).count() == 0 and topk.search(df, df.limit(0)).count() == 0
    assert topk.search(df.limit(1), df.limit(1)).count() == 0


def test_cutoff_only_drops_what_cannot_win(spark):
    """The cutoff of phase 1 is reached by at least k rows of the whole table."""
    rng = np.random.default_rng(0)
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(0, 1, (400, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.search(df, df.where("vec_id % 50 = 0"), block=64).groupBy("query_id").agg(F.count("*").alias("n")).collect()
    assert len(got) == 8 and {r.n for r in got} == {5}
