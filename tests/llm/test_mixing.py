"""Mixing: targets by water filling, sizes kept, reruns and odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F
from tierwise.llm import mixing


def brute_targets(sizes: dict, weights=(5, 2, 1), share=1.5, ceiling=2) -> dict:
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, total = {}, set(order), share * sum(sizes.values())
    while left:
        each = total / sum(weight[s] for s in left)
        full = {s for s in left if each * weight[s] > ceiling * sizes[s]}
        if not full:
            target.update({s: each * weight[s] for s in left})
            break
        target.update({s: ceiling * sizes[s] for s in full})
        total -= sum(ceiling * sizes[s] for s in full)
        left -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, "d": 7, None: 50}, {"x": 10}, {"a": 0, "b": 9},
    {f"s{i}": (i * 37) % 101 + 1 for i in range(40)}, {"é": 5, "z": 5, "Z": 5, "\U0001F600": 5, "￮": 5}])
def test_targets_are_water_filling(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-9)


def documents(spark, n=3000, seed=3):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * min(int(rng.expovariate(1 / 60)), 900)), None if i % 11 == 0 else f"src{i % 7 if i % 3 else 0}")
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_taken_words_meet_the_targets_and_reruns_agree(spark):
    rows, docs = documents(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and {r.doc_id for r in got} == {r[0] for r in rows}
    by = {}
    for r in got:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", rows[r.doc_id][1]))
        assert r.taken in (0, r["size"], 2 * r["size"])
        by.setdefault(r.source, []).append(r)
    for rs in by.values():
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r["size"] for r in rs) + 1e-6
        assert sum(r["size"] for r in rs) == rs[0].source_size
    again = mixing.mix(docs.repartition(7).orderBy(F.desc("doc_id"))).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_fold_keeps_mass_and_settles_all_but_one(spark):
    rng = random.Random(1)
    items = [(rng.random(), i, s, 0, 1, s * rng.random()) for i, s in enumerate(rng.choices(range(1, 50), k=200))]
    df = spark.createDataFrame([(items,)], "items array<struct<draw:double,doc_id:long,size:long,base:long,n:long,mass:double>>")
    f = df.select(mixing._fold(F.col("items")).alias("f")).first().f
    assert len(f.out) == 199 and {x.take for x in f.out} == {0, 1}
    assert sorted([x.doc_id for x in f.out] + [f.cur.doc_id]) == list(range(200))
    assert sum(x["size"] * x.take for x in f.out) + f.cur.mass == pytest.approx(sum(i[5] for i in items))
    assert 0 <= f.cur.mass <= f.cur["size"]


def test_inclusion_follows_the_fraction(spark, monkeypatch):
    """Over many seeds a document is taken about as often as its fraction says."""
    rows = [(i, "w " * s, "a") for i, s in enumerate([1, 2, 3, 5, 8, 13])] + [(9, "w " * 30, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    total = {}
    for seed in range(4):
        monkeypatch.setattr(mixing, "SEED", 1000 + seed)
        for r in mixing.mix(docs).collect():
            total.setdefault(r.doc_id, []).append((r.copies, r.target / r.source_size))
    mean = sum(c for v in total.values() for c, _ in v) / sum(p for v in total.values() for _, p in v)
    assert 0.7 < mean < 1.3


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", "a"), (3, "one two", "a"), (3, "one two", "a"), (None, "x", None),
            (4, "  y", "b"), (5, "long " * 60000, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "1 AS size", "2 AS n", "3 AS k", "4 AS copies", "5 AS key")
    got = mixing.mix(docs).collect()
    assert sorted((r.doc_id or 0, r["size"]) for r in got) == [(0, 1), (1, 0), (2, 0), (3, 2), (3, 2), (3, 2), (4, 2), (5, 60000)]
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    kept = mixing.mixed_documents(docs)
    assert kept.columns == docs.columns
    want = {}
    for r in got:
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    have = {r.doc_id: r["count"] for r in kept.groupBy("doc_id").count().collect()}
    assert have == {k: v for k, v in want.items() if v}
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed_documents(docs.limit(0)).count() == 0
