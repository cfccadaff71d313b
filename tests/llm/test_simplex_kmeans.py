"""Exact k-means with n-simplex bounds against brute force."""

import hashlib

import numpy as np
from tierwise.llm import simplex_kmeans as sk


def brute(rows, k, rounds, dim, scale=1024):
    kept = [(v, [int(np.floor(scale * np.float64(np.float32(c)))) for c in e]) for v, e in rows
            if e is not None and len(e) == dim and all(c is not None and np.isfinite(c) and abs(c * scale) < sk.HUGE for c in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cent = [q for _, q in order[:k]]

    def near(q):
        d = [sum((a - b) ** 2 for a, b in zip(q, c)) for c in cent]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        of = [near(q)[0] for _, q in kept]
        cent = [[sum(x) // of.count(c) for x in zip(*[q for (_, q), o in zip(kept, of) if o == c])] if c in of else cent[c] for c in range(len(cent))]
    got = [near(q) for _, q in kept]
    each = [sum(d for c, d in got if c == i) for i in range(len(cent))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return [(v, c, d, each[c], sum(each), sha[c]) for (v, _), (c, d) in zip(kept, got)]


def test_report_is_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (120, 6)) + rng.integers(0, 4, (120, 1)) * 3
    x[40:80] = np.round(x[40:80])                                # ties
    x[80:90] = x[80]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    rows += [(None, rows[3][1]), (5, rows[5][1]), (200, None), (201, [None] * 6), (202, [float("nan")] * 6), (203, [float("-inf")] * 6),
             (204, [1.0]), (205, [1e30] * 6), (206, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS cluster", "2 AS q", "'a' AS apex")
    key = lambda r: tuple(str(c) for c in r)
    for k in (1, 5, 8):
        got = sk.report(df, k=k, dim=6, rounds=4)
        assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows, k, 4, 6), key=key)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_fewer_vectors_than_centroids_equal_ones_and_none(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], "vec_id long, embedding array<double>")
    assert {(r["cluster"], r["distance"], r["inertia"]) for r in sk.report(df, dim=2).collect()} == {(0, 0, 0)}
    assert sk.report(df.where("false"), dim=2).count() == 0


def test_bounds_hold_and_rule_out_centroids():
    rng = np.random.default_rng(8)
    for flat in (False, True):
        x = rng.integers(-5000, 5000, (3000, 16)) + rng.integers(0, 8, (3000, 1)) * 9000
        if flat:
            x[:, 3:] = 0                                         # pivots lie in one plane
        s = sk.Simplex(x[:8].astype(np.int64))
        a, c = s.apex(s.distances(x)), s.apex(s.distances(x[:8]))
        d = np.sqrt(((x[:, None] - x[None, :8]) ** 2).sum(axis=2))
        plane = ((a[:, None, :-1] - c[None, :, :-1]) ** 2).sum(axis=2)
        lower, upper = (np.sqrt(plane + (a[:, -1:] + sign * c[:, -1]) ** 2) for sign in (-1, 1))
        assert (lower <= d + 1).all() and (upper >= d - 1).all()
        number, squared, n = sk.nearest(x, a, x[:8], c)
        assert (squared == (d ** 2).min(axis=1).round()).all() and n < len(x) * 8 / 2
