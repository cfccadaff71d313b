"""SpotSigs fingerprints against brute force."""

import hashlib
import random

import pytest
from tierwise.llm import spotsigs as S


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_signatures_are_chains_after_anchors():
    a = S.signatures("The quick brown fox of the big forest")
    assert len(a) == 3                                       # the:quick brown, of:big forest, the:big forest
    assert a == S.signatures("the QUICK, brown: fox... of the big forest!")
    assert len(S.signatures("xx yy zz")) == 3 and S.signatures("...") == S.signatures(None) == set()


def test_likeness_and_length_classes():
    rng = random.Random(0)
    for _ in range(2000):
        a = set(rng.sample(range(40), rng.randrange(30)))
        b = set(rng.sample(range(40), rng.randrange(30)))
        j = jaccard(a, b)
        assert S.likeness(a, b) == pytest.approx(j)
        for t in (0.3, 0.8):
            assert S.likeness(a, b, t) == (pytest.approx(j) if j >= t else 0.0) or j < t
            if j >= t and a and b:
                assert abs(S.length_class(len(a), t) - S.length_class(len(b), t)) <= 1


def texts(n):
    rng = random.Random(1)
    words = ["the", "of", "and", "alpha", "beta", "gamma", "delta", "é", "日本"]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(50))) for _ in range(n)]


@pytest.mark.parametrize("range_rows", [1000, 5])
def test_every_row_meets_its_next(spark, monkeypatch, range_rows):
    monkeypatch.setattr(S, "RANGE_ROWS", range_rows)
    rows = [(i * 7919 % 1000, t) for i, t in enumerate(texts(60))] + [(2**62, "the far id"), (2000, None), (2001, "x"), (2002, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS copied", "2 AS range_no").repartition(5)
    got = {r.doc_id: r for r in S.pairs_with_next(docs).collect()}
    order = sorted(rows)
    assert got.keys() == {d for d, _ in rows}
    for i, (d, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        q = len(t) // 4
        changed = t[:len(t) - q] + following[:q]
        r = got[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        a, e, f = S.signatures(t), S.signatures(changed), S.signatures(following)
        assert (r.fingerprint, r.edited_fingerprint) == (S.digest(a), S.digest(e))
        assert (r.near_edited, r.near_next) == (pytest.approx(jaccard(a, e)), pytest.approx(jaccard(a, f)))


def test_odd_rows(spark):
    rows = [(1, "b the x"), (1, "a the y"), (1, "a the y"), (None, "null id"), (2, "the long " * 40000)]
    got = S.pairs_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 7), (1, 7), (1, 7), (1, 7), (2, 360000)]
    one = S.pairs_with_next(spark.createDataFrame(rows[:1], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert S.pairs_with_next(spark.createDataFrame(rows, "doc_id long, text string").limit(0)).count() == 0


@pytest.mark.parametrize("n", [40, 400])
def test_digests_of_different_sets_differ(n):
    a = set(range(n)) | {10**6}
    b = set(range(n)) | {10**6 + 1}
    assert S.digest(a) != S.digest(b) and S.digest(a) == S.digest(set(sorted(a, reverse=True)))
    assert S.digest(a).rsplit("-", 1)[0] == S.digest(b).rsplit("-", 1)[0]


@pytest.mark.parametrize("cell,threshold", [(256, 0.5), (4, 0.5), (256, 0.8)])
def test_near_classes_are_brute_force(spark, monkeypatch, cell, threshold):
    """Near copies that are far apart in doc_id; chunks of a hot key."""
    monkeypatch.setattr(S, "CELL", cell)
    rng = random.Random(2)
    words = ["the", "of", "and"] + [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randrange(20, 120))) for _ in range(12)]
    rows = []
    for i in range(90):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i * 7919 % 1000, " ".join(w)))
    rows += [(2000, None), (2001, "..."), (2002, rows[0][1]), (2003, "alone here the stranger")]
    sets = [S.signatures(t) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if jaccard(a, b) >= threshold:
                    root[i] = root[j] = min(root[i], root[j])
    least = {r: min(d for (d, _), q in zip(rows, root) if q == r) for r in root}
    got = {r.doc_id: r.class_id for r in S.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), threshold).collect()}
    assert got == {d: least[r] for (d, _), r in zip(rows, root)}
    assert 3 < len(set(got.values())) < len(rows)
