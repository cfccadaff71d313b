"""SimHash near-dedup against brute force."""

import re

import numpy as np
import pytest
import xxhash
from tierwise.llm import simhash
from tierwise.llm.graph import components, local_components


def brute_components(fps: np.ndarray, max_bits: int) -> list[int]:
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_bits)
    root = np.arange(len(fps))
    for _ in range(len(fps)):
        new = root.copy()
        np.minimum.at(new, a, root[b])
        if (new == root).all():
            break
        root = new
    return root.tolist()


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def clustered(n, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**64, n // 3, dtype=np.uint64)
    near = base[rng.integers(0, len(base) // 4, n)]
    for _ in range(4):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)) * rng.integers(0, 2, n, dtype=np.uint64)
    return np.unique(np.concatenate([base, near, np.zeros(1, np.uint64)]))


def test_gray_rank_orders_the_reflected_code():
    i = np.arange(4096, dtype=np.uint64)
    assert (simhash.gray_rank(i ^ (i >> np.uint64(1))) == i).all()


@pytest.mark.parametrize("n", [1, 2, 60, 64, 65, 700, 3000])
@pytest.mark.parametrize("bits", [0, 4])
def test_forest_is_brute_force(n, bits):
    x = clustered(n) if n > 2 else np.arange(n, dtype=np.uint64)
    np.random.default_rng(0).shuffle(x)
    assert simhash.forest(x, bits).tolist() == brute_components(x, bits)


def test_groups_are_pruned():
    """On a node of the usual size most pairs of leaves are dropped above them or by their shared bits."""
    x = clustered(simhash.MEMBERS)
    g = x[np.argsort(simhash.gray_rank(x))]
    levels = simhash._levels(g)
    leaves = len(levels[0][0])
    a, _ = simhash.near_leaves(levels, 4)
    assert len(levels) > 3
    assert leaves <= len(a) < leaves * (leaves + 1) / 2 / 5


def test_nodes_keep_their_size_as_the_table_grows():
    for n in (0, 1, 10**3, 10**5, 10**6):
        s = simhash.segment_count(n)
        nodes = 2 ** (simhash.leading_bits(n, s) * (s - 4))
        assert n / nodes <= simhash.MEMBERS and (nodes == 1 or n / nodes * 4 > simhash.MEMBERS / 2)


def test_local_components():
    assert local_components(6, np.array([4, 2, 5]), np.array([2, 0, 5])).tolist() == [0, 1, 0, 3, 0, 5]


def test_spark_components_of_chains_and_stars(spark):
    e = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 4)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(e, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}


@pytest.mark.parametrize("segments,node", [(None, 2048), (5, 50), (6, 2048), (8, 100)])
def test_links_give_brute_force_components(spark, segments, node):
    x = clustered(1500)
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    e = simhash.links(df, 4, segments, node)
    got = {r["node"]: r["root"] for r in components(e).collect()}
    signed = x.view(np.int64)
    comp = [got.get(int(v), int(v)) for v in signed]
    brute = brute_components(x, 4)
    assert len(set(zip(comp, brute))) == len(set(comp)) == len(set(brute))


def test_fingerprints_and_components_with_odd_rows(spark):
    body = " ".join(f"word{i}" for i in range(300))
    rows = [(1, body), (2, body), (3, body + " end"), (4, None), (5, ""), (6, " \t\n"), (7, "One two"), (8, "one TWO"),
            (9, "É È"), (9, "É È"), (None, body), (10, "x " * 50000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as fp", "2 as root")
    got = simhash.near_dedup(docs).collect()
    assert len(got) == len(rows)
    fps = {(r["doc_id"], r["fp"] & (2**64 - 1)) for r in got}
    assert fps == {(d, brute_fingerprint(t)) for d, t in rows}
    x = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    root = brute_components(x, 4)
    least = {c: min(d for (d, _), r in zip(rows, root) if r == c and d is not None) for c in set(root)}
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in got) == sorted(
        (d or 0, least[c]) for (d, _), c in zip(rows, root))
    kept = simhash.deduplicated(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(least.values()))
    assert simhash.near_dedup(docs.limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    """Several null ids, and ids that repeat with different texts."""
    def body(k, n=300):
        return " ".join(f"{k}{i}" for i in range(n))

    rows = [(None, body("a")), (None, body("b")), (None, body("b")), (None, body("c")), (None, body("d")), (4, body("d")),
            (1, body("e")), (1, body("f")), (1, body("g")),              # one id, three components
            (2, body("e")), (2, body("h")),                              # an id below a smaller one that heads its own too
            (3, body("i") + " end"), (3, body("i")), (None, None), (None, ""), (5, body("j")), (5, body("j"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    x = np.array([brute_fingerprint(t) for _, t in rows], np.uint64)
    want = {}
    for row, c in zip(rows, brute_components(x, 4)):
        key = (row[0] is None, row[0] or 0, row[1] is not None, row[1] or "")
        want[c] = min(want.get(c, (key, row)), (key, row), key=lambda k: k[0])
    got = [tuple(r) for r in simhash.deduplicated(docs).collect()]
    assert sorted(got, key=str) == sorted((r for _, r in want.values()), key=str)
    assert len(got) == 11
