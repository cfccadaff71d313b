"""Suffix dedup against brute force."""

from collections import Counter

import numpy as np
import pytest
from tierwise.llm import suffix_dedup as sd


def windows(texts, counts, length):
    seen = Counter()
    for t, n in zip(texts, counts):
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] += int(n)
    return [(k, i) for k, t in enumerate(texts) for i in range(len(t) - length + 1) if seen[t[i:i + length]] > 1]


def some_texts(rng, letters, n=30):
    def word(size):
        return bytes(rng.integers(97, 97 + letters, size).astype(np.uint8))

    base = [word(rng.integers(0, 300)) for _ in range(6)]
    out = []
    for _ in range(n):
        a = base[rng.integers(6)]
        i, j = sorted(rng.integers(0, len(a) + 1, 2))
        out.append(a[i:j] + base[rng.integers(6)][:rng.integers(0, 80)] + word(rng.integers(0, 60)))
    return out + [b"a" * 100, b"", b"ab" * 60]


@pytest.mark.parametrize("length,stride", [(40, 5), (24, 4), (40, 20), (40, 8)])
@pytest.mark.parametrize("letters", [2, 4, 26])
@pytest.mark.parametrize("shard", [20, 200, 10 ** 6])
def test_merge_of_shards_is_brute_force(length, stride, letters, shard):
    rng = np.random.default_rng(length + stride + letters + shard)
    texts = some_texts(rng, letters)
    counts = rng.integers(1, 3, len(texts))
    who, at = sd.repeated_windows(texts, counts, length, stride, shard)
    assert list(zip(who.tolist(), at.tolist())) == windows(texts, counts, length)


def test_merged_order_and_prefixes():
    """Merged transforms give the order of all suffixes, and common prefixes, of two shards sorted apart."""
    rng = np.random.default_rng(2)
    strings = [rng.integers(1, 3, rng.integers(1, 12)).tolist() for _ in range(20)]
    name = np.array([x for s in strings for x in [*s, 0]])
    left = np.concatenate([np.arange(len(s), -1, -1) for s in strings])
    start = np.concatenate([np.arange(len(s) + 1) == 0 for s in strings])
    cut = int(np.flatnonzero(start)[9])
    depth = 16
    places, prefix = sd.merged([sd.Shard(name, left, start, a, b, depth) for a, b in ((0, cut), (cut, len(name)))], depth)
    suffix = [tuple(name[p:p + left[p]]) for p in places]
    assert sorted(places.tolist()) == list(range(len(name))) and suffix == sorted(suffix)
    for a, b, n in zip(suffix, suffix[1:], prefix[1:]):
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert n == (depth if a == b else same)


def test_anchors_split_all_windows():
    rng = np.random.default_rng(5)
    for text in (*some_texts(rng, 2), bytes(rng.integers(97, 99, 3 * sd.PIECE // 2).astype(np.uint8))):
        got = [w for _, first, last, at in sd.segments_of(text, 40) for a, b, p in zip(first, last, at)
               for w in range(a, b + 1) if w <= p <= w + 20]
        assert got == list(range(max(0, len(text) - 39)))


def brute(texts, length):
    texts = [(t or "").encode() for t in texts]
    gone = [set() for _ in texts]
    for k, i in windows(texts, [1] * len(texts), length):
        gone[k].update(range(i, i + length))
    return sorted((len(t), len(g), sum(1 for i in g if i - 1 not in g), bytes(c for i, c in enumerate(t) if i not in g))
                  for t, g in zip(texts, gone))


@pytest.mark.parametrize("unit", [1, 3, 1000])
def test_table_is_brute_force(spark, unit):
    """Unit 1 and 3 halve nearly every unit, down to whole windows."""
    rng = np.random.default_rng(7)
    texts = [t.decode() for t in some_texts(rng, 3, 60)] + [None, "", "übergröße" * 12, "übergröße" * 12]
    shared = "x" * 30 + "".join(map(chr, rng.integers(97, 123, 50)))
    texts += ["".join(map(chr, rng.integers(97, 123, 9))) + shared + str(i) * 9 for i in range(25)]
    rows = [(None if i % 9 == 0 else i // 2, t, "mine", 7) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, t1 int")
    got = sd.deduplicated(df, 40, 8, unit)
    assert got.columns == ["doc_id", "t1", "kept", "n_bytes", "spans"]
    rows = got.collect()
    assert sorted((r["n_bytes"], sum(s["end"] - s["first"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"])) for r in rows) == brute(texts, 40)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(None if i % 9 == 0 else i // 2) for i in range(len(texts)))


def test_nothing_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(1, "short"), (2, None), (3, "abc" + "".join(map(chr, range(300, 900))))], "doc_id long, text string")
    assert [len(r["spans"]) for r in sd.deduplicated(df).collect()] == [0, 0, 0]
    assert sd.deduplicated(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        sd.repeated_spans(df, 400, 33)


def test_quarter_anchors_split_all_windows():
    """Fewer, longer segments than with anchors of half a window, and every window is in one of them."""
    rng = np.random.default_rng(6)
    for text in some_texts(rng, 26):
        found = list(sd.segments_of(text, 40, sd.anchor_width(40)))
        got = [w for _, first, last, at in found for a, b, p in zip(first, last, at) for w in range(a, b + 1) if w <= p <= w + 30]
        assert got == list(range(max(0, len(text) - 39)))
    text = bytes(rng.integers(97, 123, 40000).astype(np.uint8))
    few, many = (sum(len(g) for g, *_ in sd.segments_of(text, 400, width)) for width in (sd.anchor_width(400), None))
    assert few < 0.8 * many


def test_bytes_of_segments_travel_once(spark):
    """Units come from the written segments without a join or a shuffle of their bytes."""
    rows = [(g, i, i, 1, 1, 3, 3, bytes([97 + i]) * 45) for g in range(4) for i in range(3)]
    cut = spark.createDataFrame(rows, "unit long, i1 long, i2 long, n long, fan int, off int, members long, bytes binary")
    done, maps = sd._units(cut, 40, 10)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert done.count() == 12 and not maps and "Join" not in plan and "Exchange" not in plan
