"""Importance resampling against brute force."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from tierwise.llm import importance as im

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, grams):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return w, [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in range(1, grams + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, grams, buckets, min_words, percent):
    def counted(texts):
        out = {}
        for t in texts:
            for c in features(t, grams)[1]:
                out[c % buckets] = out.get(c % buckets, 0) + 1
        return out

    s, t = counted(x for _, x in docs), counted(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t.get(b, 0) + 1) * (s_all + buckets) / ((s.get(b, 0) + 1) * (t_all + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        w, f = features(text, grams)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[c % buckets] for c in f)
        rows.append((len(w), i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[0] >= min_words), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2], r[3]))
    n = percent * len(able) // 100
    return [(*r[1:], k + 1 if k < n else None) for k, r in enumerate(able)] + [(*r[1:], None) for r in rows if r[0] < min_words]


@pytest.mark.parametrize("grams", [1, 3])
def test_resample_is_brute_force(spark, grams):
    rng = np.random.default_rng(6)
    words = ["Über", "the", "The", "ab", "a", "b", "x9", "日本", "naïve", "É", " ", "of"]
    docs = [(int(i), "".join(words[k] + [" ", ", ", "\n", "--"][k % 4] for k in rng.integers(0, len(words), rng.integers(0, 60)))) for i in range(80)]
    docs += [(None, docs[0][1]), (None, docs[1][1]), (3, docs[3][1]), (3, docs[3][1]), (90, None), (91, ""), (92, "...\0 ;"), (93, "long word " * 30000)]
    target = [t for _, t in docs[:9]] + [None, "only here"]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS weight", "2 AS rank", "3 AS range")
    got = im.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), grams, 50, 5, 30)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(docs, target, grams, 50, 5, 30), key=str)


def test_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = df.where("false")
    assert im.resample(none, df).count() == 0
    assert [tuple(r)[:2] for r in im.resample(df, none).collect()] == [(1, 3)]


def test_crc_of_a_run_from_its_words():
    words = [b"a", b"bc" * 9, "日本".encode(), b"z" * 3000, b"q"]
    d = im.Dictionary([b" " + w + b" " for w in words])
    text = b" " + b" ".join(words) + b" "
    assert d.features(d.payloads(text), 4).tolist() == [zlib.crc32(b" ".join(words[i:i + n])) for n in (1, 2, 3, 4) for i in range(6 - n)]
