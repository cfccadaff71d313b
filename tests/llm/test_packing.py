"""Packing: ids of the plain tokenizer, every id in one piece, sum of squares, little padding."""

import random
import zlib

import numpy as np
import pytest
from tierwise.llm import packing
from tierwise.llm.queries import tokenizer_file
from tokenizers import Tokenizer

ODD = ["", " ", "\n", "a b", "  a  b ", "a\n\nb", "it's we'll 3,4.5 x.y", "é  ü\tö", "x<|endoftext|>y", "a\x00 b", "\x1c a", "a b c",
       "...,,, ,a .b", "日本語 テスト。", "a.", "A,b.c,", "_.x", "½. ²,", "﻿x y", "tail ", " lead", "w" * 3000, "😀, 😀."]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(tokenizer_file())


def ids_of(tok, text):
    return [*tok.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_encoder_is_the_tokenizer(tok):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("ab .,\n'é<|>1\t_") for _ in range(rng.randrange(60))) for _ in range(3000)]
    enc = packing.WordEncoder(tokenizer_file(), limit=50)           # a small cache is cleared again and again
    got = [x for lo in range(0, len(texts), 97) for x in enc.encode(texts[lo:lo + 97])]
    bad = [t for t, x in zip(texts, got) if np.frombuffer(x, "<u4").tolist() != ids_of(tok, t)[:-1]]
    assert not bad


def brute_level(count, rest, cap):
    """The fill level that minimises the sum of squared counts of partial windows."""
    best = None
    for h in range(cap - rest + 1):
        if h and not count[h]:
            continue
        after = count.copy()
        if h:
            after[h] -= 1
        if h + rest < cap:
            after[h + rest] += 1
        cost = (int((after ** 2).sum()), -h)
        best = min(best, (cost, h)) if best else (cost, h)
    return best[1]


def test_levels_follow_the_sum_of_squares():
    rng, cap = random.Random(0), 24
    p = packing.LevelPacker(cap)
    for i in range(600):
        n = rng.randrange(1, cap)
        before = p.count.copy()
        h = brute_level(before, n, cap)
        list(p.add((i, b"", n)))
        if h:
            before[h] -= 1
        if h + n < cap:
            before[h + n] += 1
        assert (p.count == before).all()


def test_every_id_lies_in_one_piece(spark, tok):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta,", "gamma."]) for _ in range(rng.randrange(900)))) for i in range(150)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, None), (7, rows[7][1]), (3000, "long text " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS length").repartition(3)
    got = packing.pack(docs, tokenizer_file()).collect()
    by, windows = {}, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        windows.setdefault(r.sequence_id, []).append(r)
    texts = dict(rows)
    for d, pieces in by.items():
        ids = np.array(ids_of(tok, texts[d]), "<u4")
        times = sum(1 for i, _ in rows if i == d)
        covered = np.zeros(len(ids), int)
        for r in pieces:
            part = ids[r.start:r.start + r.length]
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids)
            covered[r.start:r.start + r.length] += 1
        assert (covered == times).all()
    assert by.keys() == texts.keys()
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= 1024
    assert sum(sum(r.length for r in w) < 1024 for w in windows.values()) <= 3        # one open window a split
    assert packing.pack(docs.limit(0), tokenizer_file()).count() == 0
