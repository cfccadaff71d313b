"""License scan against a plain search for words."""

import re

from tierwise.llm import license_scan as L

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TEXTS = [
    None, "", " .,! ", "CC BY", "cc-by cc  by, xcc by", "cc by cc by cc", "All rights reserved. ALL RIGHTS RESERVED",
    "the GNU General\nPublic License", "général public license", "all rights rights reserved", "Kc by", "İ cc by é",
    "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License!",
    "x " * 40000 + "released under the mit license", "Permission is hereby granted free of charge to any person who is obtaining "
    "a copy of this software and associated documentation files", "Permission is hereby granted"]


def plain(text):
    w = re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for label, phrase in L.BASE:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_places_are_a_plain_search(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "CC BY"), (None, "cc by")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 AS n", "2 AS w", "3 AS label", "4 AS h", "5 AS t", "6 AS rid")
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                 for r in L.scan(docs).collect())
    assert [g[0] for g in got] == sorted(-1 if i is None else i for i, _ in rows)
    assert got == sorted(((-1 if i is None else i), *plain(t)) for i, t in rows)
    assert L.scan(docs.limit(0)).count() == 0


def test_notices_edits_and_scores(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan(docs).collect()}
    assert (got[12].labels, got[12].score) == ("apache-2.0", 1.0)
    assert (got[13].labels, got[13].base_labels) == ("cc-by,cc-by-nc", "cc-by")
    assert got[14].labels == got[15].labels == "mit"
    assert (got[16].labels, got[16].n_spans) == ("mit", 1)               # two words inserted: two diagonals, one span
    assert got[17].labels == "" and 0 < got[17].score < 0.8
    assert got[0].score == got[2].score == 0


def test_without_the_hash_list_the_join_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if len(t or "") < 1000], "doc_id long, text string")
    want = sorted(map(str, L.scan(docs).collect()))
    monkeypatch.setattr(L, "BROADCAST_PLACES", 0)
    assert sorted(map(str, L.scan(docs).collect())) == want


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame([(1, "cc by")], "doc_id long, text string")
    plan = L.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
