"""License scans by diagonal voting.

Every place of every text gives rolling hashes of its next 2 and next 3 words.
They are joined to the places of the same hashes in the license templates. A
hit (text place p, template place t) votes for the diagonal p - t, on which the
template would begin in the text. Votes are added up by (document, template,
diagonal); neighbouring diagonals, which edits split, are merged; a span counts
when the votes cover enough of the template's words. Each hit is verified by
comparing the words themselves, so a vote is never a mere hash collision, and a
full diagonal of a phrase is that phrase word for word.

All on DataFrame functions. The templates are broadcast only up to
``BROADCAST_PLACES`` places; beyond, the join is left to Spark. The hits of a
document are aggregated before any shuffle; only (document, diagonal) votes
move, never texts.

Defined cases: a null or wordless text has no words and no spans; repeated rows
give repeated results; a null doc_id stays null; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 3                       # words of a seed; phrases of 2 words have seeds of 2
MAX_SHIFT = 4               # words that an edit may insert or drop between two seeds of a span
MIN_COVERAGE = 0.8          # of a template's words
BROADCAST_PLACES = 10_000

# Base phrases and labels.
BASE = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]
# Opening words of public license notices.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]


def words(docs: DataFrame, text: str) -> DataFrame:
    """docs with the columns w (words of the text, A-Z lowered) and n (their number).

    ``lower`` is the fast way to lower A-Z; the one other code point that it would turn into an
    ASCII letter, the Kelvin sign, is kept apart (letters beyond ASCII are lowered too, which
    no phrase of ASCII words can tell)."""
    low = F.lower(F.replace(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    d = docs.withColumn("w", F.split(low, GAPS))
    every = F.size("w")
    lead = F.when(F.get("w", F.lit(0)) == "", 1).otherwise(0)
    trail = F.when((every > 1) & (F.element_at("w", -1) == ""), 1).otherwise(0)
    return d.withColumn("w", F.slice("w", lead + 1, every - lead - trail)).withColumn("n", F.size("w"))


def _pair(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _rolling(d: DataFrame) -> DataFrame:
    """d with h2 and h3: the hashes of the 2 and 3 words from each place on. h3[p] is rolled from
    h2[p] and the word two places on."""
    def fewer(c: str) -> Column:
        return F.greatest(F.size(c) - 1, F.lit(0))

    d = d.withColumn("hw", F.transform("w", lambda x: F.xxhash64(x)))
    # zip_with would fill up the shorter array with nulls: both are cut to one length
    d = d.withColumn("h2", F.zip_with(F.slice("hw", 1, fewer("hw")), F.slice("hw", 2, fewer("hw")), _pair))
    return d.withColumn("h3", F.zip_with(F.slice("h2", 1, fewer("h2")), F.slice("hw", 3, fewer("h2")), _pair)).drop("hw")


def _places(k: int, found: str | None = None) -> Column:
    """Array of the places p of seed length k: p, k, h and the words. found: a column with the hashes to keep."""
    h, w = F.col(f"h{k}"), F.col("w")
    last, none = F.size(h) - 1, F.array().cast("array<int>")
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(none)
    if found is not None:
        at = F.when(F.size(found) > 0, F.filter(at, lambda p: F.array_contains(F.col(found), F.get(h, p)))).otherwise(none)
    return F.transform(at, lambda p: F.struct(
        p.alias("p"), F.lit(k).alias("k"), F.get(h, p).alias("h"), F.get(w, p).alias("a"), F.get(w, p + 1).alias("b"),
        F.when(F.lit(k) == 3, F.get(w, p + 2)).alias("c")))


def _phrase_words(phrase: str) -> list[str]:
    return phrase.split()


def _template_hashes(rows, k: int) -> Column:
    """The seeds of length k, as a literal array."""
    out = []
    for _, phrase in rows:
        w = _phrase_words(phrase)
        if min(K, len(w)) != k:
            continue
        for i in range(len(w) - k + 1):
            h = _pair(F.xxhash64(F.lit(w[i])), F.xxhash64(F.lit(w[i + 1])))
            out.append(_pair(h, F.xxhash64(F.lit(w[i + 2]))) if k == 3 else h)
    return F.array(*out) if out else F.array().cast("array<bigint>")


def templates(spark: SparkSession, base=BASE, notices=NOTICES) -> DataFrame:
    """A row per template place: t_id, label, is_base, t_len, t, t_k, t_h and its words."""
    rows = [(label, phrase, True) for label, phrase in base] + [(label, phrase, False) for label, phrase in notices]
    lits = F.array(*[F.struct(F.lit(i).alias("t_id"), F.lit(a).alias("label"), F.lit(p).alias("phrase"),
                              F.lit(b).alias("is_base")) for i, (a, p, b) in enumerate(rows)])
    t = _rolling(words(spark.range(1).select(F.inline(lits)), "phrase"))
    seeds = F.when(F.col("n") < K, _places(2)).otherwise(_places(3))
    t = t.select("t_id", "label", "is_base", "n", F.explode(seeds).alias("s"))
    return t.select("t_id", "label", "is_base", F.col("n").alias("t_len"), F.col("s.p").alias("t"),
                    F.col("s.k").alias("t_k"), F.col("s.h").alias("t_h"), F.col("s.a").alias("ta"),
                    F.col("s.b").alias("tb"), F.col("s.c").alias("tc"))


def votes(docs: DataFrame, base=BASE, notices=NOTICES) -> DataFrame:
    """Verified votes: per row of docs its rid, doc_id and n, once with null t_id, and per
    (template, diagonal) t_id, label, is_base, t_len, diag and the voted template places ts.

    Seeds that no template has are dropped by a literal list of the templates' hashes before
    places become rows; with more templates than the bound, every place goes to the join."""
    d = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.col("text").cast("string").alias("text"))
    d = _rolling(words(d, "text").drop("text"))
    every = [*base, *notices]
    bounded = sum(len(_phrase_words(p)) for _, p in every) <= BROADCAST_PLACES
    if bounded:
        for k in (2, 3):
            d = d.withColumn(f"found{k}", F.array_intersect(f"h{k}", _template_hashes(every, k)))
    places = F.concat(F.array(F.lit(None).cast("struct<p:int,k:int,h:bigint,a:string,b:string,c:string>")),
                      *[_places(k, f"found{k}" if bounded else None) for k in (2, 3)])
    d = d.select("rid", "doc_id", "n", places.alias("places"))
    # outer: else Spark infers a filter on the array's size and evaluates all of it twice
    d = d.select("rid", "doc_id", "n", F.explode_outer("places").alias("s")).select("rid", "doc_id", "n", "s.*")
    t = templates(docs.sparkSession, base, notices)
    t = F.broadcast(t) if bounded else t
    same = ((F.col("h") == F.col("t_h")) & (F.col("k") == F.col("t_k")) & (F.col("a") == F.col("ta"))
            & (F.col("b") == F.col("tb")) & F.col("c").eqNullSafe(F.col("tc")))
    hits = d.join(t, same, "left").where(F.col("t_id").isNotNull() | F.col("p").isNull())
    hits = hits.withColumn("diag", F.col("p") - F.col("t"))
    # the places of a template are few, so the set is bounded by the template
    return hits.groupBy("rid", "doc_id", "n", "t_id", "label", "is_base", "t_len", "t_k", "diag").agg(
        F.collect_set("t").alias("ts"))


def scan(docs: DataFrame, base=BASE, notices=NOTICES, min_coverage: float = MIN_COVERAGE,
         max_shift: int = MAX_SHIFT) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans.

    labels holds the base labels and those of notices of which a span covers
    ``min_coverage`` of the words; score is the best cover of any template."""
    v = votes(docs, base, notices)
    doc = ["rid", "doc_id", "n"]
    by = Window.partitionBy(*doc, "t_id").orderBy("diag")
    v = v.withColumn("gap", F.col("diag") - F.lag("diag").over(by))
    # a base phrase is exact: its diagonals are never merged
    v = v.withColumn("new", F.when(F.col("is_base") | F.col("gap").isNull() | (F.col("gap") > max_shift), 1).otherwise(0))
    v = v.withColumn("span", F.sum("new").over(by))
    s = v.groupBy(*doc, "t_id", "label", "is_base", "t_len", "t_k", "span").agg(
        F.min("diag").alias("start"), F.array_distinct(F.flatten(F.collect_list("ts"))).alias("ts"))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "ts", lambda t: F.sequence(t, t + F.col("t_k") - 1)))))
    s = s.withColumn("cover", F.when(F.col("t_id").isNull(), 0.0).otherwise(covered / F.col("t_len")))
    full = F.col("is_base") & (F.col("cover") >= 1.0)
    kept = full | (~F.col("is_base") & (F.col("cover") >= min_coverage))
    out = s.groupBy(*doc).agg(
        F.count(F.when(full, 1)).alias("n_base"),
        F.min(F.when(full, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(full, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(full, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(kept, F.col("label")))), ",").alias("labels"),
        F.max("cover").alias("score"), F.count(F.when(kept, 1)).alias("n_spans"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
                      "base_labels", "labels", "score", "n_spans")
