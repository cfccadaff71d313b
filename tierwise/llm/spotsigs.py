"""Document fingerprints by SpotSigs.

A spot signature is a common word (the anchor) with the chain of ``CHAIN``
content words that follow it. The set of a text's signatures is its fingerprint:
common words are spread over prose and rare in navigation and lists, so the set
follows the prose. Likeness is the Jaccard measure of two sets. Sets whose
lengths are too far apart can't be alike: ``length_class`` cuts the lengths so
that only sets of the same or neighbouring classes need a comparison, and
``likeness`` stops as soon as what is left can't reach the wanted value.

``pairs_with_next`` compares every text with an edited form of it and with the
next document. Documents are dealt out by ranges of doc_id (approximate
percentiles, at most ``RANGES`` of them), sorted within, and the first document
of a range is copied to the range before it: each text moves once, and a task
holds one Arrow batch and two texts.

``near_classes`` compares all documents: equal sets are one; a set is sent to its
length class and the one below under each signature of its prefix (the smallest
ones, as many as two alike sets can't both miss); a key of more than ``CELL``
sets becomes a unit per pair of its chunks, and a unit gives a spanning forest of
its pairs at the threshold. The components are the classes.

Defined cases: a null text is empty; a text without anchors takes every word as
one; a chain at the end of a text may be shorter; a text without words has no
signatures, and two such sets are alike (1); rows that repeat a doc_id follow
each other by text, null doc_ids come first; the last document's next is the
first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .graph import components, local_components

CHAIN = 2
THRESHOLD = 0.5             # of near_classes
CELL = 256                  # sets of a chunk of a hot key
SHOWN = 16                  # smallest signatures that the digest shows
RANGE_ROWS, RANGES = 250, 50_000      # several ranges a task, so that tasks are alike
# Common words of four languages, the anchors.
ANCHORS = frozenset("""
the of and to a in is that it for was on with as by be this are at from or an have not which but
der die und in den von zu das mit sich des auf für nicht ist im dem ein eine als auch es an war
de la le et les des en un du que une pour est dans qui pas par sur au avec ce il se
el y los las del con por no su para es al lo una como más
""".split())
_WORD = re.compile(r"[^\W_]+")


def signatures(text: str | None, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> set[int]:
    """The spot signatures of a whole text, as 48-bit hashes."""
    words = _WORD.findall((text or "").lower())
    content, marks = [], []
    for w in words:
        if w in anchors:
            marks.append((w, len(content)))
        else:
            content.append(w)
    h = xxhash.xxh64_intdigest
    found = {h(" ".join((w, *content[i:i + chain]))) >> 16 for w, i in marks if i < len(content)}
    if not found:
        found = {h(" ".join(words[i:i + chain + 1])) >> 16 for i in range(len(words))}
    return found


def length_class(n: int, threshold: float) -> int:
    """Class of a set length: lengths two classes apart are under the threshold's ratio."""
    return int(math.log(max(n, 1)) / -math.log(threshold)) if n else -1


def likeness(a: set[int], b: set[int], threshold: float = 0.0) -> float:
    """Jaccard of two sets; 0 if it can't reach the threshold."""
    if len(a) > len(b):
        a, b = b, a
    if not b:
        return 1.0
    if len(a) < threshold * len(b):
        return 0.0
    if not threshold:
        common = len(a & b)
    else:
        may_miss = len(a) - math.ceil(threshold / (1 + threshold) * (len(a) + len(b)) - 1e-9)
        common = 0
        for s in a:
            if s in b:
                common += 1
            else:
                may_miss -= 1
                if may_miss < 0:
                    return 0.0
    return common / (len(a) + len(b) - common)


def digest(found: set[int]) -> str:
    """Set length, smallest signatures and a hash of the whole set, in hex: equal for equal sets only."""
    least = sorted(found)[:SHOWN] if len(found) <= 256 else np.partition(
        np.fromiter(found, np.int64, len(found)), SHOWN)[:SHOWN]
    whole = xxhash.xxh3_128_hexdigest(np.sort(np.fromiter(found, "<i8", len(found))).tobytes())
    return f"{len(found):x}-" + "".join(f"{int(s):012x}" for s in sorted(least)) + f"-{whole}"


def edited(text: str, following: str) -> str:
    """text with its last quarter replaced by as many code points of the start of following."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _dealt(docs: DataFrame) -> DataFrame:
    """doc_id, text, range_no, copied: every document in its range, and the first of each range once
    more, as copied, in the range before (of the first: in the last)."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = d.count()
    ranges = max(1, min(RANGES, n // RANGE_ROWS))
    bounds: list[int] = []
    if ranges > 1:
        bounds = sorted(set(d.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges)
                                  .alias("p")).first()["p"] or []))

    @F.pandas_udf("long")
    def range_no(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        out = np.zeros(len(ids), np.int64)
        out[known] = np.searchsorted(np.array(bounds, np.int64), ids[known].astype("int64").to_numpy(), "right")
        return pd.Series(out)

    least = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")      # a null comes first
    heads = sorted((r["range_no"], r["head"]["doc_id"]) for r in
                   d.select("doc_id", range_no("doc_id").alias("range_no")).groupBy("range_no")
                   .agg(F.min(least).alias("head")).collect())                  # a row per range
    before = {no: heads[i - 1][0] for i, (no, _) in enumerate(heads)}
    first = dict(heads)

    @F.pandas_udf("array<long>")
    def places(ids: pd.Series) -> pd.Series:
        out = []
        for v in ids.astype(object):
            v = None if pd.isna(v) else int(v)
            no = 0 if v is None else bisect_right(bounds, v)
            out.append([no, before[no]] if first[no] == v else [no])
        return pd.Series(out)

    d = d.select("doc_id", "text", F.posexplode(places("doc_id")).alias("copied", "range_no"))
    return d.repartition("range_no").sortWithinPartitions("range_no", "copied", F.col("doc_id").asc_nulls_first(), "text")


def pairs_with_next(docs: DataFrame, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Per row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, n_signatures."""
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double, n_signatures long")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None                                         # (range_no, doc_id, text, signatures)
        for batch in batches:
            out = []
            for doc_id, text, copied, no in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(),
                                                batch.column(3).to_pylist()):
                text = text.as_py()
                found = signatures(text, anchors, chain)
                if held is not None and held[0] == no:
                    changed = edited(held[2], text)
                    other = signatures(changed, anchors, chain) if changed != held[2] else held[3]
                    out.append((held[1], len(held[2]), hashlib.sha256(changed.encode()).hexdigest(), digest(held[3]),
                                digest(other), likeness(held[3], other), likeness(held[3], found), len(held[3])))
                # of repeated heads only the first is the next of what came before
                held = None if copied else (no, doc_id.as_py(), text, found)
            cols = zip(*out) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    return _dealt(docs).select("doc_id", "text", "copied", "range_no").mapInArrow(rows, schema)


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, anchors: frozenset[str] = ANCHORS,
                 chain: int = CHAIN) -> DataFrame:
    """Per row of docs: doc_id and class_id, the smallest doc_id that links of likeness >= threshold reach
    (null if all of them are null)."""
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.sort(np.fromiter(s, np.int64, len(s))) for s in
                     (signatures(t.as_py(), anchors, chain) for t in batch.column(1))]
            h = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h), pa.array(found, pa.list_(pa.int64()))],
                                             ["doc_id", "h", "sigs"])

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, members = None, []

        def links() -> pa.RecordBatch:
            a, b = [], []
            for i, (_, upper, x) in enumerate(members):
                for j in range(i):
                    # sets of the upper class meet each other in their own
                    if not (upper and members[j][1]) and likeness(x, members[j][2], threshold) >= threshold:
                        a.append(i)
                        b.append(j)
            root = local_components(len(members), np.array(a, np.int64), np.array(b, np.int64))
            at = np.flatnonzero(root != np.arange(len(members)))
            return pa.RecordBatch.from_arrays([pa.array([members[i][0] for i in at], pa.int64()),
                                               pa.array([members[root[i]][0] for i in at], pa.int64())], ["u", "v"])

        for batch in batches:
            for u, h, upper, sigs in zip(*(c.to_pylist() for c in batch.columns)):
                if u != unit:
                    yield links()
                    unit, members = u, []
                members.append((h, upper, set(sigs)))
        yield links()

    text = F.col("text").cast("string")
    found = written(docs.select(F.col("doc_id").cast("long"), text).mapInArrow(
        sets_of, "doc_id long, h long, sigs array<long>"), "spots-sets")
    least = found.groupBy("h").agg(F.min("doc_id").alias("least"))
    sets = written(found.groupBy("h").agg(F.first("sigs").alias("sigs")), "spots-distinct")
    n = F.size("sigs")
    prefix = F.slice("sigs", F.lit(1), (n - F.ceil(n * F.lit(threshold) - F.lit(1e-9)) + 1).cast("int"))
    # a little wider, so that no rounding puts alike sets two classes apart
    width = -math.log(threshold) * (1 + 1e-9) + 1e-12
    of = F.floor(F.log(n.cast("double")) / F.lit(width))
    keys = sets.where(n > 0).select("h", of.alias("of"), F.explode(prefix).alias("sig"))
    keys = keys.select("h", F.explode(F.array(F.struct(F.lit(False).alias("upper"), F.col("of").alias("of")),
                                              F.struct(F.lit(True).alias("upper"), (F.col("of") - 1).alias("of")))).alias("k"), "sig")
    keys = written(keys.select("h", "k.upper", F.xxhash64("k.of", "sig").alias("key")), "spots-keys")
    size = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("upper").alias("only_upper")).where("size > 1 and not only_upper")
    keys = keys.join(size, "key")
    chunks = F.ceil(F.col("size") / F.lit(CELL)).cast("int")
    mine = F.pmod(F.xxhash64("h"), chunks).cast("int")
    pair = F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.xxhash64("key", F.least(c, mine), F.greatest(c, mine)))
    units = keys.select("h", "upper", F.explode(F.when(F.col("size") > CELL, pair).otherwise(F.array("key"))).alias("unit"))
    units = units.join(sets, "h").select("unit", "h", "upper", "sigs").repartition("unit").sortWithinPartitions("unit")
    roots = components(units.mapInArrow(forest, "u long, v long"), "spots-links")
    c = least.join(roots, F.col("h") == F.col("node"), "left").select("h", "least", F.coalesce("root", "h").alias("root"))
    named = c.groupBy("root").agg(F.min("least").alias("class_id"))
    of = c.join(named, "root").select("h", "class_id")
    return found.select("doc_id", "h").join(of, "h").select("doc_id", "class_id")
