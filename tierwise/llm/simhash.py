"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: a bit is 1 if more than half of the hashes of a text's word
shingles have it. Equal fingerprints are one class, so copies meet no pairs.

Index: the 64 bits are cut into segments, more of them than bits may differ, so
two linked fingerprints agree on some choice of segments. Each choice is one
index over fingerprints whose chosen segments lead; some first bits of these,
as many as leave about ``MEMBERS`` fingerprints together, name its upper node,
which is the unit that Spark deals out. Inside a node the fingerprints are
sorted by Gray rank, which brings those with few differing bits together;
leaves of ``LEAF`` neighbours and their parents (``FAN`` each) keep the bits
that all members share (mask and pattern). A search goes down pairs of nodes
from the root and counts the differences of their shared bits: beyond the limit
the whole pair of groups is dropped; members of pairs of leaves that are left
are compared.

A node with more than ``NODE`` fingerprints is cut into chunks, and every pair
of chunks is a task's unit, so no task holds an unbounded node. From a unit only
a spanning forest of its links leaves, not all pairs; the components of these
are those of all links.

The numbers of segments and leading bits follow from the number of fingerprints
alone and only set the cost: any choice finds all links.

Defined cases: a null text has no words, fingerprint zero; texts of fewer words
than a shingle are one shingle; repeated rows give repeated results; a null
doc_id takes part but names no component (one of null ids only has a null name,
and still keeps a row of its own); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .graph import components, local_components

WORDS = 4
SEED = 42
MAX_BITS = 4
LEAF, FAN = 2, 4
MEMBERS = 256               # fingerprints of a node on average, if the chosen segments have bits enough
NODE = 1024                 # fingerprints of a chunk of a node
PAIRS = 65536               # pairs of leaves compared at once


def fingerprint(text: str | None, words: int = WORDS) -> int:
    import xxhash

    w = (text or "").encode("utf-8").lower().split()        # bytes: ASCII letters and ASCII white space only
    if not w:
        return 0
    h = xxhash.xxh64_intdigest
    n = max(1, len(w) - words + 1)
    count = np.zeros(64, np.int64)
    for lo in range(0, n, 8192):
        part = [h(b" ".join(w[i:i + words]), SEED) for i in range(lo, min(lo + 8192, n))]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def _text_hashes(text: Column) -> list[Column]:
    """Two hashes that tell texts apart; null isn't the empty text."""
    known = F.coalesce(text, F.lit("")), text.isNull()
    return [F.xxhash64(*known).alias("h1"), F.xxhash64(F.lit(SEED), *known).alias("h2")]


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), h1 and h2 (of the text) per row of docs."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), words) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), b.column(2), b.column(3)],
                                             ["doc_id", "fp", "h1", "h2"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), *_text_hashes(text)).mapInArrow(
        rows, "doc_id long, fp long, h1 long, h2 long")


# ------------------------------------------------------------------ the index

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each value in the reflected Gray order."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


def _levels(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mask, pattern) of the nodes of each level, leaves first. x: in Gray order."""
    mask, pattern, fan, levels = np.full(len(x), ~np.uint64(0)), x, LEAF, []
    while not levels or len(mask) > 1:
        first = np.arange(0, len(pattern), fan)
        same = np.bitwise_and.reduceat(mask, first)
        both = np.bitwise_and.reduceat(pattern, first) ^ np.bitwise_or.reduceat(pattern, first)
        mask = same & ~both
        pattern = pattern[first] & mask
        levels.append((mask, pattern))
        fan = FAN
    return levels


def near_leaves(levels: list[tuple[np.ndarray, np.ndarray]], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of leaves that a search from the root of levels doesn't drop."""
    a = b = np.zeros(1, np.int64)
    child = np.arange(FAN)
    for depth in range(len(levels) - 1, -1, -1):
        mask, pattern = levels[depth]
        if depth < len(levels) - 1:                         # children of the pairs that are left
            shape = (len(a), FAN, FAN)
            a = np.broadcast_to((a[:, None] * FAN + child)[:, :, None], shape).reshape(-1)
            b = np.broadcast_to((b[:, None] * FAN + child)[:, None, :], shape).reshape(-1)
            there = (a <= b) & (b < len(mask))
            a, b = a[there], b[there]
        apart = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b])
        a, b = a[apart <= max_bits], b[apart <= max_bits]
    return a, b


def forest(x: np.ndarray, max_bits: int) -> np.ndarray:
    """For each of the distinct fingerprints x, the smallest index of its component within x."""
    order = np.argsort(gray_rank(x), kind="stable")
    g = x[order]
    a, b = near_leaves(_levels(g), max_bits)
    root = np.arange(len(g))
    at = np.arange(LEAF)
    for lo in range(0, len(a), PAIRS):
        shape = (len(a[lo:lo + PAIRS]), LEAF, LEAF)
        i = np.broadcast_to((a[lo:lo + PAIRS, None] * LEAF + at)[:, :, None], shape).reshape(-1)
        j = np.broadcast_to((b[lo:lo + PAIRS, None] * LEAF + at)[:, None, :], shape).reshape(-1)
        there = (i < j) & (j < len(g))
        i, j = i[there], j[there]
        near = np.bitwise_count(g[i] ^ g[j]) <= max_bits
        if near.any():
            root = local_components(len(g), np.concatenate([np.arange(len(g)), i[near]]),
                                    np.concatenate([root, j[near]]))
    # back to the order of x, with the smallest index of x as root
    comp = np.empty(len(x), np.int64)
    comp[order] = root
    smallest = np.full(len(x), len(x))
    np.minimum.at(smallest, comp, np.arange(len(x)))
    return smallest[comp]


def _unit_links(max_bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """batches: (unit, fp) with the rows of a unit together. Units of a single leaf are compared together
    by shifting; others go through the index."""
    kept_unit, kept_fp = np.empty(0, np.int64), np.empty(0, np.uint64)

    def links(unit: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]]) if len(unit) else np.empty(0, np.int64)
        size = np.diff(np.r_[first, len(unit)])
        out_u, out_v = [], []
        small = np.repeat(size <= LEAF, size)
        u, x = unit[small], fp[small]
        a, b = [], []
        for d in range(1, int(size[size <= LEAF].max(initial=1))):
            i = np.flatnonzero((u[:-d] == u[d:]) & (np.bitwise_count(x[:-d] ^ x[d:]) <= max_bits))
            a.append(i)
            b.append(i + d)
        if a:
            root = local_components(len(x), np.concatenate(a), np.concatenate(b))
            i = np.flatnonzero(root != np.arange(len(x)))
            out_u.append(x[i])
            out_v.append(x[root[i]])
        for f, n in zip(first[size > LEAF], size[size > LEAF]):
            x = fp[f:f + n]
            root = forest(x, max_bits)
            i = np.flatnonzero(root != np.arange(n))
            out_u.append(x[i])
            out_v.append(x[root[i]])
        cols = [np.concatenate(o).view(np.int64) if o else np.empty(0, np.int64) for o in (out_u, out_v)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["u", "v"])

    for batch in batches:
        unit = np.concatenate([kept_unit, batch.column(0).to_numpy()])
        fp = np.concatenate([kept_fp, batch.column(1).to_numpy().view(np.uint64)])
        if not len(unit):
            continue
        other = np.flatnonzero(unit != unit[-1])
        cut = int(other[-1]) + 1 if len(other) else 0       # the last unit may go on in the next batch
        kept_unit, kept_fp = unit[cut:], fp[cut:]
        yield links(unit[:cut], fp[:cut])
    yield links(kept_unit, kept_fp)


def leading_bits(n: int, segments: int, max_bits: int = MAX_BITS) -> int:
    """How many first bits of each chosen segment name a node."""
    chosen = segments - max_bits
    wanted = max(0, n // MEMBERS).bit_length()
    return min(64 // segments, -(-wanted // chosen))


def segment_count(n: int, max_bits: int = MAX_BITS) -> int:
    """The number of segments with the least work for n fingerprints: rows dealt out, and comparisons."""
    def work(s: int) -> float:
        bits = leading_bits(n, s, max_bits) * (s - max_bits)
        return comb(s, max_bits) * n * (1 + n / 2 ** bits / 500)

    return min(range(max_bits + 1, max_bits + 6), key=work)


def _leading(fp: Column, choice: tuple[int, ...], segments: int, bits: int) -> Column:
    """The first bits of the chosen segments."""
    ends = [64 * (i + 1) // segments for i in choice]
    mask = sum(((1 << bits) - 1) << (end - bits) for end in ends)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, segments: int | None = None, node: int = NODE) -> DataFrame:
    """distinct: fp. Links (u, v) whose components are those of all pairs at most max_bits apart."""
    n = distinct.count()
    s = segments or segment_count(n, max_bits)
    bits = leading_bits(n, s, max_bits)
    choices = list(combinations(range(s), s - max_bits))
    upper = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), _leading(F.col("fp"), c, s, bits).alias("lead")) for i, c in enumerate(choices)])).alias("n"))
    upper = upper.select("fp", F.xxhash64("n.t", "n.lead").alias("node"))
    large = upper.groupBy("node").agg(F.count("*").alias("size")).where(F.col("size") > node)
    chunks = F.ceil(F.col("size") / F.lit(node)).cast("int")
    upper = upper.join(large.select("node", chunks.alias("chunks")), "node", "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1),
                       lambda c: F.xxhash64("node", F.least(c, mine), F.greatest(c, mine)))
    units = upper.select("fp", F.explode(F.when(F.col("chunks").isNull(), F.array("node")).otherwise(pair)).alias("unit"))
    units = units.repartition("unit").sortWithinPartitions("unit").select("unit", "fp")
    return units.mapInArrow(lambda b: _unit_links(max_bits, b), "u long, v long")


def _rooted(fps: DataFrame, max_bits: int) -> DataFrame:
    """of_fp, root (names its component) and component_id per fingerprint."""
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = components(links(classes.select("fp"), max_bits), "simhash-links")
    c = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = c.groupBy("root").agg(F.min("least").alias("component_id"))
    return written(c.join(named, "root").select(F.col("fp").alias("of_fp"), "root", "component_id"), "simhash-components")


def near_dedup(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that links reach) per row of docs."""
    fps = written(fingerprints(docs, words), "simhash-fps")
    return fps.join(_rooted(fps, max_bits), F.col("fp") == F.col("of_fp")).select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of docs for each component: the one with its smallest doc_id, null last (of rows that
    repeat it, the least text).

    The row is found by doc_id and text, not by doc_id alone: an id may stand in several components,
    and a component may have null ids only. Texts are ranked only where several rows remain."""
    fps = written(fingerprints(docs, words), "simhash-fps")
    heads = fps.join(_rooted(fps, max_bits), F.col("fp") == F.col("of_fp")).where(
        F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = heads.groupBy("root", "doc_id", "h1", "h2").agg(F.count("*").alias("n"))
    several = kept.groupBy("root").agg(F.sum("n").alias("n_rows"))
    kept = written(kept.join(several, "root").select(
        "root", "n_rows", F.col("doc_id").alias("k_id"), F.col("h1").alias("k_h1"), F.col("h2").alias("k_h2")), "simhash-kept")
    d = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("k_id0"),
                    *_text_hashes(docs["text"].cast("string")))
    d = d.join(kept, (F.col("h1") == F.col("k_h1")) & (F.col("h2") == F.col("k_h2")) & F.col("k_id0").eqNullSafe(F.col("k_id")))
    ranked = F.struct(F.col("row.text").isNotNull(), F.col("row.text"))
    first = d.where("n_rows > 1").groupBy("root").agg(F.min_by("row", ranked).alias("row"))
    return d.where("n_rows = 1").select("row").unionByName(first.select("row")).select("row.*")
