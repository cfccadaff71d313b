"""Target-distribution importance resampling with an Aho-Corasick dictionary of words.

Features of a text are its runs of 1 to ``grams`` words; a feature's bucket is the CRC-32 of its
bytes, modulo ``buckets``. A bucket's gain is the log ratio of its (smoothed) share in the target
texts to that in the documents. A document's score is the sum of its features' gains plus
Gumbel noise from a hash of its id; the highest scores are the draw (without replacement).

Dictionary: the distinct words of a group of texts (``GROUP`` bytes at most, or one text), each between two
delimiters, form an automaton. A word's payload is its number, which leads to its CRC and its length. One scan
over a text emits the payloads in order: matches are whole words only, as they
hold both delimiters. The CRC of a run follows from its words' CRCs and lengths (that of a concatenation is the
first one's moved by the second one's length, plus the second's), so no run is ever built as text.

Passes: counts (a task adds up its buckets, Spark adds up tasks), gains (``buckets`` numbers, to
the driver and back), scores, and ranks by a range partition of the scores with the sizes of
the ranges before added.

Defined cases: a null or empty text has no features, weight 0; a null doc_id is hashed as an empty id and
comes last among ties; very long texts are a group of their own; repeated rows are documents each (of rows equal in all
results either may be ranked first); an empty table gives no rows, an empty target gain 0 per unseen bucket's share;
other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

GRAMS, BUCKETS, MIN_WORDS, PERCENT, SEED = 1, 10000, 20, 10, 2024
GROUP = 1 << 22
# every byte that belongs to no word becomes the delimiter, A-Z become a-z
DELIMITER = b" "
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else DELIMITER[0] for c in range(256))
_POLY = np.uint32(0xEDB88320)   # of CRC-32, lowest power first


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials modulo the CRC's."""
    out, b = np.zeros(np.broadcast(a, b).shape, np.uint32), b.copy()
    for bit in range(31, -1, -1):
        out ^= np.where((a >> np.uint32(bit)) & np.uint32(1), b, np.uint32(0))
        b = (b >> np.uint32(1)) ^ np.where(b & np.uint32(1), _POLY, np.uint32(0))
    return out


def _moves(lengths: np.ndarray) -> np.ndarray:
    """What a CRC is multiplied by when so many bytes follow."""
    out = np.full(len(lengths), 1 << 31, np.uint32)         # 1
    power, left = np.full(1, 1 << 23, np.uint32), lengths.copy()      # x ** 8
    while left.any():
        out = np.where(left & 1, _times(out, power), out)
        power, left = _times(power, power), left >> 1
    return out


class Dictionary:
    """An automaton over the words of some texts (as bytes with delimiters around each word)."""

    def __init__(self, texts: list[bytes]):
        import ahocorasick

        words = sorted(set().union(*(t.split() for t in texts)))
        self.crc = np.array([zlib.crc32(w) for w in words], np.uint32)
        self.length = np.array([len(w) for w in words], np.int64)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS) if words else None
        for i, w in enumerate(words):
            self.automaton.add_word((DELIMITER + w + DELIMITER).decode("latin-1"), i)      # a character a byte
        if words:
            self.automaton.make_automaton()

    def payloads(self, text: bytes) -> np.ndarray:
        """Numbers of the text's words, in order."""
        if self.automaton is None:
            return np.empty(0, np.int64)
        return np.fromiter((i for _, i in self.automaton.iter(text.decode("latin-1"))), np.int64)

    def features(self, words: np.ndarray, grams: int) -> np.ndarray:
        """CRCs of all runs of 1 to ``grams`` of these words, joined by the delimiter."""
        out = [self.crc[words]]
        if grams > 1:
            move, space = _moves(self.length + 1), np.full(1, zlib.crc32(DELIMITER), np.uint32)
            later = _times(_moves(self.length), space) ^ self.crc           # of delimiter and word
            for n in range(2, min(grams, len(words)) + 1):
                last = words[n - 1:]
                out.append(_times(move[last], out[-1][:len(last)]) ^ later[last])
        return np.concatenate(out)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts (plain, between delimiters), a group at a time."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1)):
            text = DELIMITER + (t.as_py() or "").encode("utf-8", "surrogatepass").translate(_PLAIN) + DELIMITER
            if size and size + len(text) > GROUP:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(text)
            size += len(text)
    if ids:
        yield ids, texts


def counts(rows: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in _groups(batches):
            d = Dictionary(texts)
            for t in texts:
                total += np.bincount(d.features(d.payloads(t), grams) % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    text = rows.select(F.lit(None).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(of_documents: dict[int, int], of_target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * log ratio) per bucket."""
    s_all, t_all = sum(of_documents.values()) + buckets, sum(of_target.values()) + buckets
    return np.array([math.floor(1000 * math.log(float(of_target.get(b, 0) + 1) * s_all / (float(of_documents.get(b, 0) + 1) * t_all)))
                     for b in range(buckets)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, grams: int = GRAMS) -> DataFrame:
    """doc_id, n_words, n_features, weight per row of docs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _groups(batches):
            d, out = Dictionary(texts), []
            for t in texts:
                words = d.payloads(t)
                crc = d.features(words, grams)
                out.append((len(words), len(crc), int(gain[crc % np.uint32(len(gain))].sum())))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *[pa.array(c, pa.int64()) for c in zip(*out)]],
                                             ["doc_id", "n_words", "n_features", "weight"])

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def _ranked(rows: DataFrame, order: list) -> DataFrame:
    """rows with rank from 1: ranges of the order, each ranked on its own, plus the sizes of the ranges before."""
    dealt = written(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "importance-ranges")
    sizes = sorted((r["range"], r["n"]) for r in dealt.groupBy("range").agg(F.count("*").alias("n")).collect())
    before, ahead = [], 0
    for p, n in sizes:
        before += [F.lit(p), F.lit(ahead).cast("long")]
        ahead += n
    start = F.try_element_at(F.create_map(*before), F.col("range")) if before else F.lit(0).cast("long")
    return dealt.withColumn("rank", start + F.row_number().over(Window.partitionBy("range").orderBy(*order))).drop("range")


def resample(docs: DataFrame, target: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
             percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null where not drawn) per row of docs.

    Drawn: the floor of ``percent`` of the rows with at least ``min_words`` words, by score."""
    s, t = (dict(map(tuple, counts(x, grams, buckets).collect())) for x in (docs, target))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))
    scored = written(weights(docs, gains(s, t, buckets), grams).withColumn("score", F.col("weight") + noise), "importance-scores")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    ranked = _ranked(able, [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")])
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
