"""Language ID by error-correcting output codes.

Each language has a codeword of bits; for each bit a binary classifier on
character n-grams says on which side a text is. A text's language is the one
whose codeword loses least against the classifiers' margins, each bit weighted
by how reliable it proved for that language. A wrong bit or two still leaves the
right codeword nearest; texts about as near to a second one are ambiguous.

Features: the share of each hashed 1-, 2- and 3-gram of lowered letters, other
characters as a space, square-rooted and scaled to length 1. Whole texts are
counted.

Fitting uses a bounded sample: about ``per_language`` labelled rows of a language,
``max_rows`` in all (twice that is a hard limit), drawn by a hash of doc_id. Features are counted in
the tasks; the driver gets that many vectors of ``DIM`` numbers at most and
fits all bits at once. Prediction is one pass over the table without a shuffle.

Defined cases: a null text and one without letters are ``und`` with score 0; a
null label teaches nothing; with no labelled row every text is ``und``; a single
language is predicted for every text with letters; repeated rows give repeated
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc32_text

DIM = 8192
BITS = 15
PER_LANGUAGE = 300
MAX_ROWS = 2000
STEPS = 80
AMBIGUOUS = 0.02            # of the best codeword's loss
UNKNOWN = "und"
ROWS = 64
PREDICTED = "lang_pred string, score double, ambiguous boolean"

_letter: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _letter
    if _letter is None:
        _letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letter


def features(text: str | None) -> np.ndarray | None:
    """A text's vector; None if it has no letters."""
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[c]
    if not letter.any():
        return None
    c = np.concatenate([[32], np.where(letter, c, 32), [32]]).astype(np.uint32)
    seen = np.zeros(DIM)
    gram = np.zeros(len(c), np.uint32)
    for n in (1, 2, 3):
        gram = gram[:len(c) - n + 1] * np.uint32(0x9E3779B1) + c[n - 1:]
        has = gram[c[n // 2:len(c) - n + 1 + n // 2] != 32] if n != 2 else gram[(c[:-1] != 32) | (c[1:] != 32)]
        mixed = (has ^ np.uint32(n)) * np.uint32(0x85EBCA6B)
        seen += np.bincount(mixed >> np.uint32(32 - 13), minlength=DIM)
    return np.sqrt(seen / seen.sum()).astype(np.float32)


def codewords(n: int, bits: int = BITS, seed: int = 6) -> np.ndarray:
    """n codewords of +1 and -1: of many random tables that with the largest least distance; every
    bit has languages on both sides."""
    if n == 1:
        return np.ones((1, 1), np.float32)
    bits = max(bits, 4 * int(np.ceil(np.log2(n))))
    rng, best, widest = np.random.default_rng(seed), None, -1
    for _ in range(300):
        m = rng.choice(np.array([-1.0, 1.0]), (n, bits))
        flat = np.abs(m.sum(0)) == n
        m[0, flat] *= -1
        apart = (bits - m @ m.T) / 2
        least = apart[~np.eye(n, dtype=bool)].min()
        if least > widest:
            best, widest = m, least
    return best.astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray           # language x bit
    weights: np.ndarray         # DIM x bit
    bias: np.ndarray
    trust: np.ndarray           # language x bit, rows add up to 1

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language, score, ambiguous) per row of x."""
        margin = x @ self.weights + self.bias
        loss = np.stack([(np.logaddexp(0, -margin * c) * t).sum(1) for c, t in zip(self.codes, self.trust)], 1)
        best = loss.argmin(1)
        least = loss[np.arange(len(x)), best]
        sharp = np.exp((least[:, None] - loss) * 4)
        score = 1 / sharp.sum(1)
        second = np.partition(loss, 1, 1)[:, 1] if loss.shape[1] > 1 else np.full(len(x), np.inf)
        return best, score, second - least < AMBIGUOUS * np.maximum(least, 1e-9)


def fit(x: np.ndarray, labels: list[str], steps: int = STEPS) -> Model:
    """All bits' logistic regressions at once, by gradient steps with momentum."""
    languages = sorted(set(labels))
    of = np.array([languages.index(v) for v in labels])
    codes = codewords(len(languages))
    y = codes[of]
    share = (1 / np.bincount(of))[of][:, None].astype(np.float32) / len(languages)     # languages weigh alike
    w = np.zeros((x.shape[1], codes.shape[1]), np.float32)
    b = np.zeros(codes.shape[1], np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        pull = share * y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30)))
        vw = 0.9 * vw + x.T @ pull - 1e-5 * w
        vb = 0.9 * vb + pull.sum(0)
        w += 8 * vw
        b += 8 * vb
    right = (np.sign(x @ w + b) == y).astype(np.float32)
    trust = np.stack([right[of == i].mean(0) for i in range(len(languages))]) + 1e-3
    return Model(languages, codes, w, b, trust / trust.sum(1, keepdims=True))


def held_out(doc_id: Column) -> Column:
    return F.pmod(crc32_text(doc_id), F.lit(4)) == 2


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, max_rows: int = MAX_ROWS) -> DataFrame:
    """About per_language labelled rows of each language (text, lang), 2 * max_rows at the very most; never
    held-out ones."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    # a null doc_id has no remainder: it may teach
    rows = rows.where(F.col("lang").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    counts = [(r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(max_rows).collect()]
    if not counts:
        return rows.select("text", "lang").limit(0)
    most = max(1, min(per_language, max_rows // len(counts)))
    rate = F.element_at(F.create_map(*[F.lit(v) for lang, n in counts for v in (lang, min(1.0, most / n))]),
                        F.col("lang"))
    draw = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.where(draw < F.coalesce(rate, F.lit(0.0)))
    return drawn.select("text", "lang").limit(most * len(counts) * 2)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, max_rows: int = MAX_ROWS) -> Model | None:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(v.tobytes(), lang) for t, lang in zip(*(c.to_pylist() for c in b.columns))
                     if (v := features(t)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()),
                                              pa.array([f[1] for f in found], pa.string())], ["x", "lang"])

    got = sorted((r["lang"], bytes(r["x"])) for r in
                 sample(docs, per_language, max_rows).mapInArrow(rows, "x binary, lang string").collect())
    if not got:
        return None
    return fit(np.stack([np.frombuffer(x, np.float32) for _, x in got]), [lang for lang, _ in got])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs with lang_pred, score and ambiguous added."""
    from pyspark.sql import types as T

    added = [f.split()[0] for f in PREDICTED.split(", ")]
    kept = [c for c in docs.columns if c not in added]
    schema = T.StructType([docs.schema[c] for c in kept] + list(T._parse_datatype_string(PREDICTED).fields))
    text = kept.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score, unsure = [], [], []
            for lo in range(0, batch.num_rows, ROWS):
                found = [features(t.as_py()) if model else None for t in batch.column(text).slice(lo, ROWS)]
                there = [i for i, v in enumerate(found) if v is not None]
                p, s, u = [UNKNOWN] * len(found), [0.0] * len(found), [False] * len(found)
                if there:
                    for i, best, sc, am in zip(there, *model.decode(np.stack([found[i] for i in there]))):
                        p[i], s[i], u[i] = model.languages[best], float(sc), bool(am)
                pred += p
                score += s
                unsure += u
            cols = [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, kept + added)

    return docs.select(*[docs[c] for c in kept]).mapInArrow(rows, schema)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of docs (doc_id, text, lang, …) with lang_pred, score and ambiguous."""
    return predict(docs, train(docs, per_language, max_rows))
