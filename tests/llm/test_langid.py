"""Language ID: held-out accuracy, codewords, odd rows."""

import zlib

import numpy as np
import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F
from tierwise.llm import langid
from tierwise.llm.common import table


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 40])
def test_codewords_keep_their_distance(n):
    m = langid.codewords(n)
    assert m.shape[0] == n and set(np.unique(m)) <= {-1.0, 1.0}
    if n > 1:
        apart = (m.shape[1] - m @ m.T) / 2
        assert apart[~np.eye(n, dtype=bool)].min() >= 3
        assert (np.abs(m.sum(0)) < n).all()


def test_a_wrong_bit_is_corrected():
    codes = langid.codewords(4)
    model = langid.Model(list("abcd"), codes, np.eye(codes.shape[1], dtype=np.float32), np.zeros(codes.shape[1], np.float32),
                         np.full(codes.shape, 1 / codes.shape[1], np.float32))
    for i, c in enumerate(codes):
        for bit in range(len(c)):
            x = 3 * c.copy()
            x[bit] *= -1
            assert model.decode(x[None])[0][0] == i
    half = ((codes[0] + codes[1]) / 2)[None]
    assert model.decode(half)[2][0]                          # as near to one as to the other


def test_held_out_accuracy_on_whole_texts(spark):
    docs = table(spark, SF_CHECK, "documents")
    got = langid.identify(docs).where(langid.held_out(F.col("doc_id"))).select("doc_id", "lang", "lang_pred", "score").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.97


def test_held_out_labels_teach_nothing(spark):
    docs = table(spark, SF_CHECK, "documents").limit(300)
    lied = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = langid.train(docs), langid.train(lied)
    assert a.languages == b.languages and np.allclose(a.weights, b.weights)


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog are here", "en", "s"), (3, "le chat et les chiens sont ici", "fr", "s"), (3, None, "fr", "s"),
            (4, "123 !?", "en", None), (None, "the dog and the cat", None, None), (9, "", "en", "s"),
            (10, "the cats and dogs " * 20000, "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr(
        "*", "'x' AS lang_pred", "0 AS score", "1 AS label")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "lang", "source", "label", "lang_pred", "score", "ambiguous"}
    by = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in got}
    for key in [(3, None), (4, "123 !?"), (9, "")]:
        assert by[key] == ("und", 0.0)
    assert by[(10, rows[-1][1])][0] == "en" and by[(None, "the dog and the cat")][0] in ("en", "fr")
    assert langid.identify(docs.limit(0)).count() == 0
    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    single = langid.identify(docs.withColumn("lang", F.lit("en"))).collect()
    assert {r.lang_pred for r in single if r.text and r.text[0].isalpha()} == {"en"}
