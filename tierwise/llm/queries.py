"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    importance, langid, license_scan, line_dedup, mixing, packing, pii, simhash, simplex_kmeans, spotsigs, sql, suffix_dedup, topk, warc,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {
    "op1_license_scan": sql.LICENSES,
    "op4_exact_top_k": sql.TOPK,
    "op8_warc": sql.WARC,
    "op11_centroid_clustering": sql.kmeans(),
    "op12_importance_resampling": sql.IMPORTANCE,
}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register
def op1_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@register
def op2_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file())


@register
def op9_mixing(spark, sf_dir):
    m = mixing.mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@register
def op10_simhash_near_dedup(spark, sf_dir):
    got = simhash.near_dedup(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op8_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("doc_id", F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "ambiguous")


@register
def op4_exact_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@register
def op7_document_fingerprints(spark, sf_dir):
    return spotsigs.pairs_with_next(table(spark, sf_dir, "documents"))


@register
def op5_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return line_dedup.dedup(docs, edits=None, min_chars=1).select("doc_id", "text", "n_lines", "n_lost", "n_near")


@register
def op3_pii_pseudonyms(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register
def op11_centroid_clustering(spark, sf_dir):
    return simplex_kmeans.report(table(spark, sf_dir, "embeddings"))


@register
def op12_importance_resampling(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op13_suffix_dedup(spark, sf_dir):
    got = suffix_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return got.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
