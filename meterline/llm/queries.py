"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe, codebooks, decontam, filter_audit, jaccard, langid, licenses, mixing, pii, quality, secret_scan, urls, warc
from .textops import table


def op1_warc(spark, d):
    return warc.round_trip(table(spark, d, "pages"), scratch_path(spark, "warc"))


def op2_langid(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.fit(docs.filter(~out))
    found = langid.predict(docs, model)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op3_licenses(spark, d):
    return licenses.label_digests(table(spark, d, "documents"))


def op4_jaccard(spark, d):
    return jaccard.components(table(spark, d, "documents"))


def op5_pii(spark, d):
    return pii.scan_digests(table(spark, d, "documents"))


def op6_quality(spark, d):
    return quality.judge(table(spark, d, "documents"), table(spark, d, "labels"))


def op7_bpe(spark, d):
    return bpe.encode_digests(table(spark, d, "documents"))


def op8_secrets(spark, d):
    return secret_scan.scan_digests(table(spark, d, "documents"))


def op9_decontamination(spark, d):
    return decontam.overlaps(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op10_urls(spark, d):
    return urls.judge(table(spark, d, "pages"))


def op11_codebooks(spark, d):
    return codebooks.encode(table(spark, d, "embeddings"))


def op12_filter_audit(spark, d):
    return filter_audit.audit(table(spark, d, "documents"), table(spark, d, "labels"))


def op13_mixing(spark, d):
    return mixing.mix(table(spark, d, "documents"))


def queries():
    every = (
        op1_warc,
        op2_langid,
        op3_licenses,
        op4_jaccard,
        op5_pii,
        op6_quality,
        op7_bpe,
        op8_secrets,
        op9_decontamination,
        op10_urls,
        op11_codebooks,
        op12_filter_audit,
        op13_mixing,
    )
    return {f.__name__: f for f in every}
