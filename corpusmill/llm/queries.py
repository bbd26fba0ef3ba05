"""Registered queries of the training-data operators, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, fingerprint, lang_id, near_vectors, packing, pii, quality, shingle_join, token_counts, url_filter
from corpusmill.session import table

URL_RULES = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"), url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]
QUALITY_LEAST = 0.3


def op7_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.link(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.link(table(spark, sf_dir, "embeddings"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def fold(key: str, folds: int) -> Column:
    """The row's fold: CRC-32 of the key's decimal text, modulo ``folds``."""
    return F.crc32(F.encode(F.col(key).cast("string"), "utf-8")) % folds


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.attach(docs.select("doc_id", F.xxhash64("text").alias("text_hash")), pii.find(docs))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, (*pii.KINDS, pii.FOUND)), F.size("spans").cast("long").alias("n_spans"), F.sha2(text(F.filter("spans", lambda s: s["kind"] != pii.FOUND)), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pairs = fingerprint.compare_with_next(docs, fingerprint.lexicon(docs))
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        fingerprint.text_of(F.col("code")).alias("fingerprint"),
        fingerprint.text_of(F.col("edited_code")).alias("edited_fingerprint"),
        fingerprint.likeness(F.col("code"), F.col("edited_code")).alias("near_edited"),
        fingerprint.likeness(F.col("code"), F.col("next_code")).alias("near_next"),
    )


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """Fitted on labelled rows outside the held-out fold."""
    return quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir), keep=("doc_id", (fold("doc_id", 5) == 0).alias("held_out")))
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_LEAST).cast("int"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.attribute(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    model = lang_id.fit(docs.where(~held_out))
    return lang_id.predict(docs, model, keep=("doc_id", held_out.alias("held_out")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_pii": op3_pii,
    "op4_fingerprint": op4_fingerprint,
    "op5_quality": op5_quality,
    "op6_token_counts": op6_token_counts,
    "op7_shingle_join": op7_shingle_join,
    "op8_near_vectors": op8_near_vectors,
    "op9_url_filter": op9_url_filter,
    "op10_language_id": op10_language_id,
}
