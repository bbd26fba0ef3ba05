"""The corpus pipeline: quality, language, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; its result is written as Parquet and read
again as the next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import lang_id, packing, pii, quality, shingle_join
from corpusmill.llm.queries import QUALITY_LEAST, fold, quality_model
from corpusmill.session import drop_materialised, free_heaps, materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Least share of a text's n-grams (one to four characters) that its language must have, without what the filters give by
#: chance. On sf0.01 the documents have 0.68 and more, random letters 0.32, sentences in unlearned languages of the same
#: script up to 0.51, those in other scripts 0.
KNOWN_LEAST = 0.55


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold stay."""
    return quality.score(docs, quality_model(spark, sf_dir), keep=COLUMNS).where(F.col("score") >= QUALITY_LEAST).select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found stay, whatever their label says; without letters, or with less than
    ``KNOWN_LEAST`` of their n-grams in any one known language, they go."""
    model = lang_id.fit(docs.where(fold("doc_id", 4) != 2))
    return lang_id.predict(docs, model, keep=COLUMNS, known=True).where((F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("known") >= KNOWN_LEAST)).select(*COLUMNS)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8) stays: that of the smallest id. A document is an id
    with a text: rows that have both in common are one, those with an id in common only if their texts link. Rows without
    an id are told apart by their text, and stay only where no linked document has an id."""
    mark = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    docs = docs.withColumn("mark", mark)
    joined = shingle_join.link(docs, key="mark", k=5, num=80, den=100).select("mark", "component_id").distinct()
    ranked = joined.join(docs.select("mark", "doc_id").distinct(), "mark").withColumn("rank", F.struct(F.col("doc_id").isNull(), "doc_id", "mark"))
    kept = ranked.groupBy("component_id").agg(F.min("rank").getField("mark").alias("mark")).select("mark")
    return docs.join(kept, "mark", "left_semi").groupBy("mark").agg(F.min(F.struct(*COLUMNS)).alias("row")).select(*(F.col(f"row.{c}").alias(c) for c in COLUMNS))


def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in it is replaced by its kind in angle brackets."""
    # under a name of its own first: an alias named text would be read inside the same projection
    clean = pii.attach(docs.select(*COLUMNS), pii.find(docs)).withColumn("clean", pii.redact(F.col("text"), F.col("spans")))
    return clean.select("doc_id", F.col("clean").alias("text"), "lang", "source", F.when(F.size("spans") == 0, F.col("n_chars")).otherwise(F.length("clean").cast("long")).alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids (little-endian unsigned 32-bit)."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def _fresh(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, begun on heaps that no earlier stage has filled."""

    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        free_heaps(spark)
        return stage(spark, docs, sf_dir)

    return begin


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", _fresh(quality_stage)),
    ("language", _fresh(language_stage)),
    ("near_duplicates", _fresh(duplicate_stage)),
    ("personal_data", _fresh(private_stage)),
    ("packing", _fresh(packing_stage)),
]

#: Trained models, bootstrapped patterns and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last is not None:
            drop_materialised(last)  # no later stage reads it
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
