"""A training corpus from raw documents: language, exact copies, near copies, repeated passages, packing.

Every stage but the last returns the columns of its input, extra ones too, and decides row by row: texts under the same
doc_id, or without one, are documents of their own, and rows that share doc_id and text stay or go together. An empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetrail.llm import language
from stagetrail.llm.common import own_exchange, stored, table, text_key
from stagetrail.llm.exact import exact_groups
from stagetrail.llm.packing import pack
from stagetrail.llm.paragraphs import duplicate_passages, remove_paragraphs
from stagetrail.llm.similar import similar_documents

#: Documents whose language is `und` or less certain than this are rejected.
LEAST_SCORE = 0.35
#: Near copies: shingles of five words, sets of them with at least this Jaccard similarity.
WORDS, SIMILARITY = 5, 0.8


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs but for the rows whose doc_id and text digest are in `dropped` (doc_id, mark); nulls are equal."""
    gone = dropped.select(own_exchange("doc_id").alias("_dropped"), F.col("mark").alias("_mark")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_dropped")) & text_key("text").eqNullSafe(F.col("_mark"))
    return docs.join(gone, same, "left_anti")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; null, empty and letterless texts go, everything else that is certain stays.

    lang, source and doc_id are not looked at; without labelled documents nothing can be identified and all go.
    """
    found = language.identify(docs, language.train(docs), "_language")
    return found.where((F.col("_language.lang_pred") != language.UNKNOWN) & (F.col("_language.score") >= LEAST_SCORE)).drop("_language")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id.

    Null and empty texts are equal; a row without a doc_id goes before one with it.
    """
    return _without(docs, exact_groups(docs).where("not kept").withColumn("mark", F.unhex("text_sha256")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts, the one with the smallest doc_id.

    Null and empty texts are equal; a row without a doc_id goes before one with it.
    """
    return _without(docs, similar_documents(docs, similarity=SIMILARITY, shingle=WORDS).where("not kept"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages kept elsewhere; one of which nothing is left goes.

    Null and empty texts stay; rows without a doc_id come after all others, so theirs are the passages that go.
    """
    return remove_paragraphs(docs, duplicate_passages(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document's tokens in sequences of fixed length; null and empty texts have their end token."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("substring_dedup", repeated_passages),
    ("packing", packed),
]

#: Language, fingerprints, paragraphs and packing are not expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
