"""A training corpus from documents: toxicity filter, line dedup, near-duplicate removal, suffix dedup, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, ngram_join, packing, suffix_dedup, toxicity
from tidemark.llm.common import as_table, fresh_name, quoted
from tidemark.sources.scratch import clean_shuffles, delete, scratch_path, scratch_scope, stored_at


def _same_columns(docs: DataFrame, result: DataFrame) -> DataFrame:
    """``result`` with the columns of ``docs``; ``n_chars`` follows the text."""
    chars = F.length("text").cast(dict(docs.dtypes).get("n_chars", "bigint"))
    return result.select([chars.alias(c) if c == "n_chars" else F.col(quoted(c)) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; learned from the labels of documents that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit_toxicity(as_table(docs, doc_id="doc_id", text="text"), labels)
    score = fresh_name(docs, "score")
    kept = docs.withColumn(score, toxicity.toxicity_score(F.col("text"), model)).filter(F.col(score) < toxicity.THRESHOLD)
    return kept.drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts that move when the result is written are gone with its end, not beside the next stages' on disk."""
    clean_shuffles(spark)
    return _same_columns(docs, line_dedup.dedup_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity 0.8."""
    return ngram_join.one_of_each_group(docs)


def drop_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _same_columns(docs, suffix_dedup.without_repeats(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", drop_repeated_bytes),
    ("packing", pack),
]

#: The stages hash, search and learn in ways that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before it has written.

    What a stage stores for itself goes when its result is written, and a stage's result when the next one is.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            docs = stored_at(stage(spark, docs, sf_dir), path)
        if before is not None:
            delete(spark, before)
        before = path
    return docs
