"""The registered queries of this package, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    cover_tree,
    line_dedup,
    merkle_manifest,
    ngram_join,
    packing,
    projection_forest,
    source_divergence,
    source_mixing,
    suffix_dedup,
    toxicity,
    url_templates,
    warc_revisits,
    word_automaton,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs)
    return kept.select(
        "doc_id", F.col("lines_removed").cast("bigint").alias("lines_removed"), F.md5("text").alias("kept_md5")
    )


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = spark.sql(warc_revisits.RECORDS_SQL, pages=table(spark, sf_dir, "pages"))
    return warc_revisits.resolve_revisits(records).select(
        "record_id",
        "canonical_url",
        "base_id",
        "outcome",
        "status",
        "digest",
        warc_revisits.headers_text(F.col("headers")).alias("headers"),
    )


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.shingle_groups(table(spark, sf_dir, "documents"), words=3, threshold=90)
    return groups.withColumnRenamed("id", "doc_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.score_documents(table(spark, sf_dir, "documents"), labels)


def op5_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    found = projection_forest.nearest_neighbours(rows, rows.filter("vec_id % 20 = 0"))
    return found.select("query_id", "rank", "vec_id", "score")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    judged = url_templates.judge_urls(url_templates.labelled_pages(pages, labels), url_templates.RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 9).alias("purity"))


def op9_word_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return word_automaton.encode_decode(table(spark, sf_dir, "documents"), tokenizer)


def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = cover_tree.cosine_groups(table(spark, sf_dir, "embeddings"))
    return groups.withColumnRenamed("id", "vec_id")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit_sources(table(spark, sf_dir, "documents"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.taken_words(source_mixing.mix_sources(table(spark, sf_dir, "documents")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.merkle_manifest(table(spark, sf_dir, "documents")).drop("copies")


def queries() -> dict[str, Query]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_warc_revisits": op2_warc_revisits,
        "op3_ngram_join": op3_ngram_join,
        "op4_toxicity": op4_toxicity,
        "op5_projection_forest": op5_projection_forest,
        "op6_packing": op6_packing,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_url_templates": op8_url_templates,
        "op9_word_automaton": op9_word_automaton,
        "op10_cover_tree": op10_cover_tree,
        "op11_source_divergence": op11_source_divergence,
        "op12_source_mixing": op12_source_mixing,
        "op13_merkle_manifest": op13_merkle_manifest,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": line_dedup.ORACLE_SQL,
        "op2_warc_revisits": warc_revisits.ORACLE_SQL,
        "op8_url_templates": url_templates.ORACLE_SQL,
        "op11_source_divergence": source_divergence.ORACLE_SQL,
        "op12_source_mixing": source_mixing.ORACLE_SQL,
        "op13_merkle_manifest": merkle_manifest.ORACLE_SQL,
    }
