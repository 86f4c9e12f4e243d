"""The queries of the training-data operators and their DuckDB counterparts."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.llm import chat_rotation, fingerprints, html_extraction, language_id, media_search, near_dedup, packing, secret_scans, sentencepieces, token_counts
from marquetry.llm.common import table


@cache
def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is; the operators themselves take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    probed = fingerprints.classed(fingerprints.neighbours(docs), docs)
    prints = (F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint"))
    return probed.select("doc_id", "n_chars", "edited_sha256", *prints, "near_edited", "near_next", "class_id")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extraction.extract(pages, html_extraction.fitted(pages))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), words=2)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.digests(table(spark, sf_dir, "documents"))


def op8_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_rotation.rotate(table(spark, sf_dir, "conversations"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op10_media_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_search.copies(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_html_extraction, op3_packing, op4_near_dedup, op5_sentencepiece, op6_language_id, op7_secret_scans, op8_chat_rotation, op9_token_counts, op10_media_search)}
ORACLES = {"op4_near_dedup": near_dedup.ORACLE, "op7_secret_scans": secret_scans.ORACLE, "op8_chat_rotation": chat_rotation.ORACLE}
