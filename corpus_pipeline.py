"""A corpus pipeline of four stages: language, near duplicates, secrets, packing.

Each stage works on all that its predecessor kept, is written as Parquet to the shared folder and
read again, so a lost executor never takes a finished stage with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquetry.llm import language_id, near_dedup, packing, secret_scans
from marquetry.llm.common import shuffle_partitions, stored, table
from marquetry.llm.registry import vocabulary
from marquetry.plans.session import reachable


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, no letter) go; the others' lang is the predicted one, or as it was where no language could be learned."""
    reachable(spark)
    model = language_id.train(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language_id.predict(docs, model, "_lang_pred", "_lang_score").filter(F.col("_lang_pred") != language_id.NONE)
    return found.withColumn("lang", F.col("_lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the least doc_id stays; of rows with one doc_id, the least text hash, and one of equal rows."""
    reachable(spark)
    repeated = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    if not repeated.isEmpty():
        return _least_rows(spark, docs)
    gone = near_dedup.near_groups(docs).filter(~F.col("kept")).select("doc_id").distinct()
    few = stored(gone)
    sent = F.broadcast(few) if few.count() <= near_dedup.SENT_IDS else few
    return docs.join(sent, "doc_id", "left_anti").select(*docs.columns)


def _least_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """near_duplicates with rows numbered in order of doc_id and text hash, as a doc_id does not tell them apart."""
    order = ["doc_id", F.xxhash64("text")]
    dealt = docs.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    rows = stored(dealt.withColumn("_row", F.monotonically_increasing_id())).withColumn("_row", F.expr("if(doc_id is null, null, _row)"))
    gone = near_dedup.near_groups(rows.select(F.col("_row").alias("doc_id"), "text")).filter(~F.col("kept")).select(F.col("doc_id").alias("_row"))
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reported secrets are masked; every document stays."""
    reachable(spark)
    return secret_scans.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept texts as pieces of full sequences."""
    reachable(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", pack)]
#: SQL cannot express a learned model or a tokenizer; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the whole pipeline over the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
