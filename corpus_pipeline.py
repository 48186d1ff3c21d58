"""The corpus pipeline: five stages from the table documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and read again as the next one's docs.
All but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language_id, mixing, ngram_join, packing, secret_scan
from millrace.llm.queries import tokenizer_path
from millrace.session import ARROW_ROWS_CONF, settle, table, wide_rows

#: Least score of a document whose language counts as known; texts without letters score 0.
LEAST_LANGUAGE_SCORE = 0.35


def few_texts_a_batch(spark: SparkSession) -> None:
    """From now on the session hands texts to Python in small batches; stages are run by who writes them, so this lasts."""
    spark.conf.set(ARROW_ROWS_CONF, wide_rows(spark))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the byte network recognises; it learns from their own labels.

    Null texts, texts without letters and texts of no clear language go. Without any label nothing can be recognised, and all stay.
    """
    few_texts_a_batch(spark)
    net = language_id.fit(docs)
    if net is None:
        return docs
    return docs.where(language_id.prediction(net, F.col("text")).getField("score") >= LEAST_LANGUAGE_SCORE)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Rows that repeat both id and text count once. Texts without words form no group. A row with a null id stays only if none of its
    group has an id, and then one of them does; rows that share an id are told apart by their texts.
    """
    row_key = F.xxhash64("doc_id", "text").alias("row_key")
    groups = ngram_join.similar_documents(docs.select(row_key.alias("doc_id"), "text"))
    placed = settle(groups.select(F.col("doc_id").alias("row_key"), "component_id").distinct(), "placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("first")
    named = docs.select("doc_id", row_key).distinct().join(placed, "row_key")
    kept = settle(named.groupBy("component_id").agg(first).select("first.row_key"), "kept")
    single = docs.select(F.struct(*docs.columns).alias("whole_row"), "doc_id", row_key).dropDuplicates(["row_key", "doc_id"])
    return single.join(kept, "row_key", "left_semi").select("whole_row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; n_chars follows the text."""
    few_texts_a_batch(spark)
    text = secret_scan.redact_column(F.col("text"))
    columns = [F.col(c) if c != "text" else text.alias("text") for c in docs.columns]
    redacted = docs.select(*columns)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else redacted


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: sources interleaved to their target weights, over evenly cut ranges."""
    whole = docs.select("source", F.struct(*docs.columns).alias("document"))
    ordered = mixing.mix(whole).repartitionByRange("position").sortWithinPartitions("position")
    return ordered.select("document.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens, document by document as they come."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", without_secrets),
    ("mixing sources", mixed_sources),
    ("packing", packed),
]

#: A trained network decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
