"""The registered queries of the subpackage, and their SQL twins where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import byte_bpe, conversation_trie, graph_ann, language_id, license_scan, mixing, ngram_join, nra_topk, packing, pu_quality, secret_scan, suffix_dedup, whitening
from millrace.session import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_ann.nearest(table(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pu_quality.score_documents(docs, pu_quality.fit(docs, table(spark, sf_dir, "labels")))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra_topk.top_products(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(byte_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path()))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations")).drop("turn_id")


QUERIES = {f.__name__: f for f in (op1_suffix_array_dedup, op2_secret_scans, op3_license_scans, op4_language_id, op5_nearest_neighbours, op6_packing, op7_ngram_join, op8_quality_classifier, op9_exact_top_k, op10_mixing, op11_whitening, op12_bpe, op13_conversation_trie)}
ORACLES = {"op3_license_scans": license_scan.scan_sql(), "op9_exact_top_k": nra_topk.top_products_sql(), "op13_conversation_trie": conversation_trie.trie_sql()}
