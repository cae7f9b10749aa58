"""Queries of the operators on text: each takes a session and the folder of the tables."""

import public_tokenizers
from curfew.llm import decontamination, embedding_dedup, html_text, line_dedup, mixing, near_duplicates, prefix_trie, quality, substring_dedup, token_alignment, token_output, toxicity, url_filter
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Shares of the words of the mix, by domain.
WEIGHTS = {"clean": 0.9, "poor": 0.06, "toxic": 0.04}


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), WEIGHTS)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.report(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(table(spark, sf_dir, "documents"))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.documents_report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.classified(table(spark, sf_dir, "pages"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.report(table(spark, sf_dir, "documents"), *sides)


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.report(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_output": op7_token_output,
    "op8_line_dedup": op8_line_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_html_extraction": op10_html_extraction,
    "op11_token_alignment": op11_token_alignment,
    "op12_embedding_dedup": op12_embedding_dedup,
    "op13_prefix_trie": op13_prefix_trie,
}
