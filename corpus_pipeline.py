"""From documents to token files: five stages, each on what the one before has kept.

Every stage's rows are written to the shared folder as Parquet and read again, so a lost
executor costs no more than the stage it worked on. All stages but the last return the
columns of ``documents``.
"""

import public_tokenizers
from curfew.llm import decontamination, mixing, near_duplicates, steps, token_output, toxicity
from pyspark.sql import DataFrame, SparkSession

#: Shares of the words of the mix, by domain. Clean prose gains by them, so none of it goes.
WEIGHTS = {"clean": 0.95, "poor": 0.05}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id stays."""
    return near_duplicates.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says."""
    return mixing.mixed(docs, mixing.quality_of_labels(table(spark, sf_dir, "labels")), WEIGHTS)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, listed as read back: doc_id, start, n_tokens, ids_crc32."""
    return token_output.documents_report(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_output", tokenised),
]

#: SQL cannot express the learned stages; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = steps.written(stage(spark, docs, sf_dir))
    return docs
