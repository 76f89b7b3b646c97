"""A corpus pipeline of five of the operators: rules, near copies, benchmark passages, mixing, token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import frames, ledger, mixing, tiling, token_groups
from shelfcast.llm.common import stored
from shelfcast.llm.queries import vocabulary

#: Shares of the tokens by domain after the rules, which leave hardly any document of low quality.
TARGETS = {"high": 0.998, "toxic": 0.002}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return ledger.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of documents that share 80 % of their five-word shingles."""
    return token_groups.keep_one(docs, k=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold half of a benchmark item or more."""
    return tiling.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture asks for."""
    return mixing.mixed(docs, mixing.label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet")), TARGETS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, written and read back."""
    return frames.token_files(docs, vocabulary())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("mixing sources to target weights", mix_domains),
    ("token-ID output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "pipeline")
    return docs


#: Class ids, fitted models and tokenizers are not SQL; tests hold the stages against plain versions.
ORACLE_SQL = None
