"""The training-data pipeline: stages over documents, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from winnower.llm.decontaminate import drop_contaminated
from winnower.llm.line_quality import clean_by_quality
from winnower.llm.mixing import sample_mix
from winnower.llm.simhash import drop_near_duplicates
from winnower.llm.token_files import token_file_round_trip
from winnower.llm.workers import package_on_workers
from winnower.storage import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their boilerplate lines."""
    return clean_by_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link at three bits or fewer, the smallest doc_id stays."""
    return drop_near_duplicates(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics have their target weights."""
    return sample_mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document in files, and per document what they hold."""
    return token_file_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("decontamination", decontamination),
    ("mixing", source_mix),
    ("token output", token_output),
]

#: SQL can express neither the tokenizer nor the links of near-duplicates.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the documents of a folder."""
    package_on_workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
