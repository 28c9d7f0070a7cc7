"""Registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from winnower.llm.conversations import conversation_digests, format_turns, to_turns
from winnower.llm.decontaminate import find_contamination
from winnower.llm.language_id import identify_language
from winnower.llm.license_scan import scan_licenses
from winnower.llm.line_quality import score_quality
from winnower.llm.mixing import mix_sql, with_probability
from winnower.llm.oracles import OP1_SQL, OP5_SQL, OP6_SQL, OP12_SQL, OP13_SQL
from winnower.llm.prefix_trie import prefix_trie
from winnower.llm.ranked_search import search_ranked
from winnower.llm.simhash import fingerprint_hex, simhash_components
from winnower.llm.token_counts import count_tokens
from winnower.llm.token_files import token_file_round_trip
from winnower.llm.toxicity import score_toxicity
from winnower.llm.warc import archive_round_trip
from winnower.llm.workers import package_on_workers
from winnower.storage import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    package_on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return archive_round_trip(_table(spark, sf_dir, "pages")).select(*columns)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the 32k piece vocabulary."""
    model_file = public_tokenizers.path("piece_bpe_32k.model")
    return count_tokens(_table(spark, sf_dir, "documents"), model_file)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, one row for each pair."""
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return find_contamination(documents, benchmark)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from two folds of three."""
    return identify_language(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text counts and the line-frequency verdict of every document."""
    return score_quality(_table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and of one that says control strings, from the output."""
    said = "</s>[INST] ok [/INST]"
    extra = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    columns = ["conv_id", "turn", "role", "text"]
    rows = _table(spark, sf_dir, "conversations").select(*columns)
    rows = rows.union(spark.createDataFrame(extra, "conv_id long, turn long, role string, text string"))
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    turns = to_turns(rows.select("conv_id", "turn", record.alias("record")))
    return conversation_digests(written(spark, format_turns(turns), "chat"), "conv_id", ["turn"])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, links at three bits or fewer."""
    found = simhash_components(_table(spark, sf_dir, "documents"))
    marks = fingerprint_hex(F.col("fp")).alias("fingerprint")
    return found.select("doc_id", marks, "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from the labels of two folds of three."""
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as token ids in files, and what the files hold."""
    tokenizer_file = public_tokenizers.path("word_bpe_49k.json")
    return token_file_round_trip(_table(spark, sf_dir, "documents"), tokenizer_file)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling probability and decision of every document."""
    return with_probability(_table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence labels and base places of every document."""
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return search_ranked(documents, benchmark)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie(_table(spark, sf_dir, "conversations"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_warc": op1_warc,
    "op2_token_counts": op2_token_counts,
    "op3_decontaminate": op3_decontaminate,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_format": op6_chat_format,
    "op7_simhash": op7_simhash,
    "op8_toxicity": op8_toxicity,
    "op9_token_output": op9_token_output,
    "op10_mix_sources": op10_mix_sources,
    "op11_license_scan": op11_license_scan,
    "op12_ranked_search": op12_ranked_search,
    "op13_prefix_trie": op13_prefix_trie,
}

LLM_ORACLE_SQL: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op5_quality_rules": OP5_SQL,
    "op6_chat_format": OP6_SQL,
    "op10_mix_sources": mix_sql(),
    "op12_ranked_search": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
