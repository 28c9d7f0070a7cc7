"""Nulls, empty and long texts, ties, repeats, empty tables and clashing names for each operator."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from winnower.llm.conversations import conversation_digests, format_turns, to_turns
from winnower.llm.decontaminate import drop_contaminated, find_contamination
from winnower.llm.language_id import identify_language
from winnower.llm.line_quality import clean_by_quality, score_quality
from winnower.llm.mixing import sample_mix, with_probability
from winnower.llm.simhash import drop_near_duplicates, simhash_components
from winnower.llm.token_counts import count_tokens
from winnower.llm.token_files import token_file_round_trip
from winnower.llm.toxicity import score_toxicity
from winnower.llm.warc import archive_round_trip

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "long words of a very long text, line by line.\n" * 20_000
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (None, "a text of no id", "en", "a", 1),
    (None, "a text of no id", "en", "a", 1),
    (3, "the same words in two rows " * 12, "en", "a", 2),
    (3, "the same words in two rows " * 12, "en", "a", 2),
    (4, LONG, "en", "b", 3),
    (5, " \t\n", "de", None, 4),
    (6, "word", None, "b", 5),
    (7, "eine zeile mit wörtern für die probe", "de", "b", 6),
]
#: Names that operators use for columns of their own.
CLASHING = ["_id", "_host", "_lost", "_text", "_p", "_sampled", "_tokens", "fp", "root", "_h", "c_0"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, DOCS)
    return rows.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


@pytest.fixture(scope="module")
def tables(spark, docs):
    items = [(1, "the same words in two rows the same words in two rows"), (2, None), (3, ""), (None, "x")]
    labels = [(3, 1, 1), (4, 1, 0), (4, 0, None), (None, 1, 1), (7, 1, 0), (3, 0, 1)]
    return {
        "docs": docs,
        "items": spark.createDataFrame(items, "item_id long, text string"),
        "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    }


PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PER_ROW = {
    "tokens": lambda t: count_tokens(t["docs"], PIECES),
    "language": lambda t: identify_language(t["docs"]),
    "quality": lambda t: score_quality(t["docs"]),
    "simhash": lambda t: simhash_components(t["docs"]),
    "toxicity": lambda t: score_toxicity(t["docs"], t["labels"]),
    "token files": lambda t: token_file_round_trip(t["docs"], WORDS),
    "mixing": lambda t: with_probability(t["docs"]),
}
FILTERS = {
    "quality": lambda t: clean_by_quality(t["docs"]),
    "simhash": lambda t: drop_near_duplicates(t["docs"]),
    "contamination": lambda t: drop_contaminated(t["docs"], t["items"]),
    "mixing": lambda t: sample_mix(t["docs"]),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_row(tables, name):
    found = PER_ROW[name](tables).collect()
    assert sorted(str(row["doc_id"]) for row in found) == sorted(str(row[0]) for row in ROWS)
    twins = [tuple(v for k, v in r.asDict().items() if k != "start") for r in found if r["doc_id"] == 3]
    assert twins[0] == twins[1]


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_tables_give_no_rows(tables, name):
    empty = {key: table.limit(0) for key, table in tables.items()}
    assert PER_ROW[name](empty).collect() == []


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_the_columns(tables, name):
    kept = FILTERS[name](tables)
    assert kept.columns == tables["docs"].columns
    assert {str(r["doc_id"]) for r in kept.collect()} <= {str(row[0]) for row in ROWS}
    empty = {key: table.limit(0) for key, table in tables.items()}
    assert FILTERS[name](empty).collect() == []


def test_without_labels_or_languages_nothing_is_learnt(tables):
    bare = tables["docs"].withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in identify_language(bare).collect()} == {"und"}
    scores = score_toxicity(tables["docs"], tables["labels"].limit(0)).collect()
    assert all(0 <= r["score"] <= 1 and not r["predicted"] for r in scores)


def test_an_empty_benchmark_leaves_all_documents(tables):
    none = tables["items"].limit(0)
    assert find_contamination(tables["docs"], none).count() == 0
    assert drop_contaminated(tables["docs"], none).count() == len(ROWS)


def test_contamination_of_repeated_rows(tables):
    found = find_contamination(tables["docs"], tables["items"]).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(3, 1), (3, 1)]
    kept = drop_contaminated(tables["docs"], tables["items"]).collect()
    assert len(kept) == len(ROWS) - 2


def test_near_duplicates_keep_one_row_of_repeats(tables):
    kept = drop_near_duplicates(tables["docs"]).collect()
    # The null, empty and blank texts share fingerprint zero.
    assert sorted(str(r["doc_id"]) for r in kept) == ["1", "3", "4", "6", "7", "None"]


def test_pages(spark):
    rows = [(1, "http://a/", "x"), (2, None, "x"), (2, None, "x"), (None, "http://c/", "x")]
    rows += [(None, None, None), (4, "http://d/ü x", ""), (5, "http://e/", "y" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumn("payload", F.lit("own")).withColumn("_head", F.lit("own"))
    read = archive_round_trip(pages).collect()
    found = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in read)
    assert found == [
        ("1", 1, "revisit", 2),
        ("2", 1, "response", None),
        ("2", 1, "response", None),
        ("4", 0, "response", None),
        ("5", 3_000_000, "response", None),
        ("None", 0, "revisit", 4),
        ("None", 1, "revisit", 2),
    ]
    assert {r["url"] for r in read} == {row[1] for row in rows}
    assert archive_round_trip(pages.limit(0)).count() == 0
    all_responses = archive_round_trip(pages, least_revisit_bytes=2).collect()
    assert {r["record_type"] for r in all_responses} == {"response"}


def test_conversations(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a\\<|end|>|>b"), (1, 0, "user", "a\\<|end|>|>b")]
    rows += [(None, 1, "assistant", "[INST] x </s>"), (2, 1, "assistant", ""), (3, 1, "a|>b", "c")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    records = turns.select("conv_id", "turn", F.lit("own").alias("at"), record.alias("record"))
    formatted = format_turns(to_turns(records))
    found = {r["conv_id"]: r for r in conversation_digests(formatted, "conv_id", ["turn"]).collect()}
    assert {k: (r["n_turns"], r["loss_chars"]) for k, r in found.items()} == {
        1: (3, 0),
        None: (1, 13),
        2: (1, 0),
        3: (1, 0),
    }
    assert to_turns(records.limit(0)).count() == 0
