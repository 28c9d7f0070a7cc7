"""Quality rules: label each pair with the first rule that it fails."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower.config import CleaningRules
from winnower.functions.garbled import GarbledRule, PairModel, fit_pair_model, is_garbled
from winnower.functions.text import (
    has_char_run,
    is_repetitive,
    normalise,
    text_field,
    text_length,
)

CORRUPT_COLUMN = "_corrupt_record"


def with_normalised(pairs: DataFrame) -> DataFrame:
    """Add ``q`` and ``r``: question and response, coerced and normalised."""
    return pairs.withColumns(
        {
            "q": normalise(text_field(pairs, "question")),
            "r": normalise(text_field(pairs, "response")),
        }
    )


def fails_empty(q: Column, r: Column) -> Column:
    return (q == "") | (r == "")


def fails_length(q: Column, r: Column, rules: CleaningRules) -> Column:
    q_fits = text_length(q).between(rules.min_question_chars, rules.max_question_chars)
    r_fits = text_length(r).between(rules.min_response_chars, rules.max_response_chars)
    return ~(q_fits & r_fits)


def fails_char_run(q: Column, r: Column, rules: CleaningRules) -> Column:
    return has_char_run(q, rules.drop_if_char_run_ge) | has_char_run(r, rules.drop_if_char_run_ge)


def fails_repetition(r: Column, rules: CleaningRules) -> Column:
    return is_repetitive(r, rules.drop_if_rep_ratio_ge, rules.rep_ratio_min_tokens)


@dataclass(frozen=True)
class GarbledCheck:
    """The garbled rule with its model of pairs, for the functions that take it as an extra rule."""

    rule: GarbledRule = GarbledRule()
    model: PairModel | None = None

    def fails(self, r: Column) -> Column:
        return is_garbled(r, self.rule, self.model)


def garbled_check(pairs: DataFrame, rule: GarbledRule = GarbledRule()) -> GarbledCheck:
    """The check with a model of the responses of these pairs, which costs a pass over them."""
    rows = with_normalised(pairs).select("r")
    return GarbledCheck(rule, fit_pair_model(rows, F.col("r")))


def drop_failing(rows: DataFrame, rule: str, fails: Column) -> DataFrame:
    """Drop the rows that fail one rule, observing how many those are.

    Without the observation in between, the optimizer would evaluate the
    normalised columns in the filter and once more above it.
    """
    return (
        rows.withColumn("_fails", fails)
        .observe(rule, F.count(F.lit(1)).alias("seen_rows"), F.count_if("_fails").alias("dropped"))
        .where(~F.col("_fails"))
        .drop("_fails")
    )


def cheap_reason(q: Column, r: Column, rules: CleaningRules, passed: Column) -> Column:
    """First failing rule of those that look at lengths only, else ``passed``."""
    return (
        F.when(fails_empty(q, r), "empty")
        .when(fails_length(q, r, rules), "length")
        .otherwise(passed)
    )


def costly_reason(q: Column, r: Column, rules: CleaningRules, passed: Column) -> Column:
    """First failing rule of those that search the whole text, else ``passed``."""
    return (
        F.when(fails_char_run(q, r, rules), "char_run")
        .when(fails_repetition(r, rules), "repetition")
        .otherwise(passed)
    )


def parsed_only(rows: DataFrame, reason: Column) -> Column:
    """``other`` for records that did not parse, else ``reason``."""
    if CORRUPT_COLUMN in rows.columns:
        return F.when(F.col(CORRUPT_COLUMN).isNotNull(), "other").otherwise(reason)
    return reason


def label_rows(
    pairs: DataFrame, rules: CleaningRules = CleaningRules(), garbled: GarbledCheck | None = None
) -> DataFrame:
    """Add ``q``, ``r`` and ``drop_reason``: the first failing rule, else ``valid``.

    A CASE stops at its first match, so the cheap rules save the costly ones
    work, and the length cap bounds the work on one row. The reason ``garbled``
    comes last, and only if that check is given.
    """
    rows = with_normalised(pairs)
    q, r = F.col("q"), F.col("r")
    passed = F.lit("valid")
    if garbled:
        passed = F.when(garbled.fails(r), "garbled").otherwise(passed)
    reason = cheap_reason(q, r, rules, costly_reason(q, r, rules, passed))
    return rows.withColumn("drop_reason", parsed_only(rows, reason))
