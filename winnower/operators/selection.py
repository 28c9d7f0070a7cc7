"""Seeded selection of valid pairs by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from winnower.config import CleaningRules, Sampling
from winnower.functions.hashing import content_key, is_sampled, score_hex
from winnower.operators.cleaning import (
    CORRUPT_COLUMN,
    cheap_reason,
    costly_reason,
    label_rows,
    parsed_only,
    with_normalised,
)
from winnower.operators.tally import decision_counts


def decide_rows(
    pairs: DataFrame,
    rules: CleaningRules = CleaningRules(),
    sampling: Sampling = Sampling(),
    count_all: bool = True,
) -> DataFrame:
    """Add ``q``, ``r``, ``key`` and ``decision`` to each pair.

    ``decision`` is the first failing rule, ``not_sampled`` or ``selected``. The
    key is hashed once per row and is NULL where no sampling took place. Equal
    content gets an equal key and so the same decision, whatever the order,
    the partitioning or a retry.

    Without ``count_all`` the sampling comes before the costly rules. The same
    rows are selected for less work, but rows that are not sampled count as
    that even if such a rule would have dropped them.
    """
    q, r, reason = F.col("q"), F.col("r"), F.col("drop_reason")
    if count_all:
        rows = label_rows(pairs, rules)
        verdict = F.lit("selected")
    else:
        rows = with_normalised(pairs)
        cheap = cheap_reason(q, r, rules, F.lit("valid"))
        rows = rows.withColumn("drop_reason", parsed_only(rows, cheap))
        verdict = costly_reason(q, r, rules, F.lit("selected"))
    sampled = is_sampled(score_hex(F.col("key"), sampling.seed), sampling.probability)
    return (
        rows.withColumn("key", F.when(reason == "valid", content_key(q, r)))
        .withColumn(
            "decision",
            F.when(reason != "valid", reason).when(~sampled, "not_sampled").otherwise(verdict),
        )
        .drop("drop_reason", "question", "response")
    )


def select_rows(
    pairs: DataFrame,
    rules: CleaningRules = CleaningRules(),
    sampling: Sampling = Sampling(),
    observation: Observation | str = "selection",
    count_all: bool = True,
) -> DataFrame:
    """Pairs that pass all rules and are sampled, with ``q``, ``r`` and ``key``.

    The counters are observed between labelling and filtering. This gives the
    drop counts for free, and it keeps the optimizer from pushing the filter
    below the labels, which would evaluate every regex twice per row.
    """
    decided = decide_rows(pairs, rules, sampling, count_all)
    return (
        decided.observe(observation, *decision_counts())
        .where(F.col("decision") == "selected")
        .drop("decision", CORRUPT_COLUMN)
    )
