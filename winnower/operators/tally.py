"""Drop counts and cleaning statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower import fixed_values as fixed
from winnower.config import CleaningRules

_DROPPED = ["empty", "length", "char_run", "repetition", "other"]


def decision_counts() -> list[Column]:
    """Counters over ``decision``; they need no shuffle when observed."""
    names = {"selected": "selected_rows", "not_sampled": "not_sampled_rows"}
    names |= {reason: f"dropped_{reason}" for reason in _DROPPED}
    return [
        F.expr("count(*) as seen_rows"),
        *[F.expr(f"count_if(decision = '{value}') as {name}") for value, name in names.items()],
    ]


def drop_waterfall(labelled: DataFrame) -> DataFrame:
    """Number of rows per ``drop_reason``; partial counts precede the shuffle."""
    return labelled.groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def stats_counts(decided: DataFrame, dedup: bool) -> DataFrame:
    """One row with all counters of a run, from the output of ``decide_rows``.

    Without a copy of the texts: the rows that deduplication keeps are as many
    as there are distinct keys among the selected ones.
    """
    counts = decision_counts()
    if dedup:
        selected_key = F.when(F.col("decision") == "selected", F.col("key"))
        counts.append(F.count_distinct(selected_key).alias("kept_rows"))
        return decided.agg(*counts).withColumn(
            "dropped_dedup", F.col("selected_rows") - F.col("kept_rows")
        )
    return decided.agg(*counts).withColumns(
        {"kept_rows": F.col("selected_rows"), "dropped_dedup": F.lit(0).cast("bigint")}
    )


def stats_report(
    counts: DataFrame,
    rules: CleaningRules = CleaningRules(),
    source_rows: int = fixed.SOURCE_ROWS,
    source_revision: str = fixed.SOURCE_REVISION,
) -> DataFrame:
    """One nested row ``(cleaning_config, stats)`` from a row of counters."""
    config = F.struct(*[F.lit(value).alias(name) for name, value in rules.as_dict().items()])
    stats = F.struct(
        F.lit(source_rows).cast("bigint").alias("source_rows_requested"),
        F.lit(source_revision).alias("source_revision"),
        "seen_rows",
        "kept_rows",
        "selected_rows",
        "not_sampled_rows",
        "dropped_empty",
        "dropped_length",
        "dropped_char_run",
        "dropped_repetition",
        "dropped_dedup",
        "dropped_other",
    )
    return counts.select(config.alias("cleaning_config"), stats.alias("stats"))
