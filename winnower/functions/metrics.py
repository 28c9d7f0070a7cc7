"""Metric lookup in evaluation result JSON, one file per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower import fixed_values as fixed

# JSON types that count as a number; true and false do, text never does.
_NUMERIC_VARIANT = r"^(BIGINT|DOUBLE|BOOLEAN|DECIMAL\(.*)$"
_METRICS_TYPE = "map<string,variant>"
# Numbers that a variant does not hold: not finite, or beyond a double.
_BARE_NUMBER = r"\s*:\s*-?(?:NaN|Infinity|[0-9][0-9.eE+-]*)\s*[,}]"


def quoted(text: str) -> str:
    """Text as a literal of SQL; one expression text costs one call to the JVM."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _preference_map(preferences: dict[str, list[str]]) -> Column:
    entries = [
        f"{quoted(task)}, array({', '.join(map(quoted, metrics))})"
        for task, metrics in preferences.items()
    ]
    return F.expr(f"map({', '.join(entries)})")


def _last_value(entries: Column, key: Column) -> Column:
    """Value of a key; of repeated keys the last one counts, as JSON readers do."""
    same_key = F.filter(F.map_entries(entries), lambda entry: entry["key"] == key)
    return F.try_element_at(same_key, F.lit(-1))["value"]


def best_metric(
    metrics: Column,
    task: Column,
    preferences: dict[str, list[str]] = fixed.PREFERRED_METRICS,
    text: Column | None = None,
    source: Column | None = None,
) -> Column:
    """Best of a map of metrics in file order, with ``metric`` and ``score``.

    The first preferred name with a numeric value wins, else the first numeric
    value in file order; NULL if there is none. Works on the row alone: nothing
    is exploded, so any number of files needs no shuffle.

    ``text`` is the JSON text of the metrics, from which NaN, infinities and
    overflowing numbers are read, which a variant cannot hold; ``source`` is the
    text of the whole file, which tells them from quoted ones.
    """
    written = None if text is None else F.from_json(text, "map<string,string>")
    names = F.try_element_at(_preference_map(preferences), task)

    def candidate(name: Column, position: Column) -> Column:
        value = _last_value(metrics, name)
        preferred = F.nullif(F.array_position(names, name), F.lit(0))
        numeric = F.schema_of_variant(value).rlike(_NUMERIC_VARIANT)
        score = F.when(numeric, F.try_variant_get(value, "$", "double"))
        if written is not None:
            bare = F.concat(F.lit('"\\Q'), name, F.lit('\\E"' + _BARE_NUMBER))
            other = F.when(F.rlike(source, bare), _last_value(written, name).try_cast("double"))
            score = F.coalesce(score, other)
        return F.struct(
            preferred.isNull().alias("fallback"),
            F.coalesce(preferred, position.cast("bigint")).alias("rank"),
            name.alias("metric"),
            score.alias("score"),
        )

    candidates = F.transform(F.array_distinct(F.map_keys(metrics)), candidate)
    return F.array_min(F.filter(candidates, lambda found: found["score"].isNotNull()))


def with_best_metric(
    results: DataFrame, preferences: dict[str, list[str]] = fixed.PREFERRED_METRICS
) -> DataFrame:
    """Add ``best``, the best metric of each result file, to ``task, value``.

    ``results`` in the file maps tasks to metric objects, or is a metric object
    itself; the latter is used if the task is missing or empty. Inside a variant
    keys come back sorted, so the task is cut out as JSON text and only then
    typed. One column per step keeps each from being parsed again.
    """
    task, value = F.col("task"), F.col("value")
    by_task = F.from_json(value, "results map<string,string>")["results"]
    block = _last_value(F.col("_by_task"), task)
    whole = F.from_json(value, "results string")["results"]
    in_block = F.size(F.from_json("_block", "map<string,string>")) > 0
    return (
        results.withColumn("_by_task", by_task)
        .withColumn("_block", block)
        .withColumn(
            "_text",
            F.when(in_block, F.col("_block")).when(F.col("_by_task").isNotNull(), whole),
        )
        .withColumn("_metrics", F.from_json("_text", _METRICS_TYPE))
        .withColumn("best", best_metric(F.col("_metrics"), task, preferences, F.col("_text"), value))
        .drop("_by_task", "_block", "_text", "_metrics")
    )


def is_corrupt(value: Column) -> Column:
    """Whether a result file does not parse as JSON, in which NaN and infinities may stand."""
    unread = F.from_json(value, "map<string,string>").isNull()
    return unread & F.try_parse_json(value).isNull() & value.isNotNull()


#: Doubles from here on times 10,000 are beyond the whole numbers that a double holds.
_EXACT_BELOW = 2.0**38
_SPLIT = 2.0**27 + 1


def _ten_thousandths(score: Column) -> Column:
    """A score of at least 0 in ten-thousandths, rounded half to even on its exact binary value.

    The product with 10,000 is rounded by the machine; splitting the score into
    halves of few bits gives the error of that rounding exactly, which decides
    where the product lies on a half.
    """
    scale = F.lit(10_000.0)  # few bits, so its products with either half are exact
    product = score * scale
    high = F.lit(_SPLIT) * score
    high = high - (high - score)
    error = (high * scale - product) + (score - high) * scale
    whole = F.floor(product)
    half = (product - whole) - F.lit(0.5)
    up = (half > 0) | ((half == 0) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    return F.when(up, whole + 1).otherwise(whole)


def score_text(score: Column) -> Column:
    """Score with four decimals, halves to even on the exact value; NULL becomes ``""``.

    The sign is set apart to survive in ``-0.0000``. Scores too large for an exact
    product are formatted from their decimal text.
    """
    sign = F.when(score < 0, "-").otherwise("")
    size = F.abs(score)
    exact = size < F.lit(_EXACT_BELOW)
    units = _ten_thousandths(F.when(exact, size).otherwise(0.0))
    digits = F.format_string("%s%d.%04d", sign, F.floor(units / 10_000), units % 10_000)
    large = F.format_string("%s%.4f", sign, F.bround(size, 4))
    return F.when(score.isNull(), "").when(exact, digits).otherwise(large)
