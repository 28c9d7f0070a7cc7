"""Projection of selected pairs to instruction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower.functions.text import literal_field, normalise

RECORD_COLUMNS = ["instruction", "input", "output", "system", "history", "source_id"]
_HISTORY_TYPE = "array<array<string>>"


def instruction_records(
    pairs: DataFrame, null_as: str = "None", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Instruction records of labelled pairs (with ``q`` and ``r`` normalised).

    NULL system prompts and ids become the text ``None`` unless ``null_as`` says
    otherwise. Columns named in ``keep`` stay in front of the record.
    """
    return pairs.select(
        *keep,
        F.col("q").alias("instruction"),
        F.lit("").alias("input"),
        F.col("r").alias("output"),
        normalise(literal_field(pairs, "system_prompt", null_as)).alias("system"),
        F.array().cast(_HISTORY_TYPE).alias("history"),
        literal_field(pairs, "id", null_as).alias("source_id"),
    )


def record_json() -> Column:
    """One record as a line of JSON; text beyond ASCII stays as it is."""
    return F.to_json(F.struct(*RECORD_COLUMNS))
