"""Pairs from JSON Lines, tolerant of records that do not parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnower.functions.metrics import quoted
from winnower.operators.cleaning import CORRUPT_COLUMN
from winnower.sources.numbered_lines import read_numbered_lines

TEXT_FIELDS = ("question", "response")
LITERAL_FIELDS = ("system_prompt", "id")
_NUMBER = r"^(BIGINT|DOUBLE|DECIMAL\(.*)$"


def _typed(name: str) -> tuple[Column, Column, Column]:
    """Type of a field, its value as written in the record, and that value as a number."""
    kind = F.schema_of_variant(F.try_variant_get("_record", f"$.{name}", "variant"))
    written = F.expr(f"_written[{quoted(name)}]")
    return kind, written, F.try_variant_get("_record", f"$.{name}", "double")


def _text(name: str) -> Column:
    """Text of a field; absent, null, 0, false and empty values are the empty text."""
    kind, written, number = _typed(name)
    return (
        F.when(kind == "BOOLEAN", F.when(written == "true", "True").otherwise(""))
        .when(kind.rlike(_NUMBER), F.when(number == 0, "").otherwise(written))
        .when(written.isin("[]", "{}") & (kind != "STRING"), "")
        .otherwise(F.coalesce(written, F.lit("")))
        .alias(name)
    )


def _literal(name: str) -> Column:
    """Text of a field, NULL where it is null, and the empty text where it is absent."""
    kind, written, _ = _typed(name)
    return (
        F.when(kind.isNull(), "")
        .when(kind == "BOOLEAN", F.initcap(written))
        .otherwise(written)
        .alias(name)
    )


def read_json_pairs(
    spark: SparkSession, path: str | list[str], order_field: str | None = "seq bigint"
) -> DataFrame:
    """Pairs of JSON Lines files, plus the raw text of records that are broken.

    The order comes from a field of the record, declared in ``order_field``; with
    None it is the number of the line in stored order, ``seq``, which costs a pass
    that counts lines. Each line is parsed once into a variant, which tells an
    absent field from a null one and 0 from "0". Records that do not parse, are no
    objects or have no order value stay in the result and are labelled ``other``
    later on.
    """
    if order_field is None:
        order, position = "seq", F.col("seq")
        lines = read_numbered_lines(spark, path)
    else:
        order, kind = order_field.split()
        position = F.expr(f"_written[{quoted(order)}]").try_cast(kind)
        lines = spark.read.text(path)
    lines = lines.withColumns(
        {
            "_record": F.try_parse_json("value"),
            "_written": F.from_json("value", "map<string,string>"),
        }
    )
    whole = F.schema_of_variant("_record").startswith("OBJECT") & position.isNotNull()
    return lines.select(
        position.alias(order),
        *[_text(name) for name in TEXT_FIELDS],
        *[_literal(name) for name in LITERAL_FIELDS],
        F.when(~F.coalesce(whole, F.lit(False)), F.col("value")).alias(CORRUPT_COLUMN),
    )
