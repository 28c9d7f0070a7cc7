"""Comparison tables as CSV and Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnower.fixed_values import MARKDOWN_HEADER
from winnower.operators.compare import markdown_lines

_REPORT_COLUMNS = ["task", "fewshot", "metric", "base_score", "sft_score", "delta"]


def _order(comparison: DataFrame) -> list[str]:
    return [name for name in ("run", "pos") if name in comparison.columns]


def write_csv(comparison: DataFrame, path: str) -> None:
    """CSV with a header, rows in report order, NULL as an empty field."""
    keys = _order(comparison)
    shown = [name for name in keys if name == "run"] + _REPORT_COLUMNS
    (
        comparison.orderBy(*keys)
        .select(*shown)
        .write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "")
        .csv(path)
    )


def markdown_table(comparison: DataFrame) -> DataFrame:
    """All lines of the table, with one header per run, as ``([run,] pos, line)``."""
    header = F.array(
        *[
            F.struct(F.lit(n - len(MARKDOWN_HEADER)).alias("pos"), F.lit(text).alias("line"))
            for n, text in enumerate(MARKDOWN_HEADER)
        ]
    )
    if "run" in comparison.columns:
        headers = comparison.select("run").distinct().select("run", F.inline(header))
    else:
        headers = comparison.sparkSession.range(1).select(F.inline(header))
    return headers.unionByName(markdown_lines(comparison))


def write_markdown(comparison: DataFrame, path: str) -> None:
    lines = markdown_table(comparison)
    lines.orderBy(*_order(lines)).select("line").write.mode("overwrite").text(path)
