"""End-to-end comparison of evaluation runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from winnower import fixed_values as fixed
from winnower.operators.compare import compare_many, compare_runs, resolve_scores
from winnower.sinks.comparison import write_csv, write_markdown
from winnower.sources.results import read_results, read_run
from winnower.storage import written


def summarise_two(
    spark: SparkSession,
    base_dir: str,
    sft_dir: str,
    csv_path: str,
    markdown_path: str,
    tasks: list[tuple[str, int]] = fixed.TASKS,
) -> DataFrame:
    """Compare the result files of two folders, and write CSV and Markdown."""
    results = read_run(spark, base_dir, "base").unionByName(read_run(spark, sft_dir, "sft"))
    scores = resolve_scores(results)
    comparison = written(spark, compare_runs(scores, "base", "sft", tasks), "comparison")
    write_csv(comparison, csv_path)
    write_markdown(comparison, markdown_path)
    return comparison


def summarise_many(
    spark: SparkSession,
    results_dir: str,
    baseline: str,
    csv_path: str,
    tasks: list[tuple[str, int]] = fixed.TASKS,
) -> DataFrame:
    """Compare every run below a folder with one baseline run, and write CSV."""
    scores = resolve_scores(read_results(spark, results_dir))
    comparison = written(spark, compare_many(scores, baseline, tasks), "comparison")
    write_csv(comparison, csv_path)
    return comparison
