"""Comparison of evaluation runs against a baseline run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower import fixed_values as fixed
from winnower.functions.metrics import is_corrupt, quoted, score_text, with_best_metric
from winnower.storage import written


def _report_rows(tasks: list[tuple[str, int]], *scores: str) -> str:
    """SQL of one row per report task; ``#`` in ``scores`` stands for its position."""
    rows = []
    for pos, (task, fewshot) in enumerate(tasks):
        fields = [f"{pos} as pos", f"{quoted(task)} as task", f"{fewshot} as fewshot"]
        fields += [score.replace("#", str(pos)) for score in scores]
        rows.append(f"struct({', '.join(fields)})")
    return f"inline(array({', '.join(rows)}))"


def resolve_scores(
    results: DataFrame, preferences: dict[str, list[str]] = fixed.PREFERRED_METRICS
) -> DataFrame:
    """``run, task, fewshot, metric, score, corrupt`` of result files.

    ``results`` has ``run, task, fewshot, value`` with the JSON text in ``value``
    and one row per file, so at most one for a run, task and few-shot count.
    """
    return with_best_metric(results, preferences).select(
        "run",
        "task",
        "fewshot",
        F.col("best.metric").alias("metric"),
        F.col("best.score").alias("score"),
        is_corrupt(F.col("value")).alias("corrupt"),
    )


def _best_of_run(pos: int, task: str, fewshot: int, alias: str, of_run: str = "true") -> Column:
    """Aggregate of the one result for a report task; NULL if there is no file."""
    condition = f"{of_run} and task = {quoted(task)} and fewshot = {fewshot}"
    return F.expr(f"max(if({condition}, struct(metric, score, corrupt), null)) as {alias}_{pos}")


def _side_fields(column: str, name: str) -> list[str]:
    return [
        f"{column}_#.metric as _{name}_metric",
        f"{column}_#.score as {name}_score",
        f"coalesce({column}_#.corrupt, false) as {name}_corrupt",
    ]


def _reported(joined: DataFrame, *first: str) -> DataFrame:
    """Metric of the tuned side if it has one, and the score difference."""
    metric = F.coalesce(F.nullif("_sft_metric", F.lit("")), F.col("_base_metric"))
    return joined.select(
        *first,
        "pos",
        "task",
        "fewshot",
        metric.alias("metric"),
        "base_score",
        "sft_score",
        (F.col("sft_score") - F.col("base_score")).alias("delta"),
        "base_corrupt",
        "sft_corrupt",
    )


def run_scores(
    scores: DataFrame, tasks: list[tuple[str, int]] = fixed.TASKS, name: str = "sft"
) -> DataFrame:
    """One row per run and report task, with NULL scores for a missing file.

    A fixed set of aggregates per run combines before the shuffle, so neither
    many runs nor a run with many files gathers in one task.
    """
    best = [_best_of_run(pos, task, fewshot, "_best") for pos, (task, fewshot) in enumerate(tasks)]
    rows = _report_rows(tasks, *_side_fields("_best", name))
    return scores.groupBy("run").agg(*best).selectExpr("run", rows)


def compare_runs(
    scores: DataFrame,
    baseline: str,
    candidate: str,
    tasks: list[tuple[str, int]] = fixed.TASKS,
) -> DataFrame:
    """One row per report task for two runs, from one pass over the scores.

    A missing file gives NULL scores, and one that did not parse also sets
    ``base_corrupt`` or ``sft_corrupt``.
    """
    best = [
        _best_of_run(pos, task, fewshot, f"_{name}", f"run = {quoted(run)}")
        for run, name in ((baseline, "base"), (candidate, "sft"))
        for pos, (task, fewshot) in enumerate(tasks)
    ]
    rows = _report_rows(tasks, *_side_fields("_base", "base"), *_side_fields("_sft", "sft"))
    both = scores.where(F.col("run").isin(baseline, candidate)).agg(*best).selectExpr(rows)
    return _reported(both)


def compare_many(
    scores: DataFrame, baseline: str, tasks: list[tuple[str, int]] = fixed.TASKS
) -> DataFrame:
    """One row per candidate run and report task, against one baseline run.

    Scores are read once, into a table of one row per run and task. The baseline
    has exactly one row per report task, which bounds what is broadcast.
    """
    table = written(scores.sparkSession, run_scores(scores, tasks), "run-scores")
    base = table.where(F.col("run") == baseline).select(
        "pos",
        F.col("_sft_metric").alias("_base_metric"),
        F.col("sft_score").alias("base_score"),
        F.col("sft_corrupt").alias("base_corrupt"),
    )
    joined = table.where(F.col("run") != baseline).join(F.broadcast(base), "pos", "left")
    known = joined.withColumn("base_corrupt", F.coalesce("base_corrupt", F.lit(False)))
    return _reported(known, "run")


def markdown_lines(comparison: DataFrame) -> DataFrame:
    """Markdown table rows ``(pos, line)`` of a comparison, without the header."""
    cells = [
        F.col("task"),
        F.col("fewshot").cast("string"),
        F.coalesce("metric", F.lit("")),
        score_text(F.col("base_score")),
        score_text(F.col("sft_score")),
        score_text(F.col("delta")),
    ]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    keys = [name for name in ("run", "pos") if name in comparison.columns]
    return comparison.select(*keys, line.alias("line"))
