"""End-to-end preparation of an instruction dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from winnower import fixed_values as fixed
from winnower.config import CleaningRules, Sampling
from winnower.functions.records import instruction_records
from winnower.operators.dedup import first_kept, keep_first, keep_first_in_order
from winnower.operators.selection import select_rows
from winnower.operators.tally import stats_report
from winnower.sinks.dataset import (
    DEMO_MANIFEST_FILE,
    MANIFEST_FILE,
    write_records,
    write_stats,
)
from winnower.storage import remove_folder, shared_folder


def clean_records(
    pairs: DataFrame,
    rules: CleaningRules = CleaningRules(),
    sampling: Sampling = Sampling(),
    dedup: bool = False,
    null_as: str = "None",
) -> DataFrame:
    """Instruction records with ``seq``, as one lazy query without drop counts."""
    selected = select_rows(pairs, rules, sampling, count_all=False)
    kept = keep_first(selected) if dedup else selected
    return instruction_records(kept, null_as, keep=("seq",))


@dataclass(frozen=True)
class Prepared:
    """What a run wrote: counters, the dataset, the demo, and the table between if it was kept."""

    counts: dict[str, int]
    dataset: str
    demo: str | None
    selected: str | None


def _counts_row(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.LongType()) for name in counts])
    return spark.createDataFrame([tuple(counts.values())], schema)


def _checked_targets(**targets: str | None) -> None:
    """Refuse targets of which one would overwrite another."""
    named = {name: path.rstrip("/") for name, path in targets.items() if path}
    for name, path in named.items():
        for other, inner in named.items():
            if name != other and f"{inner}/".startswith(f"{path}/"):
                raise ValueError(f"{name} and {other} would both be written to {path}")


def prepare_dataset(
    pairs: DataFrame,
    dataset_dir: str,
    dataset_name: str,
    stats_path: str | None = None,
    rules: CleaningRules = CleaningRules(),
    sampling: Sampling = Sampling(),
    dedup: bool = False,
    ordered: bool = True,
    null_as: str = "None",
    demo_dir: str | None = None,
    demo_rows: int = fixed.DEMO_ROWS,
    source_revision: str = fixed.SOURCE_REVISION,
    demo_name: str | None = None,
    keep_selected: bool = False,
) -> Prepared:
    """Clean, sample, deduplicate and write; the source is read once.

    If anything follows that shuffles or reads again, the selected rows go to a
    table in the shared folder first. An executor lost later then costs a
    re-read of that table, not another pass of regexes over the source; and the
    counters are observed in tasks that write output, whose updates Spark
    applies exactly once, so retries cannot inflate them. That table is removed
    at the end unless ``keep_selected``.

    The demo is ``<demo_dir>/<demo_name>``, by default the dataset's name and
    ``_demo``, with a manifest of its own, so it may share the dataset's folder.
    """
    spark = pairs.sparkSession
    demo_name = demo_name or f"{dataset_name}_demo"
    _checked_targets(
        dataset=f"{dataset_dir.rstrip('/')}/{dataset_name}",
        demo=demo_dir and f"{demo_dir.rstrip('/')}/{demo_name}",
        stats=stats_path,
    )
    selection = Observation()
    selected = select_rows(pairs, rules, sampling, selection)
    staged = None
    if dedup or ordered or demo_dir:
        staged = shared_folder(spark, "selected")
        selected.write.option("compression", "zstd").parquet(staged)
        selected = spark.read.parquet(staged)
    if dedup:
        kept = keep_first_in_order(selected) if ordered else keep_first(selected)
    else:
        kept = selected.orderBy(F.asc_nulls_last("seq")) if ordered else selected
    written = Observation()
    kept = kept.observe(written, F.count(F.lit(1)).alias("kept_rows"))
    dataset = write_records(instruction_records(kept, null_as), dataset_dir, dataset_name)

    counts = {name: int(value) for name, value in selection.get.items()}
    counts["kept_rows"] = int(written.get.get("kept_rows", 0))
    counts["dropped_dedup"] = counts["selected_rows"] - counts["kept_rows"]

    if stats_path:
        report = stats_report(
            _counts_row(spark, counts), rules, sampling.source_rows, source_revision
        )
        write_stats(report, stats_path)
    demo = None
    if demo_dir:
        if dedup:
            head = first_kept(selected, demo_rows)
        else:
            head = selected.orderBy(F.asc_nulls_last("seq")).limit(demo_rows)
        same_folder = demo_dir.rstrip("/") == dataset_dir.rstrip("/")
        demo = write_records(
            instruction_records(head, null_as),
            demo_dir,
            dataset_name,
            demo_name,
            DEMO_MANIFEST_FILE if same_folder else MANIFEST_FILE,
        )
    if staged and not keep_selected:
        remove_folder(spark, staged)
        staged = None
    return Prepared(counts, dataset, demo, staged)
