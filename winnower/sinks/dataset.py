"""Instruction datasets as JSON Lines with a manifest, and the run statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from winnower import fixed_values as fixed
from winnower.functions.records import RECORD_COLUMNS
from winnower.storage import write_small_json

MANIFEST_FILE = "dataset_info.json"
DEMO_MANIFEST_FILE = "demo_dataset_info.json"


def manifest(dataset_name: str, file_name: str) -> dict:
    return {dataset_name: {"file_name": file_name, "columns": dict(fixed.MANIFEST_COLUMNS)}}


def write_records(
    records: DataFrame,
    dataset_dir: str,
    dataset_name: str,
    file_name: str | None = None,
    manifest_file: str = MANIFEST_FILE,
) -> str:
    """Write records to ``<dataset_dir>/<file_name>`` and describe them beside it.

    The file is named like the dataset unless ``file_name`` says otherwise.

    The result is a folder of JSON Lines written by all executors. If the
    records are sorted, the part files in order of their names are so too.
    """
    folder, file_name = dataset_dir.rstrip("/"), file_name or dataset_name
    target = f"{folder}/{file_name}"
    records.select(*RECORD_COLUMNS).write.mode("overwrite").json(target)
    spark: SparkSession = records.sparkSession
    write_small_json(spark, f"{folder}/{manifest_file}", manifest(dataset_name, file_name))
    return target


def write_stats(report: DataFrame, path: str) -> None:
    """Write the one-row statistics report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)
