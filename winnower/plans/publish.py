"""A dataset, its statistics and its demo as one commit.

A run writes everything into a new folder of its own. Readers find the version that
counts through one small manifest, which is replaced last and in one step: a run
that fails anywhere before leaves readers with the version they had, whole.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from winnower.functions.records import RECORD_COLUMNS
from winnower.plans.prepare import Prepared, prepare_dataset
from winnower.sinks.dataset import MANIFEST_FILE, manifest
from winnower.storage import file_names, path_exists, read_small_json, remove_folder, replace_small_json

_VERSIONS = "versions"


@dataclass(frozen=True)
class Published:
    """The version that a manifest names: folders of the dataset, the statistics and the demo."""

    version: str
    dataset: str
    stats: str
    demo: str


def publish_dataset(
    pairs: DataFrame, folder: str, dataset_name: str, keep_versions: int = 2, **options
) -> tuple[Published, Prepared]:
    """Prepare a new version and make it the one that counts.

    ``options`` are those of ``prepare_dataset``. Versions beyond the newest
    ``keep_versions`` are removed afterwards, so that readers of the one before can
    finish; what failed runs left goes with them.
    """
    spark, folder = pairs.sparkSession, folder.rstrip("/")
    before = published(spark, folder, dataset_name)
    number = int(before.version.split("-")[0]) + 1 if before else 0
    version = f"{number:09d}-{uuid.uuid4().hex}"
    own = f"{folder}/{_VERSIONS}/{version}"
    done = prepare_dataset(pairs, own, dataset_name, f"{own}/stats", demo_dir=own, **options)
    entry = manifest(dataset_name, f"{_VERSIONS}/{version}/{dataset_name}")
    entry[dataset_name]["version"] = version
    entry[dataset_name]["demo"] = done.demo[len(folder) + 1 :]
    replace_small_json(spark, f"{folder}/{MANIFEST_FILE}", entry)
    for old in file_names(spark, f"{folder}/{_VERSIONS}"):
        if old.split("-")[0].isdigit() and int(old.split("-")[0]) <= number - keep_versions:
            remove_folder(spark, f"{folder}/{_VERSIONS}/{old}")
    return published(spark, folder, dataset_name), done


def published(spark: SparkSession, folder: str, dataset_name: str) -> Published | None:
    """The version that counts now; None before the first one."""
    folder = folder.rstrip("/")
    if not path_exists(spark, f"{folder}/{MANIFEST_FILE}"):
        return None
    entry = read_small_json(spark, f"{folder}/{MANIFEST_FILE}")[dataset_name]
    version = entry["version"]
    return Published(
        version,
        f"{folder}/{entry['file_name']}",
        f"{folder}/{_VERSIONS}/{version}/stats",
        f"{folder}/{entry['demo']}",
    )


def read_published(spark: SparkSession, folder: str, dataset_name: str) -> DataFrame:
    """Records of the version that counts now."""
    found = published(spark, folder, dataset_name)
    if found is None:
        raise FileNotFoundError(f"nothing is published as {dataset_name} in {folder}")
    kinds = {"history": "array<array<string>>"}
    schema = ", ".join(f"{name} {kinds.get(name, 'string')}" for name in RECORD_COLUMNS)
    return spark.read.schema(schema).json(found.dataset)
