"""Python workers find this package where the driver found it."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = str(Path(__file__).resolve().parents[2])


def package_on_workers(spark: SparkSession) -> None:
    """Put the package's folder on the path of workers that start from now on.

    Serves sessions that were started in another folder, on machines that hold
    the package at the same place. A cluster that does not ships it by --py-files.
    """
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
