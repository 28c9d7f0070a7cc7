"""Evaluation result files as a table, one row per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnower.storage import path_exists

# .../<run>/<task>_<fewshot>shot.json, or a folder of that name that a Spark job
# wrote with run and file as partition columns.
_FILE_NAME = r"/(?:run=)?([^/]+)/(?:file=)?([^/]+)_([0-9]+)shot\.json(?:/part-[^/]+)?$"


def _decoded_path() -> Column:
    """Path of the current file; the URL form encodes blanks but not plus signs."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


_TABLE = "run string, task string, fewshot int, value string"


def _named(files: DataFrame) -> DataFrame:
    paths = files.select(_decoded_path().alias("_path"), "value")
    part = [F.regexp_extract("_path", _FILE_NAME, group) for group in (1, 2, 3)]
    return paths.where(F.col("_path").rlike(_FILE_NAME)).select(
        part[0].alias("run"), part[1].alias("task"), part[2].cast("int").alias("fewshot"), "value"
    )


def read_results(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``run, task, fewshot, value`` of all files ``<run>/<task>_<n>shot.json``.

    ``path`` is a folder of runs, or a list of them; the run is the name of the
    folder that holds the file. A file that does not exist is just a row that is
    not there, and files of other names are not opened.
    """
    return _named(spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True))


def read_run(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The result files directly in one folder, under a given name of the run.

    A folder that is missing holds no results, as a missing file does.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], _TABLE)
    files = spark.read.option("pathGlobFilter", "*shot.json").text(path, wholetext=True)
    return _named(files).withColumn("run", F.lit(run))
