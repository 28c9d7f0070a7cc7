"""Parquet scans with a dense row number in stored order.

Spark does not promise any row order, so "the first N rows" needs a number per
row: the position inside its file plus the rows of all files before it. Files
are taken by folder and then by the numbers in their names, since a job of more
than 100,000 tasks writes names of unlike lengths.
"""

from __future__ import annotations

import math
import re

import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnower.sources.offsets import bounded

_SPARK_HASH_SEED = 42
_FIRST_HEAD_FILES = 16
_HEAD_GROWTH = 8


def _stored_order(path: str) -> tuple:
    """Sort key of a path: its folder, then the name with numbers as numbers."""
    folder, _, name = path.rpartition("/")
    parts = re.split(r"(\d+)", name)
    return folder, [int(part) if i % 2 else part for i, part in enumerate(parts)], name


def file_order(scan: DataFrame, paths: list[str]) -> list[str]:
    """Files of a scan of the given paths in stored order, as rows show their paths.

    Spark's own file index on the driver holds them. Local paths are listed as
    ``file:///x`` but appear as ``file:/x`` in the metadata of a row. Several paths
    keep the order in which they were given.
    """
    listed = [re.sub(r"^(\w+):///", r"\1:/", file) for file in scan.inputFiles()]
    if len(paths) == 1:
        return sorted(set(listed), key=_stored_order)
    reader = scan.sparkSession.read
    files: list[str] = []
    for path in paths:
        own = reader.text(path).inputFiles()
        files += sorted((re.sub(r"^(\w+):///", r"\1:/", file) for file in own), key=_stored_order)
    return list(dict.fromkeys(files))


def _listed_files(spark: SparkSession, paths: list[str]) -> list[str]:
    return file_order(spark.read.parquet(*paths), paths)


def path_hash(path: str) -> int:
    """Spark's xxhash64 of a path."""
    unsigned = xxhash.xxh64_intdigest(path, seed=_SPARK_HASH_SEED)
    return unsigned - (1 << 64) if unsigned >> 63 else unsigned


def offsets_of_files(counts: DataFrame, files: list[str]) -> DataFrame:
    """Rows before each file, as ``(_file, _place, _offset)``, from ``(_file, _rows)``.

    Files are known by a 64-bit hash of their path. The running sum goes through
    groups of about sqrt(files) neighbouring files, so that neither step ever sorts
    all files in one task.
    """
    hashes = [path_hash(file) for file in files]
    if len(set(hashes)) < len(files):
        raise ValueError("two files of the source have paths of equal hash")
    places = counts.sparkSession.createDataFrame(
        list(zip(hashes, range(len(files)), strict=True)), "_file long, _place long"
    )
    counts = counts.join(bounded(places, len(files)), "_file").withColumn(
        "_group", F.floor(F.col("_place") / (math.isqrt(len(files)) + 1))
    )
    earlier = (Window.unboundedPreceding, -1)
    group_offsets = (
        counts.groupBy("_group")
        .agg(F.sum("_rows").alias("_group_rows"))
        .select(
            "_group",
            F.sum("_group_rows")
            .over(Window.orderBy("_group").rowsBetween(*earlier))
            .alias("_group_offset"),
        )
    )
    in_group = Window.partitionBy("_group").orderBy("_place").rowsBetween(*earlier)
    return (
        counts.withColumn("_within", F.coalesce(F.sum("_rows").over(in_group), F.lit(0)))
        .join(bounded(group_offsets, math.isqrt(len(files)) + 1), "_group")
        .select(
            "_file",
            "_place",
            (F.coalesce("_group_offset", F.lit(0)) + F.col("_within")).alias("_offset"),
        )
    )


def _file_offsets(scan: DataFrame, files: list[str]) -> DataFrame:
    """Rows before each file, as ``(_file, _offset)``; counting reads the footers only."""
    counts = scan.select(F.xxhash64("_metadata.file_path").alias("_file")).groupBy("_file")
    return offsets_of_files(counts.agg(F.count(F.lit(1)).alias("_rows")), files).drop("_place")


def _numbered(scan: DataFrame, files: list[str], columns: list[str]) -> DataFrame:
    """Rows with ``seq``. Offsets of so few files are broadcast, so no row is shuffled."""
    rows = scan.select(
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_position"),
        *columns,
    )
    unlisted = F.raise_error(F.lit("a file of the scan is not among the listed ones"))
    before = F.coalesce(F.col("_offset"), unlisted.cast("long"))
    offsets = bounded(_file_offsets(scan, files), len(files))
    return rows.join(offsets, "_file", "left").select(
        (before + F.col("_position")).alias("seq"), *columns
    )


def read_ordered(
    spark: SparkSession, path: str | list[str], columns: list[str] | None = None
) -> DataFrame:
    """Parquet rows with ``seq``, the row number in stored order from 0."""
    paths = [path] if isinstance(path, str) else path
    scan = spark.read.parquet(*paths)
    return _numbered(scan, _listed_files(spark, paths), columns or scan.columns)


def _head(scan: DataFrame, files: list[str], rows: int) -> tuple[DataFrame, list[str]]:
    """Leading files that hold ``rows`` rows, as a pruned scan, and their paths.

    Counts footers of a few leading files, and of more while they hold too few.
    Spark applies the filter on the path to its listing.
    """
    taken = _FIRST_HEAD_FILES
    while taken < len(files):
        head = scan.where(F.col("_metadata.file_path").isin(files[:taken]))
        if head.count() >= rows:
            return head, files[:taken]
        taken *= _HEAD_GROWTH
    return scan, files


def read_first(
    spark: SparkSession,
    path: str | list[str],
    rows: int,
    columns: list[str] | None = None,
) -> DataFrame:
    """First ``rows`` rows in stored order, with ``seq``, read from leading files only."""
    paths = [path] if isinstance(path, str) else path
    scan = spark.read.parquet(*paths)
    head, files = _head(scan, _listed_files(spark, paths), rows)
    return _numbered(head, files, columns or scan.columns).where(F.col("seq") < rows)
