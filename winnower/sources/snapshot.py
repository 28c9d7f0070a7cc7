"""Snapshots of a Parquet source, pinned by a manifest and checked when they are read.

A manifest is a table with one row for each file: its place in stored order, its
name, bytes and time of change, its rows and the rows ahead of it. It is written
once. Reading compares the files as listed with the manifest and stops if any was
added, removed or changed; the row numbers come from the manifest, so nothing is
counted again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnower.sources.offsets import bounded
from winnower.sources.ordered import file_order, offsets_of_files
from winnower.storage import path_exists

_SHOWN = 5


class SnapshotChanged(ValueError):
    """Files of the source are not those that the manifest pinned."""


def _same_spelling(path: Column) -> Column:
    """Paths as rows show them: ``file:/x`` and ``file:///x`` are one."""
    return F.regexp_replace(path, r"^(\w+):///", "$1:/")


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """(_file, file, bytes, modified) of the files of a source; their contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return files.select(
        F.xxhash64(_same_spelling(F.col("_metadata.file_path"))).alias("_file"),
        F.col("path").alias("file"),
        F.col("length").alias("bytes"),
        F.unix_micros("modificationTime").alias("modified"),
    )


def _content(scan: DataFrame) -> Column:
    """Checksum of all rows of a file and their places."""
    return F.bit_xor(F.xxhash64(F.col("_metadata.row_index"), *map(F.col, scan.columns)))


def _per_file(scan: DataFrame, with_content: bool) -> DataFrame:
    """(_file, _rows, content); without content it reads footers only."""
    content = _content(scan) if with_content else F.any_value(F.lit(None).cast("long"))
    keyed = scan.groupBy(F.xxhash64(_same_spelling(F.col("_metadata.file_path"))).alias("_file"))
    return keyed.agg(F.count(F.lit(1)).alias("_rows"), content.alias("content"))


def pin_snapshot(spark: SparkSession, path: str, manifest: str, with_content: bool = False) -> DataFrame:
    """Write the manifest of a source, which must not exist yet; returns it.

    With ``with_content`` every row is read for a checksum of each file.
    """
    if path_exists(spark, manifest):
        raise FileExistsError(f"{manifest} is pinned already")
    scan = spark.read.parquet(path)
    files = file_order(scan, [path])
    counts = _per_file(scan, with_content)
    offsets = offsets_of_files(counts.select("_file", "_rows"), files)
    rows = (
        _listing(spark, path)
        .join(counts, "_file")
        .join(offsets.select("_file", "_place", "_offset"), "_file")
        .select(
            F.col("_place").alias("place"),
            "file",
            "bytes",
            "modified",
            F.col("_rows").alias("rows"),
            F.col("_offset").alias("rows_before"),
            "content",
            "_file",
        )
    )
    rows.write.parquet(manifest)
    return spark.read.parquet(manifest)


def changed_files(spark: SparkSession, path: str, manifest: str, with_content: bool = False) -> DataFrame:
    """(file, change) for every file that was added, removed or changed since it was pinned."""
    pinned = spark.read.parquet(manifest).alias("p")
    listed = _listing(spark, path)
    if with_content:
        found = _per_file(spark.read.parquet(path), True).select("_file", F.col("content").alias("found"))
        listed = listed.join(found, "_file", "left")
    else:
        listed = listed.withColumn("found", F.lit(None).cast("long"))
    both = pinned.join(listed.alias("n"), F.col("p._file") == F.col("n._file"), "full")
    differs = (F.col("p.bytes") != F.col("n.bytes")) | (F.col("p.modified") != F.col("n.modified"))
    if with_content:
        differs = differs | ~F.col("p.content").eqNullSafe(F.col("n.found"))
    change = (
        F.when(F.col("p._file").isNull(), "added")
        .when(F.col("n._file").isNull(), "removed")
        .when(differs, "changed")
    )
    return both.select(F.coalesce("p.file", "n.file").alias("file"), change.alias("change")).filter(
        "change is not null"
    )


def read_pinned(
    spark: SparkSession, path: str, manifest: str, columns: list[str] | None = None, with_content: bool = False
) -> DataFrame:
    """Rows with ``seq``, the row number in stored order, of a source that is still as pinned."""
    changes = changed_files(spark, path, manifest, with_content).orderBy("file").limit(_SHOWN).collect()
    if changes:
        raise SnapshotChanged(", ".join(f"{row['change']}: {row['file']}" for row in changes))
    scan = spark.read.parquet(path)
    columns = columns or scan.columns
    pinned = spark.read.parquet(manifest)
    offsets = pinned.select("_file", "rows_before", "rows")
    rows = scan.select(
        F.xxhash64(_same_spelling(F.col("_metadata.file_path"))).alias("_file"),
        F.col("_metadata.row_index").alias("_at"),
        *columns,
    )
    beyond = F.raise_error(F.lit("a file of the scan holds rows that the manifest does not know"))
    known = F.col("_at") < F.col("rows")
    return rows.join(bounded(offsets, pinned.count()), "_file", "left").select(
        F.when(known, F.col("rows_before") + F.col("_at")).otherwise(beyond.cast("long")).alias("seq"),
        *columns,
    )
