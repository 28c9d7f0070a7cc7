"""Text lines with a dense row number in stored order, for sources that carry none.

Text and JSON Lines files have no row index. But a split is read by one task from
its first line to its last, and a task numbers the rows that it reads; so a line's
place in its split is the distance to the split's least number, and the lines
ahead of the split are a running sum of counts. One pass counts the lines of every
split, a second one reads them; nothing but the counts is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnower.sources.offsets import bounded
from winnower.sources.ordered import file_order, offsets_of_files
from winnower.storage import written


def _line_places(lines: DataFrame) -> DataFrame:
    """(_file, _start, _row, value): the split of each line and its number within a task."""
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
    )


def _split_offsets(placed: DataFrame, files: list[str]) -> DataFrame:
    """(_file, _start, _first, _last, _before) of every split; written, so counted once."""
    spark = placed.sparkSession
    splits = placed.groupBy("_file", "_start").agg(
        F.min("_row").alias("_first"), F.max("_row").alias("_last"), F.count("*").alias("_rows")
    )
    splits = written(spark, splits, "splits")
    by_file = splits.groupBy("_file").agg(F.sum("_rows").alias("_rows"))
    ahead = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("_rows").over(ahead), F.lit(0))
    found = (
        splits.withColumn("_within", within)
        .join(offsets_of_files(by_file, files), "_file")
        .select("_file", "_start", "_first", "_last", (F.col("_offset") + F.col("_within")).alias("_before"))
    )
    return written(spark, found, "splits")


def read_numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(seq, value) of all lines, numbered from 0 in stored order of their files.

    Both passes use one listing and one plan of splits. Should a session plan them
    anew in between, as after losing cores for a small source, a row whose number
    does not fit its split stops the job instead of getting a wrong place.
    """
    paths = [path] if isinstance(path, str) else path
    lines = spark.read.text(paths)
    placed = _line_places(lines)
    offsets = _split_offsets(placed, file_order(lines, paths))
    fits = F.col("_row").between(F.col("_first"), F.col("_last"))
    moved = F.raise_error(F.lit("the splits of the source are not those that were counted"))
    place = F.col("_before") + F.col("_row") - F.col("_first")
    return placed.join(bounded(offsets, offsets.count()), ["_file", "_start"], "left").select(
        F.when(fits, place).otherwise(moved.cast("long")).alias("seq"), "value"
    )
