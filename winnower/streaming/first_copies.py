"""A deduplicating stream that keeps the first copy of the source, as a batch run does.

State in executors would have to hold every key seen. Here a table on shared
storage does: keys of selected rows, in folders by trigger and by the first byte of
the key, so that a trigger reads the parts that its own keys can be in. Each
trigger keeps the first copy of a key among its rows and drops the keys of earlier
triggers. As triggers take files in stored order, what remains is the first copy of
the whole source.

What a trigger writes goes to folders named by its number, which a repeated
trigger overwrites, and it reads the keys of smaller numbers only: running one
twice changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from winnower.config import CleaningRules, Sampling
from winnower.functions.records import instruction_records
from winnower.operators.dedup import keep_first
from winnower.operators.selection import select_rows
from winnower.storage import path_exists, remove_folder, shared_folder

_KEYS = "key binary, batch bigint, part string"


@dataclass(frozen=True)
class FirstCopies:
    """What each trigger of the stream runs; ``folder`` takes the records and the keys."""

    folder: str
    rules: CleaningRules = CleaningRules()
    sampling: Sampling = Sampling()
    null_as: str = "None"
    keep: tuple[str, ...] = ()
    order: str = "seq"

    @property
    def records(self) -> str:
        return f"{self.folder}/records"

    @property
    def keys(self) -> str:
        return f"{self.folder}/keys"

    def known_keys(self, spark: SparkSession, before: int, parts: list[str]) -> DataFrame:
        """Keys that earlier triggers kept, from the parts asked for."""
        if not path_exists(spark, self.keys):
            return spark.createDataFrame([], _KEYS).select("key")
        table = spark.read.schema(_KEYS).option("basePath", self.keys).parquet(self.keys)
        return table.filter((F.col("batch") < before) & F.col("part").isin(parts)).select("key")

    def __call__(self, pairs: DataFrame, batch: int) -> None:
        spark = pairs.sparkSession
        staged = shared_folder(spark, "trigger")
        select_rows(pairs, self.rules, self.sampling).write.parquet(staged)
        part = F.hex(F.substring("key", 1, 1))
        first = keep_first(spark.read.parquet(staged), order=self.order).withColumn("part", part)
        parts = [row["part"] for row in spark.read.parquet(staged).select(part.alias("part")).distinct().collect()]
        fresh = first.join(self.known_keys(spark, batch, parts), "key", "left_anti")
        kept = f"{staged}-kept"
        fresh.write.parquet(kept)
        fresh = spark.read.parquet(kept)
        # The keys come last: with records but without keys the trigger is run again.
        records = instruction_records(fresh, self.null_as, keep=self.keep)
        records.write.mode("overwrite").json(f"{self.records}/batch={batch}")
        keys = fresh.select("key", "part").repartition("part")
        keys.write.mode("overwrite").partitionBy("part").parquet(f"{self.keys}/batch={batch}")
        for scratch in (staged, kept):
            remove_folder(spark, scratch)


def start_first_copy_stream(pairs: DataFrame, copies: FirstCopies, checkpoint_dir: str) -> StreamingQuery:
    """Append the first copies of everything available, then stop.

    The source has to deliver files in stored order, as file sources do by time of
    change; bound a trigger by its ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``.
    """
    return (
        pairs.writeStream.foreachBatch(copies)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
