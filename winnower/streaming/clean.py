"""Cleaning and selection on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from winnower.config import CleaningRules, Sampling
from winnower.functions.records import instruction_records
from winnower.operators.selection import select_rows

PROGRESS_NAME = "selection"
KEPT_NAME = "kept"

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
_SHUFFLE_TASKS = "spark.sql.shuffle.partitions"


def stream_select(
    pairs: DataFrame,
    rules: CleaningRules = CleaningRules(),
    sampling: Sampling = Sampling(),
    dedup: bool = False,
    salt_column: str | None = None,
    salts: int = 32,
) -> DataFrame:
    """Selected rows of a stream of pairs; the counters come with its progress.

    With ``dedup`` the first row *processed* of each key survives, so the keys
    equal those of a batch run while the surviving copy may differ. The keys
    seen so far are the state, and nothing bounds them.

    A key that fills a third of the stream would all go to one task. Naming a
    column that varies between copies, such as a row number, in ``salt_column``
    splits each key over ``salts`` tasks first, so that the second step sees at
    most ``salts`` rows per key. It costs a second, equally large state.
    """
    selected = select_rows(pairs, rules, sampling, PROGRESS_NAME)
    kept = F.count(F.lit(1)).alias("kept_rows")
    if not dedup:
        return selected.observe(KEPT_NAME, kept)
    if salt_column:
        salt = F.pmod(F.xxhash64(salt_column), F.lit(salts))
        selected = (
            selected.withColumn("_salt", salt).dropDuplicates(["key", "_salt"]).drop("_salt")
        )
    return selected.dropDuplicates(["key"]).observe(KEPT_NAME, kept)


@contextmanager
def _rocksdb_state(spark: SparkSession, tasks: int | None) -> Iterator[None]:
    """State on disk instead of the heap, in so many tasks, for queries started inside.

    A trigger commits what changed, not the whole store.
    """
    wanted = {_STORE: _ROCKSDB, _CHANGELOG: "true"}
    if tasks:
        wanted[_SHUFFLE_TASKS] = str(tasks)
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start_clean_stream(
    pairs: DataFrame,
    output_dir: str,
    checkpoint_dir: str,
    rules: CleaningRules = CleaningRules(),
    sampling: Sampling = Sampling(),
    dedup: bool = False,
    salt_column: str | None = None,
    null_as: str = "None",
    keep: tuple[str, ...] = (),
    tasks: int | None = None,
    state_tasks: int | None = None,
) -> StreamingQuery:
    """Append the records of everything available to JSON Lines, then stop.

    Bound what a trigger takes by ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``
    of the source. Nothing is shuffled before rows are selected, unless ``tasks``
    is set: for a source of few large pieces the rows are then spread over that
    many tasks before the work on them.

    Each task that deduplicates opens and commits its part of the state in every
    trigger, for a second or so, however few its rows. ``state_tasks`` sets how many
    there are, a few for each core, where a session's shuffles have many more. The
    first run of a checkpoint fixes it.
    """
    spread = pairs.repartition(tasks) if tasks else pairs
    selected = stream_select(spread, rules, sampling, dedup, salt_column)
    records = instruction_records(selected, null_as, keep=keep)
    with _rocksdb_state(pairs.sparkSession, state_tasks):
        return (
            records.writeStream.format("json")
            .option("path", output_dir)
            .option("checkpointLocation", checkpoint_dir)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )


class ProgressLog:
    """Running counters of a stream, the minutes spent and the latest rows per second.

    Spark keeps the progress of the latest triggers only (100 unless configured).
    ``update`` raises if triggers went by unseen rather than lose their counts;
    call it more often, have Spark keep more, or use ``PushedProgress``, which
    cannot miss any. Those before the first call are only noticed if ``first_batch``
    names the trigger where the run began. The counters are for watching: Spark may
    count a row again if it repeats a task before a shuffle.
    """

    def __init__(
        self, query: StreamingQuery, sampling: Sampling = Sampling(), first_batch: int | None = None
    ) -> None:
        self._query = query
        self._first_batch = first_batch
        self._latest_batch: int | None = None
        self.p = round(sampling.probability, 6)
        self.counts: dict[str, int] = {}
        self.triggers = 0
        self.elapsed_min = 0.0
        self.rows_per_sec: float | None = None

    def _add(self, counts: dict[str, int]) -> None:
        for name, value in counts.items():
            self.counts[name] = self.counts.get(name, 0) + value

    def update(self) -> None:
        """Add the triggers that finished since the last call."""
        for progress in self._query.recentProgress:
            number, latest = progress.batchId, self._latest_batch
            if latest is not None and number <= latest:
                continue
            expected = self._first_batch if latest is None else latest + 1
            if expected is not None and number > expected:
                raise RuntimeError(f"triggers {expected} to {number - 1} were not seen")
            self._latest_batch = number
            self.elapsed_min += progress.batchDuration / 60_000
            observed = progress.observedMetrics
            if PROGRESS_NAME not in observed:
                continue
            self._add(observed[PROGRESS_NAME].asDict())
            self._add(observed[KEPT_NAME].asDict())
            self.triggers += 1
            self.counts["dropped_dedup"] = self.counts["selected_rows"] - self.counts["kept_rows"]
            self.rows_per_sec = progress.processedRowsPerSecond

    def report(self) -> dict[str, float | int | None]:
        """The counters with the probability of selection and the pace."""
        pace = self.rows_per_sec
        return self.counts | {
            "p": self.p,
            "elapsed_min": round(self.elapsed_min, 2),
            "rows_per_sec": None if pace is None else round(pace, 2),
        }

    def follow(self, every_sec: int = 10) -> None:
        """Update until the stream ends."""
        while not self._query.awaitTermination(every_sec):
            self.update()
        self.update()
