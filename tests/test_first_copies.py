from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from winnower import fixtures
from winnower.config import Sampling
from winnower.operators.dedup import keep_first_in_order
from winnower.operators.selection import select_rows
from winnower.streaming.clean import KEPT_NAME, PROGRESS_NAME, ProgressLog
from winnower.streaming.first_copies import FirstCopies, start_first_copy_stream
from winnower.streaming.progress import PushedProgress, next_batch

MIDDLE = "/root/testdata/sf0.01"
WHOLE = Sampling(hash_prob=1.0)
TRIGGERS = 4


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Pairs in files by ranges of seq, written one after the other."""
    folder = str(tmp_path_factory.mktemp("ordered") / "pairs")
    pairs = fixtures.document_pairs(spark, MIDDLE).cache()
    for part in range(TRIGGERS):
        rows = pairs.where(F.col("seq").between(part * 250, part * 250 + 249))
        rows.coalesce(1).write.mode("append").parquet(folder)
    return folder


def _kept(spark, copies):
    schema = "seq bigint, instruction string, output string"
    rows = spark.read.schema(schema).json(copies.records)
    return sorted(map(tuple, rows.select("seq", "instruction", "output").collect()))


def test_triggers_keep_the_first_copies_of_a_batch(spark, parts, tmp_path):
    schema = spark.read.parquet(parts).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
    copies = FirstCopies(str(tmp_path / "out"), sampling=WHOLE, keep=("seq",))
    query = start_first_copy_stream(reader.parquet(parts), copies, f"{tmp_path}/state")
    assert query.awaitTermination(300) and query.exception() is None
    assert next_batch(spark, f"{tmp_path}/state") == TRIGGERS
    batch = keep_first_in_order(select_rows(spark.read.parquet(parts), sampling=WHOLE))
    expected = sorted(map(tuple, batch.select("seq", "q", "r").collect()))
    assert _kept(spark, copies) == expected and len(expected) == 767
    # A trigger that runs again after it had written changes nothing.
    again = spark.read.parquet(parts).where(F.col("seq").between(500, 749))
    copies(again, 2)
    assert _kept(spark, copies) == expected
    # One that failed between records and keys is run again as well.
    keys = spark.read.parquet(copies.keys).count()
    copies(again, 2)
    assert spark.read.parquet(copies.keys).count() == keys == 767


def test_parts_of_the_keys_are_pruned(spark, parts, tmp_path):
    copies = FirstCopies(str(tmp_path / "out"), sampling=WHOLE, keep=("seq",))
    copies(spark.read.parquet(parts).where("seq < 300"), 0)
    plan = copies.known_keys(spark, 1, ["0A", "FF"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part" in plan.split("PartitionFilters: [")[1]
    assert copies.known_keys(spark, 0, ["0A"]).count() == 0


def test_pushed_progress_misses_no_trigger(spark, tmp_path):
    """More triggers than Spark keeps for those who poll."""
    files, kept = 130, 20
    source = tmp_path / "in"
    source.mkdir()
    for i in range(files):
        (source / f"{i:04d}.txt").write_text(f"row {i}\n" * (i + 1))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(kept))
    progress = PushedProgress()
    spark.streams.addListener(progress)
    try:
        stream = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))
        counted = stream.observe(PROGRESS_NAME, F.count(F.lit(1)).alias("selected_rows"))
        counted = counted.observe(KEPT_NAME, F.count(F.lit(1)).alias("kept_rows"))
        first = next_batch(spark, f"{tmp_path}/state")
        query = (
            counted.writeStream.format("noop")
            .option("checkpointLocation", f"{tmp_path}/state")
            .trigger(availableNow=True)
            .start()
        )
        progress.expect(query, first)
        assert query.awaitTermination(600)
        report = progress.report(query, WHOLE)
        assert report["kept_rows"] == report["selected_rows"] == files * (files + 1) // 2
        assert report["dropped_dedup"] == 0 and report["p"] == 1.0
        log = ProgressLog(query, WHOLE, first_batch=first)
        with pytest.raises(RuntimeError, match="triggers 0 to"):
            log.update()  # a poll that comes late says so
    finally:
        spark.streams.removeListener(progress)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_a_gap_is_reported():
    class Event:
        def __init__(self, batch):
            self.progress = self
            self.runId, self.batchId, self.batchDuration = "r", batch, 5
            self.processedRowsPerSecond, self.observedMetrics = 1.0, {}

    class Query:
        runId, isActive = "r", True

    progress = PushedProgress()
    progress.expect(Query, 3)
    for batch in (3, 3, 4, 6):
        progress.onQueryProgress(Event(batch))
    with pytest.raises(RuntimeError, match="triggers 5 to 5"):
        progress.report(Query, WHOLE)
    late = PushedProgress()
    late.onQueryProgress(Event(7))
    late.expect(Query, 5)
    with pytest.raises(RuntimeError, match="triggers 5 to 6"):
        late.report(Query, WHOLE)
    assert threading.active_count() >= 1
