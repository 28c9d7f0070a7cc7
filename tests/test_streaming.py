from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from winnower import fixtures
from winnower.config import Sampling
from winnower.operators.dedup import keep_first
from winnower.operators.selection import select_rows
from winnower.streaming.clean import ProgressLog, start_clean_stream, stream_select

MIDDLE = "/root/testdata/sf0.01"
WHOLE = Sampling(hash_prob=1.0)


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stream") / "pairs")
    fixtures.document_pairs(spark, MIDDLE).repartition(5).write.parquet(folder)
    return folder


def _stream(spark, parts):
    schema = spark.read.parquet(parts).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(parts)


def _finish(query):
    assert query.awaitTermination(300)
    assert query.exception() is None


def test_stream_without_dedup_equals_batch(spark, parts, tmp_path):
    half = Sampling(hash_prob=0.5)
    query = start_clean_stream(
        _stream(spark, parts), f"{tmp_path}/out", f"{tmp_path}/state", sampling=half,
        keep=("seq",),
    )
    log = ProgressLog(query)
    log.follow(every_sec=1)
    log.update()  # counts nothing twice
    written = spark.read.schema("seq bigint").json(f"{tmp_path}/out")
    batch = select_rows(spark.read.parquet(parts), sampling=half)
    assert sorted(row.seq for row in written.collect()) == sorted(
        row.seq for row in batch.select("seq").collect()
    )
    names = ("seen_rows", "selected_rows", "dropped_empty", "dropped_length",
             "dropped_char_run", "dropped_repetition")
    assert [log.counts[name] for name in names] == [1_000, 408, 21, 129, 20, 19]
    assert log.elapsed_min > 0 and log.rows_per_sec > 0


@pytest.mark.parametrize("salt_column", [None, "seq"])
def test_stream_keeps_the_keys_of_a_batch(spark, parts, tmp_path, salt_column):
    selected = stream_select(_stream(spark, parts), sampling=WHOLE, dedup=True,
                             salt_column=salt_column, salts=4)
    query = (
        selected.select(F.hex("key").alias("key"))
        .writeStream.format("json")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/state")
        .trigger(availableNow=True)
        .start()
    )
    _finish(query)
    streamed = [row.key for row in spark.read.schema("key string").json(f"{tmp_path}/out").collect()]
    kept = keep_first(select_rows(spark.read.parquet(parts), sampling=WHOLE))
    assert sorted(streamed) == sorted(
        row.key for row in kept.select(F.hex("key").alias("key")).collect()
    )
    assert len(streamed) == 767


def test_restarted_stream_remembers_keys(spark, parts, tmp_path):
    source = f"{tmp_path}/in"
    pairs = spark.read.parquet(parts)
    counts = []
    for _ in range(2):
        pairs.write.mode("append").parquet(source)
        stream = spark.readStream.schema(pairs.schema).parquet(source)
        _finish(start_clean_stream(stream, f"{tmp_path}/out", f"{tmp_path}/state",
                                   sampling=WHOLE, dedup=True, salt_column="seq", tasks=4))
        counts.append(spark.read.text(f"{tmp_path}/out").count())
    assert counts == [767, 767]
