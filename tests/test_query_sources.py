"""Inputs that the queries write for themselves are dealt to as many tasks as their size asks for."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from winnower import fixtures, queries
from winnower.operators.dedup import keep_first
from winnower.operators.selection import select_rows
from winnower.sources.numbered_lines import read_numbered_lines
from winnower.streaming.clean import start_clean_stream

ROWS = 120


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    """120 documents in three files, every second one a copy of the one before."""
    folder = str(tmp_path_factory.mktemp("tables"))
    text = F.format_string("Question number %d is this. The answer is given here in full.", F.expr("id div 2"))
    rows = spark.range(0, ROWS, 1, 3).select(
        F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source")
    )
    rows.write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture
def folders(monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "shared_folder", lambda spark, label: f"{tmp_path}/{label}")
    return tmp_path


def _files(folder: Path) -> list[Path]:
    return sorted(folder.rglob("part-*"))


def test_uneven_folders_are_written_by_ranges(spark, documents, tmp_path):
    rows = spark.read.parquet(f"{documents}/documents.parquet").select("doc_id", "source")
    uneven = queries._uneven(rows, 4)
    plan = uneven._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(doc_id" in plan and "hashpartitioning(part" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        line = F.col("doc_id").cast("string").alias("value")
        uneven.select(line, "part").write.partitionBy("part").text(f"{tmp_path}/lines")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(_files(tmp_path / "lines" / "part=003")) > 1
    read = read_numbered_lines(spark, f"{tmp_path}/lines").orderBy("seq").collect()
    assert [(row.seq, int(row.value)) for row in read] == [(i, i) for i in range(ROWS)]


def test_first_copy_source_is_written_by_all_tasks(spark, documents, folders):
    kept = queries.stream_first_copy(spark, documents).collect()
    pairs = fixtures.document_pairs(spark, documents)
    batch = keep_first(select_rows(pairs, queries.RULES, queries.EVERYTHING)).collect()
    assert sorted(row.seq for row in kept) == sorted(row.seq for row in batch) and len(kept) < ROWS
    assert len(_files(folders / "stream-source")) > queries.STREAM_TRIGGERS
    commits = [p.name for p in (folders / "stream-state" / "commits").iterdir() if p.name.isdigit()]
    assert sorted(commits) == [str(i) for i in range(queries.STREAM_TRIGGERS)]


@pytest.mark.parametrize(("files", "triggers"), [(2, 3), (1, 6)])
def test_stream_parts_have_more_files_in_a_larger_table(spark, documents, folders, monkeypatch, files, triggers):
    monkeypatch.setattr(queries, "STREAM_FILE_ROWS", 5)
    pairs = queries._document_stream(spark, documents, files)
    assert len(_files(folders / "stream-source")) == 24
    query = start_clean_stream(pairs, f"{folders}/out", f"{folders}/state", dedup=True, salt_column="seq", state_tasks=3)
    assert query.awaitTermination(300) and query.exception() is None
    assert len(query.recentProgress) == triggers
    for operator in range(2):  # the number of state folders of both steps
        parts = [p for p in (folders / "state" / "state" / str(operator)).iterdir() if p.name.isdigit()]
        assert len(parts) == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
