"""Row numbers of text files, and snapshots that notice a change."""

from __future__ import annotations

import json
import os
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from winnower.operators.cleaning import label_rows
from winnower.sources import offsets, ordered
from winnower.sources.json_pairs import read_json_pairs
from winnower.sources.numbered_lines import read_numbered_lines
from winnower.sources.snapshot import SnapshotChanged, changed_files, pin_snapshot, read_pinned


@contextmanager
def _settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


SMALL_SPLITS = {"spark__sql__files__maxPartitionBytes": "700", "spark__sql__files__openCostInBytes": "1"}


def _lines(folder, sizes):
    folder.mkdir()
    lines = []
    for name, size in sizes:
        own = [f"{name} line {i} " + "x" * (i * 37 % 90) for i in range(size)]
        (folder / name).write_text("".join(f"{line}\n" for line in own))
        lines.append((name, own))
    return lines


def test_lines_of_uneven_files_over_many_splits(spark, tmp_path):
    sizes = [("part-9", 120), ("part-10", 3), ("part-100", 400), ("part-2", 0), ("part-11 + b", 57)]
    made = dict(_lines(tmp_path / "in put", sizes))
    order = sorted(made, key=lambda name: ordered._stored_order(f"/{name}"))
    expected = [line for name in order for line in made[name]]
    with _settings(spark, **SMALL_SPLITS):
        numbered = read_numbered_lines(spark, str(tmp_path / "in put"))
        assert spark.read.text(str(tmp_path / "in put")).rdd.getNumPartitions() > 20
        rows = numbered.collect()
    assert [row.value for row in sorted(rows)] == expected
    assert [row.seq for row in sorted(rows)] == list(range(len(expected)))


def test_given_paths_keep_their_order(spark, tmp_path):
    made = dict(_lines(tmp_path / "in", [("a", 5), ("b", 4)]))
    rows = read_numbered_lines(spark, [f"{tmp_path}/in/b", f"{tmp_path}/in/a"]).orderBy("seq").collect()
    assert [row.value for row in rows] == made["b"] + made["a"]


def test_other_splits_than_counted_stop_the_job(spark, tmp_path):
    _lines(tmp_path / "in", [("a", 300)])
    with _settings(spark, **SMALL_SPLITS):
        numbered = read_numbered_lines(spark, f"{tmp_path}/in")
    with _settings(spark, spark__sql__files__maxPartitionBytes="2000", spark__sql__files__openCostInBytes="1"):
        try:
            rows = numbered.select("seq").collect()
        except Exception as error:  # noqa: BLE001  Spark's own error types differ by how it runs
            assert "not those that were counted" in str(error)
        else:  # the plan was made while the other setting held
            assert sorted(row.seq for row in rows) == list(range(300))


def test_offsets_too_many_to_broadcast_are_joined(spark, tmp_path, monkeypatch):
    made = dict(_lines(tmp_path / "in", [("a", 30), ("b", 20)]))
    monkeypatch.setattr(offsets, "BROADCAST_OFFSETS", 0)
    with _settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        numbered = read_numbered_lines(spark, f"{tmp_path}/in")
        assert "Broadcast" not in numbered._jdf.queryExecution().executedPlan().toString()
        rows = numbered.orderBy("seq").collect()
    assert [row.value for row in rows] == made["a"] + made["b"]


def test_json_pairs_without_an_order_field(spark, tmp_path):
    good = {"question": "a question here", "response": "a response long enough", "id": 9}
    lines = [json.dumps(good), "nonsense", json.dumps({**good, "response": None}), json.dumps([good])]
    (tmp_path / "pairs.jsonl").write_text("\n".join(lines))
    pairs = read_json_pairs(spark, str(tmp_path), order_field=None)
    rows = {row.seq: row.drop_reason for row in label_rows(pairs).collect()}
    assert rows == {0: "valid", 1: "other", 2: "empty", 3: "other"}


@pytest.fixture
def pinned(spark, tmp_path):
    source, manifest = f"{tmp_path}/rows + more", f"{tmp_path}/manifest"
    for part in range(5):
        rows = spark.range(part * 10, part * 10 + 2 * part + 1).select(F.col("id").alias("n"))
        rows.coalesce(1).write.parquet(f"{source}/part={part}")
    pin_snapshot(spark, source, manifest, with_content=True)
    return source, manifest


def test_pinned_rows_are_numbered_by_the_manifest(spark, pinned):
    rows = read_pinned(spark, *pinned, ["n"]).orderBy("seq").collect()
    expected = [part * 10 + i for part in range(5) for i in range(2 * part + 1)]
    assert [row.n for row in rows] == expected and [row.seq for row in rows] == list(range(25))
    manifest = spark.read.parquet(pinned[1]).orderBy("place").collect()
    assert [(row.place, row.rows, row.rows_before) for row in manifest] == [
        (0, 1, 0), (1, 3, 1), (2, 5, 4), (3, 7, 9), (4, 9, 16),
    ]
    with pytest.raises(FileExistsError):
        pin_snapshot(spark, *pinned)


def _only_file(folder):
    return next(os.path.join(folder, name) for name in os.listdir(folder) if name.endswith(".parquet"))


def test_a_removed_or_added_file_is_noticed(spark, pinned):
    source, manifest = pinned
    spark.range(3).select(F.col("id").alias("n")).coalesce(1).write.parquet(f"{source}/part=9")
    with pytest.raises(SnapshotChanged, match="added: .*part=9"):
        read_pinned(spark, source, manifest)
    os.remove(_only_file(f"{source}/part=3"))
    changes = {row.change for row in changed_files(spark, source, manifest).collect()}
    assert changes == {"added", "removed"}


def test_a_changed_file_is_noticed(spark, pinned, tmp_path):
    source, manifest = pinned
    target = _only_file(f"{source}/part=2")
    spark.range(100, 105).select(F.col("id").alias("n")).coalesce(1).write.parquet(f"{tmp_path}/other")
    before = os.stat(target)
    with open(_only_file(f"{tmp_path}/other"), "rb") as new, open(target, "wb") as old:
        old.write(new.read())
    crc = os.path.join(os.path.dirname(target), f".{os.path.basename(target)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    with pytest.raises(SnapshotChanged, match="changed: .*part=2"):
        read_pinned(spark, source, manifest)
    os.utime(target, ns=(before.st_atime_ns, before.st_mtime_ns))  # as if nothing had been written
    if os.stat(target).st_size == before.st_size:
        with pytest.raises(SnapshotChanged, match="changed: .*part=2"):
            read_pinned(spark, source, manifest, with_content=True)
