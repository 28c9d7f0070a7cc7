from __future__ import annotations

import json
from types import SimpleNamespace

from winnower.storage import path_exists, shared_folder, write_small_json, written


def session(folder=None, checkpoint=None):
    context = SimpleNamespace(getCheckpointDir=lambda: checkpoint)
    named = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "hdfs://n/warehouse"}
    conf = SimpleNamespace(get=lambda name, default=None: named[name] or default)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_folder_of_the_cluster_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(f"{named}/x-") and first != second
    assert shared_folder(session("s3a://b/c/"), "x").startswith("s3a://b/c/x-")
    assert shared_folder(session(None, "hdfs://n/d"), "x").startswith("hdfs://n/d/x-")


def test_without_a_checkpoint_folder_the_warehouse_is_used():
    assert shared_folder(session(), "x").startswith("hdfs://n/warehouse/x-")


def test_written_rows_keep_their_schema(spark):
    rows = spark.createDataFrame([(1, None), (2, "b")], "id int, text string")
    again = written(spark, rows, "rows")
    assert again.schema == rows.schema and sorted(again.collect()) == sorted(rows.collect())
    assert written(spark, rows.limit(0), "none").count() == 0


def test_small_json(spark, tmp_path):
    path = f"{tmp_path}/new/folder/info.json"
    assert not path_exists(spark, path)
    for content in ({"a": [1, 2, 3, 4, 5, 6, 7]}, {"b": "\N{SNOWMAN}"}):
        write_small_json(spark, path, content)
        with open(path, encoding="utf-8") as file:
            assert json.load(file) == content
    assert path_exists(spark, path)
