"""Rounding on the binary value, the place of rows without an order, and scratch folders."""

from __future__ import annotations

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from winnower.functions.metrics import score_text
from winnower.operators.dedup import first_kept, keep_first, keep_first_in_order
from winnower.storage import shared_folder


def _formatted(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    return {row.x: row.t for row in rows.select("x", score_text(F.col("x")).alias("t")).collect()}


def test_scores_are_rounded_as_python_rounds_them(spark):
    rng = random.Random(1)
    values = [(10 * k + 5) / 100_000 for k in range(10_000)]
    values += [k / 1024 for k in range(-2048, 2048)]
    values += [rng.uniform(-2, 2) for _ in range(5_000)] + [rng.uniform(0, 2**37) for _ in range(5_000)]
    values += [0.0, -0.0, 1.0, 0.99995, 0.00005, -0.00005, 5e-324, 123456.78905, 2.0**38 - 0.03125]
    found = _formatted(spark, values)
    wrong = [v for v in values if v != 0 and found[v] != f"{v:.4f}"]
    assert wrong == []
    assert found[0.0] == "0.0000"


def test_rows_without_an_order_come_last(spark):
    rows = [(None, "a"), (1, "a"), (None, "b"), (None, "b"), (3, "c"), (2, "c"), (None, "d")]
    table = spark.createDataFrame(rows, "seq long, key string")
    expected = [(1, "a"), (2, "c"), (None, "b"), (None, "d")]
    assert sorted(map(tuple, keep_first(table).collect()), key=str) == sorted(expected, key=str)
    in_order = [tuple(row) for row in keep_first_in_order(table).select("seq", "key").collect()]
    assert in_order[:2] == expected[:2] and sorted(in_order[2:], key=str) == expected[2:]
    for n in range(6):
        head = [tuple(row) for row in first_kept(table, n).select("seq", "key").collect()]
        assert [row[0] for row in head] == [row[0] for row in expected[:n]]
    nameless = table.where("seq is null")
    assert [row.seq for row in first_kept(nameless, 5).collect()] == [None] * 3
    assert first_kept(table.limit(0), 3).count() == 0


def test_a_folder_of_the_driver_is_refused_on_a_cluster():
    named = {"spark.checkpoint.dir": None, "spark.sql.warehouse.dir": "file:/home/me/warehouse"}

    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda name, default=None: named[name] or default),
            sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master=master),
        )

    assert shared_folder(session("local[8,3]"), "x").startswith("file:/home/me/warehouse/x-")
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
            shared_folder(session(master), "x")
