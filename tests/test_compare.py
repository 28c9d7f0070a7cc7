from __future__ import annotations

import csv
import json
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from winnower import fixed_values as fixed
from winnower.functions.metrics import score_text
from winnower.operators.compare import compare_many, compare_runs, resolve_scores
from winnower.plans.summarise import summarise_many, summarise_two
from winnower.sinks.comparison import markdown_table
from winnower.sources.results import read_results

RESULTS = "run string, task string, fewshot int, value string"

CASES = {
    "preferred": ("hellaswag", {"results": {"hellaswag": {"acc,none": 0.5, "acc_norm,none": 0.75}}},
                  ("acc_norm,none", 0.75)),
    "flat": ("piqa", {"results": {"acc": 0.25}}, ("acc", 0.25)),
    "empty block": ("mmlu", {"results": {"mmlu": {}, "acc": 0.5}}, ("acc", 0.5)),
    "file order": ("boolq", {"results": {"boolq": {"z,none": 0.125, "a,none": 0.875}}},
                   ("z,none", 0.125)),
    "boolean": ("boolq", {"results": {"boolq": {"s": "x", "b": True}}}, ("b", 1.0)),
    "false": ("boolq", {"results": {"boolq": {"b": False, "c": 2}}}, ("b", 0.0)),
    "text number": ("boolq", {"results": {"boolq": {"acc": "0.5"}}}, (None, None)),
    "preferred is text": ("mmlu", {"results": {"mmlu": {"acc,none": "x", "acc": 0.5}}},
                          ("acc", 0.5)),
    "second preference": ("arc_easy", {"results": {"arc_easy": {"f1": 1, "acc_norm": 0.1,
                                                                "acc": 0.2}}}, ("acc", 0.2)),
    "unknown task": ("other", {"results": {"other": {"n": None, "f1": 3}}}, ("f1", 3.0)),
    "integer": ("piqa", {"results": {"piqa": {"acc": 1}}}, ("acc", 1.0)),
    "exponent": ("piqa", {"results": {"piqa": {"acc": 1.5e-7}}}, ("acc", 1.5e-7)),
    "long": ("piqa", {"results": {"piqa": {"acc": 0.12345678901234567}}},
             ("acc", 0.12345678901234567)),
    "nested values": ("piqa", {"results": {"piqa": {"x": {"acc": 1}, "y": [1], "z": 4}}},
                      ("z", 4.0)),
    "not an object": ("piqa", {"results": [1]}, (None, None)),
    "results is text": ("piqa", {"results": "none"}, (None, None)),
    "no results": ("piqa", {"config": {"acc": 1}}, (None, None)),
    "nothing numeric": ("piqa", {"results": {"piqa": {"alias": "piqa"}}}, (None, None)),
    "non-ascii": ("piqa", {"results": {"piqa": {"\N{LATIN SMALL LETTER E WITH ACUTE}": 1}}}, ("\N{LATIN SMALL LETTER E WITH ACUTE}", 1.0)),
}


@pytest.mark.parametrize("name", CASES)
def test_metric(spark, name):
    task, content, expected = CASES[name]
    rows = [("r", task, 0, json.dumps(content)), ("i", task, 0, json.dumps(content, indent=2))]
    for score in resolve_scores(spark.createDataFrame(rows, RESULTS)).collect():
        assert (score.metric, score.score, score.corrupt) == (*expected, False)


def test_repeated_keys(spark):
    text = '{"results": {"t": {"a": 9}, "t": {"b": 1, "a": 2, "b": 3}}}'
    score = resolve_scores(spark.createDataFrame([("r", "t", 0, text)], RESULTS)).first()
    assert (score.metric, score.score) == ("b", 3.0)


def test_malformed_file(spark):
    rows = [("r", "piqa", 0, "{bad"), ("r", "piqa", 0, "")]
    for score in resolve_scores(spark.createDataFrame(rows, RESULTS)).collect():
        assert (score.metric, score.score, score.corrupt) == (None, None, True)


@pytest.fixture
def runs(tmp_path):
    def write(run, task, shots, content):
        folder = tmp_path / "runs" / run
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{task}_{shots}shot.json").write_text(json.dumps(content, indent=1))

    for place, (task, shots) in enumerate(fixed.TASKS[:-1]):
        metric = fixed.PREFERRED_METRICS[task][0]
        write("base", task, shots, {"results": {task: {"alias": task, metric: place / 8}}})
        if place:
            write("tuned +1", task, shots, {"results": {metric: (place + 1) / 8}})
    write("base", "piqa", 3, {"results": {"acc": 9}})
    write("base", "unlisted", 0, {"results": {"acc": 9}})
    (tmp_path / "runs" / "base" / "notes.json").write_text("{}")
    return tmp_path / "runs"


EXPECTED = [
    (task, shots, fixed.PREFERRED_METRICS[task][0] if place < 7 else None,
     place / 8 if place < 7 else None, (place + 1) / 8 if 0 < place < 7 else None,
     0.125 if 0 < place < 7 else None)
    for place, (task, shots) in enumerate(fixed.TASKS)
]


CORRUPT = ["base_corrupt", "sft_corrupt"]


def _csv_rows(folder):
    files = sorted(Path(folder).glob("part-*.csv"))
    return [row for file in files for row in csv.DictReader(file.open(encoding="utf-8"))]


def _number(text):
    return float(text) if text else None


def test_two_runs_from_files(spark, runs, tmp_path):
    comparison = summarise_two(spark, str(runs / "base"), str(runs / "tuned +1"),
                               f"{tmp_path}/out.csv", f"{tmp_path}/out.md")
    rows = comparison.orderBy("pos").drop("pos", *CORRUPT).collect()
    assert [tuple(row) for row in rows] == EXPECTED
    assert [
        (row["task"], int(row["fewshot"]), row["metric"] or None,
         *[_number(row[name]) for name in ("base_score", "sft_score", "delta")])
        for row in _csv_rows(f"{tmp_path}/out.csv")
    ] == EXPECTED
    lines = [line for file in sorted(Path(f"{tmp_path}/out.md").glob("part-*"))
             for line in file.read_text().splitlines()]
    assert lines[:4] == [
        "| task | fewshot | metric | base | sft | delta |",
        "|---|---:|---|---:|---:|---:|",
        "| mmlu | 5 | acc,none | 0.0000 |  |  |",
        "| arc_easy | 0 | acc,none | 0.1250 | 0.2500 | 0.1250 |",
    ]
    assert lines[-1] == "| boolq | 0 |  |  |  |  |"
    assert len(lines) == 10


def test_missing_folder(spark, runs, tmp_path):
    comparison = summarise_two(spark, str(runs / "base"), str(runs / "absent"),
                               f"{tmp_path}/out.csv", f"{tmp_path}/out.md")
    rows = comparison.orderBy("pos").collect()
    assert [row.base_score for row in rows] == [row[3] for row in EXPECTED]
    assert {row.sft_score for row in rows} == {row.delta for row in rows} == {None}


def test_many_runs_equal_two_runs(spark, runs, tmp_path):
    results = read_results(spark, str(runs))
    assert {row.run for row in results.select("run").distinct().collect()} == {"base", "tuned +1"}
    scores = resolve_scores(results)
    many = compare_many(scores, "base").orderBy("run", "pos").drop("pos", *CORRUPT).collect()
    assert [tuple(row) for row in many] == [("tuned +1", *row) for row in EXPECTED]
    two = compare_runs(scores, "base", "tuned +1").orderBy("pos").drop("pos", *CORRUPT).collect()
    assert [tuple(row) for row in two] == EXPECTED
    summarise_many(spark, str(runs), "base", f"{tmp_path}/many.csv")
    assert [row["run"] for row in _csv_rows(f"{tmp_path}/many.csv")] == ["tuned +1"] * 8


def test_names_with_quotes(spark):
    name, metric = "it's \\ \"odd\" #1", "'acc' \\d"
    text = json.dumps({"results": {name: {"other": 1, metric: 0.5}}})
    results = spark.createDataFrame([("r", name, 2, text), ("b", name, 2, text)], RESULTS)
    scores = resolve_scores(results, {name: [metric]})
    for comparison in (compare_many(scores, "b", [(name, 2)]),
                       compare_runs(scores, "b", "r", [(name, 2)])):
        row = comparison.first()
        assert (row.task, row.metric, row.sft_score, row.delta) == (name, metric, 0.5, 0.0)


def test_markdown_has_a_header_per_run(spark, runs):
    scores = resolve_scores(read_results(spark, str(runs)))
    both = scores.unionByName(scores.where("run <> 'base'").replace("tuned +1", "second", "run"))
    lines = markdown_table(compare_many(both, "base")).orderBy("run", "pos").collect()
    assert [row.line[:6] for row in lines if row.pos < 0] == ["| task", "|---|-"] * 2
    assert len(lines) == 20


def test_rounding_to_four_decimals(spark):
    scores = [None, 0.0, 0.03125, 0.09375, 1 / 3, -0.00004, 0.99996, 12.5, 1e-9]
    frame = spark.createDataFrame([(n, s) for n, s in enumerate(scores)], "n int, s double")
    texts = [row.t for row in frame.select("n", score_text(F.col("s")).alias("t"))
             .orderBy("n").collect()]
    assert texts == ["" if s is None else f"{s:.4f}" for s in scores]


@pytest.mark.parametrize(("block", "metric", "score", "corrupt"), [
    ('{"acc":NaN,"x":0.5}', "acc", math.nan, False),
    ('{"x":0.25,"acc_stderr":NaN}', "x", 0.25, False),
    ('{"acc":1e400}', "acc", math.inf, False),
    ('{"acc":-Infinity,"x":1}', "acc", -math.inf, False),
    ('{"acc":"NaN","x":1}', "x", 1.0, False),
    ('{"acc":0.5', None, None, True),
])
def test_numbers_that_json_does_not_hold(spark, block, metric, score, corrupt):
    value = f'{{"results":{{"boolq":{block}}}}}' if not corrupt else f'{{"results":{block}'
    rows = spark.createDataFrame([("r", "boolq", 0, value)],
                                 "run string, task string, fewshot int, value string")
    row = resolve_scores(rows).first()
    assert (row.metric, repr(row.score), row.corrupt) == (metric, repr(score), corrupt)
    two = compare_runs(resolve_scores(rows), "r", "other").where("task = 'boolq'").first()
    assert (two.base_corrupt, two.sft_corrupt) == (corrupt, False)
