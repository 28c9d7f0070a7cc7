from __future__ import annotations

import json
import re
from pathlib import Path

import pandas
import pytest
from pyspark import TaskContext
from pyspark.sql import Observation
from pyspark.sql import functions as F

from winnower import fixtures
from winnower.config import CleaningRules, Sampling
from winnower.functions.text import literal_field, text_field
from winnower.operators.cleaning import label_rows
from winnower.operators.selection import select_rows
from winnower.plans.prepare import clean_records, prepare_dataset
from winnower.sources import ordered
from winnower.sources.json_pairs import read_json_pairs
from winnower.sources.ordered import read_first, read_ordered
from winnower.sources.spread import PIECES_SETTING, spread

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """1,000 rows in 40 files of uneven size, in a folder with a blank and a plus."""
    folder = tmp_path_factory.mktemp("many") / "rows + more"
    rows = spark.range(1_000).select(F.col("id").alias("n"), (F.col("id") % 7).alias("other"))
    bucket = F.floor(F.sqrt(F.col("n") * F.lit(1.6)))
    for number in range(40):
        rows.where(bucket == number).coalesce(1).write.parquet(f"{folder}/x/{number:03d}")
    return [str(path) for path in sorted((folder / "x").iterdir())]


def test_row_numbers_over_many_files(spark, many_files):
    frame = read_ordered(spark, many_files, ["n"])
    assert [tuple(row) for row in frame.orderBy("seq").collect()] == [(n, n) for n in range(1_000)]
    assert read_ordered(spark, many_files).columns == ["seq", "n", "other"]


@pytest.mark.parametrize("rows", [0, 1, 99, 333, 1_000, 5_000])
def test_first_rows(spark, many_files, rows):
    result = read_first(spark, many_files, rows, ["n"]).orderBy("seq").collect()
    assert [row.n for row in result] == list(range(min(rows, 1_000)))


def test_first_rows_read_the_leading_files_only(spark, many_files):
    scan = spark.read.parquet(*many_files)
    path = F.col("_metadata.file_path")
    files = ordered._listed_files(spark, many_files)
    assert files == sorted(row[0] for row in scan.select(path).distinct().collect())
    head, taken = ordered._head(scan, files, 50)
    assert taken == files[:16]
    assert {row[0] for row in head.select(path).distinct().collect()} == set(taken)
    assert scan.where(path.isin(files[:1])).rdd.getNumPartitions() == 1  # pruned while planning
    assert ordered._head(scan, files, 1_000)[1] == files


def test_file_offsets_go_through_small_groups(spark, many_files):
    scan = spark.read.parquet(*many_files)
    plan = ordered._file_offsets(scan, ordered._listed_files(spark, many_files))
    assert plan.count() == 40
    assert [row._offset for row in plan.orderBy("_offset").limit(3).collect()] == [0, 1, 3]


def test_names_with_numbers_of_unlike_length(spark, tmp_path):
    for n, name in enumerate(["part-9", "part-99999", "part-100000", "part-100001-a2", "x"]):
        part = tmp_path / "parts" / f"{name}.parquet"
        part.parent.mkdir(exist_ok=True)
        pandas.DataFrame({"n": [2 * n, 2 * n + 1]}).to_parquet(part)
    rows = read_ordered(spark, f"{tmp_path}/parts").orderBy("seq").collect()
    assert [tuple(row) for row in rows] == [(n, n) for n in range(10)]
    given = [f"{tmp_path}/parts/part-99999.parquet", f"{tmp_path}/parts/part-9.parquet"]
    assert [row.n for row in read_ordered(spark, given).orderBy("seq").collect()] == [2, 3, 0, 1]
    assert [row.n for row in read_first(spark, given, 3).orderBy("seq").collect()] == [2, 3, 0]


def test_no_exchange_carries_the_rows(spark, many_files):
    plan = read_ordered(spark, many_files)._jdf.queryExecution().executedPlan().toString()
    for exchange in re.findall(r"(?:Broadcast)?Exchange .*\n.*", plan):
        assert "other" not in exchange
    assert "SortMergeJoin" not in plan


def test_json_source_with_broken_records(spark, tmp_path):
    good = {"seq": 1, "question": "a question here", "response": "a response long enough",
            "id": 9}
    lines = [json.dumps(good), '{"seq": 2, "question": "a qu', "nonsense",
             json.dumps({**good, "seq": 3, "response": None}), json.dumps([good]),
             json.dumps({**good, "seq": None}), json.dumps({**good, "seq": "no number"})]
    (tmp_path / "pairs.jsonl").write_text("\n".join(lines))
    pairs = read_json_pairs(spark, str(tmp_path))
    reasons = sorted(row.drop_reason for row in label_rows(pairs).collect())
    assert reasons == ["empty"] + 5 * ["other"] + ["valid"]
    seen = Observation()
    selected = select_rows(pairs, sampling=Sampling(hash_prob=1.0), observation=seen)
    assert [row.id for row in selected.collect()] == ["9"]
    assert (seen.get["dropped_other"], seen.get["selected_rows"]) == (5, 1)
    assert "_corrupt_record" not in selected.columns


@pytest.mark.parametrize(("value", "text", "literal"), [
    (0, "", "0"), (0.0, "", "0.0"), (7, "7", "7"), (1.5, "1.5", "1.5"), (False, "", "False"),
    (True, "True", "True"), (None, "", "None"), ("0", "0", "0"), ("", "", ""), ("null", "null", "null"),
    (-12345678901234567890, "-12345678901234567890", "-12345678901234567890"), (..., "", ""),
])
def test_json_values_become_text(spark, tmp_path, value, text, literal):
    fields = ("question", "response", "system_prompt", "id")
    record = {"seq": 1} | ({} if value is ... else dict.fromkeys(fields, value))
    (tmp_path / "pairs.jsonl").write_text(json.dumps(record))
    pairs = read_json_pairs(spark, str(tmp_path))
    rows = pairs.select(text_field(pairs, "question"), text_field(pairs, "response"))
    assert tuple(rows.first()) == (text, text)
    rows = pairs.select(literal_field(pairs, "system_prompt"), literal_field(pairs, "id"))
    assert tuple(rows.first()) == (literal, literal)


def test_spread(spark):
    one = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    assert spread(one, None) is one
    assert spread(one, 5).rdd.getNumPartitions() == 5
    assert spread(one, 5).count() == 1_000
    spark.conf.set(PIECES_SETTING, "3")
    try:
        assert fixtures.document_pairs(spark, MIDDLE).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(PIECES_SETTING)


def _lines(folder):
    files = sorted(Path(folder).glob("part-*"))
    return [json.loads(line) for file in files for line in file.read_text("utf-8").splitlines()]


@pytest.mark.parametrize("dedup", [False, True])
@pytest.mark.parametrize("in_order", [False, True])
def test_prepared_dataset(spark, tmp_path, dedup, in_order):
    pairs = fixtures.document_pairs(spark, MIDDLE)
    half = Sampling(hash_prob=0.5)
    result = prepare_dataset(
        pairs, f"{tmp_path}/data", "cleaned", f"{tmp_path}/stats", sampling=half, dedup=dedup,
        ordered=in_order, demo_dir=f"{tmp_path}/demo", demo_rows=50,
    )
    written = _lines(result.dataset)
    expected = [
        {name: value for name, value in row.asDict().items() if name != "seq"}
        for row in clean_records(pairs, sampling=half, dedup=dedup).orderBy("seq").collect()
    ]
    by_id = lambda record: int(record["source_id"])
    assert (written if in_order else sorted(written, key=by_id)) == expected
    assert list(written[0]) == ["instruction", "input", "output", "system", "history",
                                "source_id"]
    assert result.demo == f"{tmp_path}/demo/cleaned_demo"
    assert _lines(result.demo) == expected[:50]
    assert result.selected is None

    kept = 387 if dedup else 408
    assert result.counts["kept_rows"] == kept == len(written)
    [report] = _lines(f"{tmp_path}/stats")
    assert report["cleaning_config"] == CleaningRules().as_dict()
    assert report["stats"] == {
        "source_rows_requested": 1_000_000, "source_revision": "e9c87b4", "seen_rows": 1_000,
        "kept_rows": kept, "selected_rows": 408, "not_sampled_rows": 403, "dropped_empty": 21,
        "dropped_length": 129, "dropped_char_run": 20, "dropped_repetition": 19,
        "dropped_dedup": 408 - kept, "dropped_other": 0,
    }
    columns = {"prompt": "instruction", "query": "input", "response": "output",
               "system": "system", "history": "history"}
    for folder, name in (("data", "cleaned"), ("demo", "cleaned_demo")):
        info = Path(tmp_path, folder, "dataset_info.json").read_text("utf-8")
        assert json.loads(info) == {"cleaned": {"file_name": name, "columns": columns}}


def test_demo_and_dataset_share_a_folder(spark, tmp_path):
    pairs = fixtures.document_pairs(spark, MIDDLE)
    result = prepare_dataset(
        pairs, str(tmp_path), "x", sampling=Sampling(hash_prob=1.0), dedup=True,
        demo_dir=f"{tmp_path}/", demo_rows=50, keep_selected=True,
    )
    assert len(_lines(result.dataset)) == result.counts["kept_rows"]
    assert _lines(result.demo) == _lines(result.dataset)[:50]
    assert spark.read.parquet(result.selected).count() == result.counts["selected_rows"]
    names = [json.loads(Path(tmp_path, file).read_text("utf-8"))["x"]["file_name"]
             for file in ("dataset_info.json", "demo_dataset_info.json")]
    assert names == ["x", "x_demo"]


@pytest.mark.parametrize("targets", [
    {"demo_dir": "{}", "demo_name": "x"},
    {"stats_path": "{}/x"},
    {"stats_path": "{}/x/stats"},
    {"demo_dir": "{}", "demo_name": "d", "stats_path": "{}/d"},
])
def test_equal_targets_are_refused_before_anything_is_written(spark, tmp_path, targets):
    pairs = fixtures.document_pairs(spark, MIDDLE)
    with pytest.raises(ValueError):
        prepare_dataset(pairs, str(tmp_path), "x",
                        **{name: value.format(tmp_path) for name, value in targets.items()})
    assert list(tmp_path.iterdir()) == []


def test_plain_run_writes_no_table_between(spark, tmp_path):
    pairs = fixtures.document_pairs(spark, MIDDLE)
    result = prepare_dataset(pairs, str(tmp_path), "x", f"{tmp_path}/stats", ordered=False)
    assert result.selected is None
    assert result.counts["seen_rows"] == 1_000
    assert len(_lines(result.dataset)) == result.counts["kept_rows"] == 203


def test_retried_tasks_change_nothing(spark, tmp_path):
    pairs = fixtures.document_pairs(spark, MIDDLE).repartition(6, "seq")

    def break_down_once(batches):
        task = TaskContext.get()
        yield from batches
        if task.partitionId() % 2 and task.attemptNumber() == 0:
            raise RuntimeError("lost after all of its rows")

    flaky = pairs.mapInPandas(break_down_once, pairs.schema)
    result = prepare_dataset(
        flaky, str(tmp_path), "x", sampling=Sampling(hash_prob=0.5), dedup=True
    )
    assert result.counts == {
        "seen_rows": 1_000, "selected_rows": 408, "not_sampled_rows": 403, "kept_rows": 387,
        "dropped_empty": 21, "dropped_length": 129, "dropped_char_run": 20,
        "dropped_repetition": 19, "dropped_other": 0, "dropped_dedup": 21,
    }
    assert len(_lines(result.dataset)) == 387


def test_text_beyond_ascii_is_written_raw(spark, tmp_path):
    pairs = spark.createDataFrame(
        [(1, "question \N{LATIN SMALL LETTER E WITH ACUTE}\u4e2d\U0001f600", "a response \N{LATIN SMALL LETTER E WITH ACUTE}\u4e2d long enough", "s", "1")],
        "seq bigint, question string, response string, system_prompt string, id string",
    )
    result = prepare_dataset(pairs, str(tmp_path), "x", sampling=Sampling(hash_prob=1.0))
    [part] = Path(result.dataset).glob("part-*")
    assert "\N{LATIN SMALL LETTER E WITH ACUTE}\u4e2d\U0001f600" in part.read_text("utf-8")


def test_nothing_selected(spark, tmp_path):
    pairs = fixtures.document_pairs(spark, MIDDLE).where("seq < 0")
    result = prepare_dataset(pairs, str(tmp_path), "x", dedup=True, demo_dir=f"{tmp_path}/demo")
    assert result.counts["seen_rows"] == result.counts["kept_rows"] == 0
    assert _lines(result.dataset) == []
