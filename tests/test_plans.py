"""Properties of the physical plans that results alone would not show."""

from __future__ import annotations

import re

import pytest

from winnower import fixtures
from winnower.operators.cleaning import label_rows
from winnower.operators.compare import compare_many, compare_runs, resolve_scores, run_scores
from winnower.operators.tally import drop_waterfall
from winnower.plans.prepare import clean_records
from winnower.queries import QUERIES
from winnower.streaming.clean import stream_select

MIDDLE = "/root/testdata/sf0.01"
WRITING = {"bad_records", "jsonl_roundtrip", "metric_csv", "stream_clean", "stats_roundtrip",
           "stream_progress", "result_files", "dedup_in_order", "demo_dataset", "manifest",
           "written_order", "prepare_first_n", "source_scan_many_files"}


def plan_of(spark, frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", "1000000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    yield
    spark.conf.unset("spark.sql.maxPlanStringLength")
    spark.conf.unset("spark.sql.debug.maxToStringFields")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_and_no_all_pairs(spark, name):
    plan = plan_of(spark, QUERIES[name](spark, MIDDLE))
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize(
    ("name", "times"),
    [("normalize_text", 2), ("length_filter", 2), ("char_run_filter", 2), ("drop_reason", 2),
     ("drop_waterfall", 2), ("hash_sample", 2), ("dedup_keep_first", 2), ("clean_records", 3),
     ("cleaning_stats", 2)],
)
def test_each_text_is_normalised_once(spark, name, times):
    plan = plan_of(spark, QUERIES[name](spark, MIDDLE))
    assert plan.count("regexp_replace") == times


def test_columns_are_pruned_at_the_scan(spark):
    pairs = fixtures.document_pairs(spark, MIDDLE)
    plan = plan_of(spark, drop_waterfall(label_rows(pairs)))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_one_shuffle_of_what_is_kept(spark):
    pairs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    pairs = fixtures.pairs_of_documents(pairs)
    assert plan_of(spark, clean_records(pairs)).count("Exchange ") == 0
    plan = plan_of(spark, clean_records(pairs, dedup=True))
    assert plan.count("Exchange hashpartitioning(key") == plan.count("Exchange ") == 1
    assert plan.count("WindowGroupLimit") == 2


def test_comparisons_read_the_results_once(spark, tmp_path):
    fixtures.evaluation_results(spark, MIDDLE).write.parquet(f"{tmp_path}/results")
    scores = resolve_scores(spark.read.parquet(f"{tmp_path}/results"))
    for frame, aggregates in ((compare_runs(scores, "src0", "src1"), 16), (run_scores(scores), 8)):
        plan = plan_of(spark, frame)
        assert plan.count("FileScan") == plan.count("Exchange ") == 1
        assert plan.count("partial_max") == aggregates
    plan = plan_of(spark, compare_many(scores, "src0"))
    assert "SortMergeJoin" not in plan and "partial_max" not in plan


def test_a_stream_shuffles_selected_rows_only(spark, tmp_path):
    fixtures.document_pairs(spark, MIDDLE).write.parquet(f"{tmp_path}/pairs")
    schema = spark.read.parquet(f"{tmp_path}/pairs").schema
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/pairs")
    query = (
        stream_select(stream, dedup=True, salt_column="seq").writeStream.format("noop")
        .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    plan = query._jsq.explainInternal(False) if hasattr(query._jsq, "explainInternal") else ""
    below = plan.split("Exchange hashpartitioning(key")[-1]
    assert "Exchange" in plan and "Exchange" not in below
    assert "decision" in below and "Filter" in below
