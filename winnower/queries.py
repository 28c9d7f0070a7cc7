"""Registered queries: every operator over whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnower import fixed_values as fixed
from winnower import fixtures
from winnower.config import CleaningRules, Sampling
from winnower.functions.garbled import garbled_share
from winnower.functions.hashing import content_key, score_hex, score_value
from winnower.functions.metrics import score_text
from winnower.functions.records import RECORD_COLUMNS, instruction_records, record_json
from winnower.functions.text import (
    has_char_run,
    text_field,
    text_length,
    token_count,
    top_token_share,
)
from winnower.operators.cleaning import (
    drop_failing,
    fails_char_run,
    fails_empty,
    fails_length,
    fails_repetition,
    garbled_check,
    label_rows,
    with_normalised,
)
from winnower.operators.compare import compare_many, compare_runs, resolve_scores
from winnower.operators.dedup import first_kept, keep_first, keep_first_in_order
from winnower.operators.near_duplicates import near_duplicate_classes
from winnower.operators.roles import role_check
from winnower.operators.selection import decide_rows, select_rows
from winnower.operators.tally import drop_waterfall as waterfall
from winnower.operators.tally import stats_counts, stats_report
from winnower.plans.prepare import clean_records as cleaned
from winnower.plans.prepare import prepare_dataset
from winnower.plans.publish import publish_dataset, read_published
from winnower.sinks.comparison import markdown_table, write_csv
from winnower.sinks.dataset import DEMO_MANIFEST_FILE, MANIFEST_FILE
from winnower.sources.json_pairs import read_json_pairs
from winnower.sources.numbered_lines import read_numbered_lines
from winnower.sources.ordered import read_first, read_ordered
from winnower.sources.results import read_results
from winnower.sources.snapshot import pin_snapshot, read_pinned
from winnower.storage import shared_folder, written
from winnower.streaming.clean import ProgressLog, start_clean_stream
from winnower.streaming.first_copies import FirstCopies, start_first_copy_stream
from winnower.streaming.progress import PushedProgress, next_batch

RULES = CleaningRules()
QUARTER = Sampling(hash_prob=0.25)
EVERYTHING = Sampling(hash_prob=1.0)
FIRST_ROWS = 333
STREAM_FILES = 6
STREAM_FILE_ROWS = 10_000
STREAM_TRIGGERS = 4
SCAN_FILES = 40
JSON_FILES = 12
BASELINE, CANDIDATE = "src0", "src1"


def _normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_normalised(fixtures.document_pairs(spark, sf_dir))


def _flat_history(records: DataFrame) -> DataFrame:
    """The empty history as JSON text, which other engines can compare."""
    return records.withColumn("history", F.to_json("history"))


# Projections


def coerce_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fixtures.document_pairs(spark, sf_dir)
    return pairs.select(
        "seq",
        text_field(pairs, "question").alias("question"),
        text_field(pairs, "response").alias("response"),
        text_field(pairs, "system_prompt").alias("system_prompt"),
        text_field(pairs, "seq").alias("seq_text"),
        text_field(pairs, "absent").alias("absent"),
    )


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalised(spark, sf_dir).select("seq", "q", "r")


def text_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalised(spark, sf_dir).select(
        "seq", text_length(F.col("q")).alias("q_chars"), text_length(F.col("r")).alias("r_chars")
    )


def char_run_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = RULES.drop_if_char_run_ge
    return _normalised(spark, sf_dir).select(
        "seq",
        has_char_run(F.col("q"), run).alias("q_run"),
        has_char_run(F.col("r"), run).alias("r_run"),
    )


def token_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalised(spark, sf_dir).select(
        "seq",
        token_count(F.col("r")).alias("n_tokens"),
        top_token_share(F.col("r")).alias("top_share"),
    )


def content_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.lower(F.hex(content_key(F.col("q"), F.col("r"))))
    return _normalised(spark, sf_dir).select("seq", key.alias("content_key"))


def hash_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _normalised(spark, sf_dir).select(
        "seq", score_hex(content_key(F.col("q"), F.col("r")), QUARTER.seed).alias("score_hex")
    )
    return scored.withColumn("score", score_value(F.col("score_hex")))


# Filters and labels


def _passing(spark: SparkSession, sf_dir: str, rule: str, fails: Column) -> DataFrame:
    rows = _normalised(spark, sf_dir).select("seq", "q", "r")
    return drop_failing(rows, rule, fails).select("seq")


def empty_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _passing(spark, sf_dir, "empty", fails_empty(F.col("q"), F.col("r")))


def length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _passing(spark, sf_dir, "length", fails_length(F.col("q"), F.col("r"), RULES))


def char_run_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _passing(spark, sf_dir, "char_run", fails_char_run(F.col("q"), F.col("r"), RULES))


def repetition_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _passing(spark, sf_dir, "repetition", fails_repetition(F.col("r"), RULES))


def drop_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_rows(fixtures.document_pairs(spark, sf_dir), RULES).select("seq", "drop_reason")


def drop_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return waterfall(label_rows(fixtures.document_pairs(spark, sf_dir), RULES))


def bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop reasons of pairs read from JSON Lines that are partly broken."""
    lines = shared_folder(spark, "bad-records")
    pairs = fixtures.document_pairs(spark, sf_dir)
    fixtures.json_lines_of_pairs(pairs).write.text(lines)
    return waterfall(label_rows(read_json_pairs(spark, lines), RULES))


# Selection and deduplication


def _garbled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.garbled_pairs(fixtures.document_pairs(spark, sf_dir))


def garbled_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of bad characters and surprise of letter pairs of every response."""
    pairs = _garbled(spark, sf_dir)
    model = garbled_check(pairs).model
    return with_normalised(pairs).select(
        "seq",
        garbled_share(F.col("r")).alias("bad_share"),
        model.surprise(F.col("r")).alias("millibits"),
    )


def garbled_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _garbled(spark, sf_dir)
    rows = with_normalised(pairs).select("seq", "q", "r")
    return drop_failing(rows, "garbled", garbled_check(pairs).fails(F.col("r"))).select("seq")


def garbled_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop counts with the garbled rule switched on."""
    pairs = _garbled(spark, sf_dir)
    return waterfall(label_rows(pairs, RULES, garbled_check(pairs)))


def near_duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every pair by its five-word shingles, and whether it is the first of its class."""
    text = F.trim(F.concat_ws(" ", F.lower("q"), F.lower("r")))
    found = near_duplicate_classes(_normalised(spark, sf_dir).select("seq", "q", "r"), text)
    return found.select(
        F.col("id").alias("seq"), "class_id", (F.col("id") == F.col("class_id")).alias("is_first")
    )


def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fixtures.document_pairs(spark, sf_dir).select("seq", "question", "response")
    return select_rows(pairs, RULES, QUARTER, count_all=False).select("seq")


def max_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selection by a wanted number of rows, which gives a probability of a half."""
    pairs = fixtures.document_pairs(spark, sf_dir).select("seq", "question", "response")
    half = Sampling(max_samples=fixed.SOURCE_ROWS // 2)
    return select_rows(pairs, RULES, half, count_all=False).select("seq")


def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = fixtures.document_pairs(spark, sf_dir).select("seq", "question", "response")
    kept = keep_first(select_rows(pairs, RULES, EVERYTHING).select("seq", "key"))
    return kept.select("seq", F.lower(F.hex("key")).alias("content_key"))


def dedup_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors in source order, from a written table of selected rows."""
    folder = shared_folder(spark, "selected")
    pairs = fixtures.document_pairs(spark, sf_dir)
    select_rows(pairs, RULES, QUARTER, count_all=False).write.parquet(folder)
    return keep_first_in_order(spark.read.parquet(folder)).select("seq", "q", "r")


# Records


def records_of_valid_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = select_rows(fixtures.document_pairs(spark, sf_dir), RULES, EVERYTHING)
    return _flat_history(instruction_records(selected, keep=("seq",)))


def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: clean, sample a quarter, keep first copies, project records."""
    pairs = fixtures.document_pairs(spark, sf_dir)
    return _flat_history(cleaned(pairs, RULES, QUARTER, dedup=True))


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = cleaned(fixtures.document_pairs(spark, sf_dir), RULES, QUARTER)
    return records.select("seq", record_json().alias("line"))


def demo_200(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = select_rows(fixtures.document_pairs(spark, sf_dir), RULES, EVERYTHING)
    head = first_kept(written(spark, selected, "selected"), fixed.DEMO_ROWS)
    return _flat_history(instruction_records(head, keep=("seq",)))


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an end-to-end run wrote, read back."""
    prepared = prepare_dataset(
        fixtures.document_pairs(spark, sf_dir),
        shared_folder(spark, "dataset"),
        "instructions",
        rules=RULES,
        sampling=QUARTER,
        dedup=True,
    )
    schema = ", ".join(
        f"{name} {'array<array<string>>' if name == 'history' else 'string'}"
        for name in RECORD_COLUMNS
    )
    return _flat_history(spark.read.schema(schema).json(prepared.dataset))


def published_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a version that was published over an older one, read by the manifest."""
    folder = shared_folder(spark, "published")
    pairs = fixtures.document_pairs(spark, sf_dir)
    for sampling in (EVERYTHING, QUARTER):
        publish_dataset(pairs, folder, "instructions", rules=RULES, sampling=sampling, dedup=True)
    return _flat_history(read_published(spark, folder, "instructions"))


def cleaning_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds and counters of the flagship run in one row."""
    pairs = fixtures.document_pairs(spark, sf_dir).select("question", "response")
    counts = stats_counts(decide_rows(pairs, RULES, QUARTER), dedup=True)
    return stats_report(counts, RULES).select("cleaning_config.*", "stats.*")


def stats_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics file of an end-to-end run, read back."""
    folder = shared_folder(spark, "stats")
    prepare_dataset(
        fixtures.document_pairs(spark, sf_dir),
        f"{folder}/data",
        "instructions",
        f"{folder}/stats",
        rules=RULES,
        sampling=QUARTER,
        dedup=True,
        ordered=False,
    )
    counts = stats_counts(decide_rows(fixtures.document_pairs(spark, sf_dir)), dedup=True)
    schema = stats_report(counts, RULES).schema
    return spark.read.schema(schema).json(f"{folder}/stats").select("cleaning_config.*", "stats.*")


# Ordered scans


def source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ordered(spark, f"{sf_dir}/documents.parquet", ["doc_id", "source"])


def first_n_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_first(spark, f"{sf_dir}/documents.parquet", FIRST_ROWS, ["doc_id", "text"])


def source_scan_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers over many uneven files, whose order is that of doc_id."""
    folder = shared_folder(spark, "many-files")
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", "source")
    _uneven(documents, SCAN_FILES).write.partitionBy("part").parquet(folder)
    return read_ordered(spark, folder, ["doc_id", "source"])


def _uneven(rows: DataFrame, files: int) -> DataFrame:
    """The rows in so many folders of uneven size, in order of doc_id over folders and files."""
    last = rows.agg(F.max("doc_id")).first()[0] or 0
    part = F.floor(F.sqrt(F.col("doc_id") / F.lit(last + 1)) * files)
    parts = rows.withColumn("part", F.lpad(part.cast("string"), 3, "0"))
    # By ranges, as a hash would bring all of a folder to one task, and several to some.
    return parts.repartitionByRange("doc_id").sortWithinPartitions("part", "doc_id")


def source_scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers of JSON Lines without a field for them, over uneven files."""
    folder = shared_folder(spark, "json-lines")
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    line = F.to_json(F.struct("doc_id", "source", "text")).alias("value")
    lines = _uneven(documents, JSON_FILES).select(line, "part")
    lines.write.partitionBy("part").text(folder)
    record = F.from_json("value", "doc_id bigint, source string").alias("record")
    return read_numbered_lines(spark, folder).select("seq", record).select("seq", "record.*")


def pinned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers from the manifest of a snapshot that was checked before."""
    folder, manifest = shared_folder(spark, "pinned"), shared_folder(spark, "manifest")
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", "source")
    _uneven(documents, SCAN_FILES).write.partitionBy("part").parquet(folder)
    pin_snapshot(spark, folder, manifest)
    return read_pinned(spark, folder, manifest, ["doc_id", "source"])


def prepare_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main path as a whole: first rows of many files, prepared in order, with all sinks.

    Returns the lines of the dataset with their place, and the demo's.
    """
    folder, source = shared_folder(spark, "first-n"), shared_folder(spark, "first-n-source")
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    documents.repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id").write.parquet(source)
    first = read_first(spark, source, FIRST_ROWS, ["doc_id", "text", "lang"])
    prepared = prepare_dataset(
        fixtures.pairs_of_documents(first.drop("seq")),
        folder,
        "instructions",
        f"{folder}/stats",
        rules=RULES,
        sampling=EVERYTHING,
        dedup=True,
        demo_dir=folder,
        demo_rows=20,
    )
    lines = [
        _written_lines(spark, path).withColumn("file", F.lit(name))
        for path, name in ((prepared.dataset, "dataset"), (prepared.demo, "demo"))
    ]
    return lines[0].unionByName(lines[1])


def _written_lines(spark: SparkSession, path: str) -> DataFrame:
    """(place, source_id, instruction) of JSON Lines, numbered by part file and line."""
    rows = spark.read.schema("source_id string, instruction string").json(path)
    part = F.regexp_extract(F.col("_metadata.file_path"), r"part-(\d+)", 1).cast("long")
    numbered = rows.withColumn("_line", F.monotonically_increasing_id()).withColumn("_part", part)
    order = Window.orderBy("_part", "_line")
    return numbered.select(
        (F.row_number().over(order) - 1).cast("long").alias("place"), "source_id", "instruction"
    )


def written_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each line of an ordered dataset, by part file and line."""
    prepared = prepare_dataset(
        fixtures.document_pairs(spark, sf_dir),
        shared_folder(spark, "dataset"),
        "instructions",
        rules=RULES,
        sampling=QUARTER,
        dedup=True,
    )
    return _written_lines(spark, prepared.dataset)


def demo_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demo of a run, read back from the folder that it shares with the dataset."""
    folder = shared_folder(spark, "dataset")
    prepared = prepare_dataset(
        fixtures.document_pairs(spark, sf_dir),
        folder,
        "instructions",
        rules=RULES,
        sampling=QUARTER,
        dedup=True,
        demo_dir=folder,
    )
    return _written_lines(spark, prepared.demo)


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of a dataset and its demo, a row for each column that they name."""
    folder = shared_folder(spark, "dataset")
    pairs = fixtures.document_pairs(spark, sf_dir)
    prepare_dataset(pairs, folder, "instructions", sampling=QUARTER, demo_dir=folder)
    schema = "map<string,struct<file_name:string,columns:map<string,string>>>"
    files = spark.read.text(
        [f"{folder}/{name}" for name in (MANIFEST_FILE, DEMO_MANIFEST_FILE)], wholetext=True
    )
    named = files.select(F.explode(F.from_json("value", schema)).alias("dataset", "info"))
    return named.select(
        "dataset", "info.file_name", F.explode("info.columns").alias("name", "field")
    )


# Evaluation results


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_scores(fixtures.evaluation_results(spark, sf_dir))


def metric_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir)


def result_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of result files, written one per run and task, and read by name."""
    folder = shared_folder(spark, "results")
    name = F.format_string("%s_%dshot.json", "task", "fewshot")
    results = fixtures.evaluation_results(spark, sf_dir)
    results.select("value", "run", name.alias("file")).write.partitionBy("run", "file").text(folder)
    return resolve_scores(read_results(spark, folder))


def metric_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_runs(_scores(spark, sf_dir), BASELINE, CANDIDATE)


def metric_compare_many_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_many(_scores(spark, sf_dir), BASELINE)


def metric_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown_table(metric_compare(spark, sf_dir))


def metric_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["base_score", "sft_score", "delta"]
    return compare_many(_scores(spark, sf_dir), BASELINE).select(
        "run", "task", *[score_text(F.col(name)).alias(name) for name in columns]
    )


def metric_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The many-run comparison, written as CSV and read back."""
    folder = shared_folder(spark, "comparison")
    write_csv(compare_many(_scores(spark, sf_dir), BASELINE), folder)
    schema = (
        "run string, task string, fewshot int, metric string,"
        " base_score double, sft_score double, delta double"
    )
    return spark.read.schema(schema).option("header", True).csv(folder)


# Conversations


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.conversation_pairs(spark, sf_dir)


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = select_rows(fixtures.conversation_pairs(spark, sf_dir), RULES, EVERYTHING)
    records = instruction_records(selected, keep=("conv_id", "turn"))
    return _flat_history(records)


def role_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First fault in the order of roles of every conversation."""
    return role_check(fixtures.faulty_turns(spark, sf_dir))


# Streaming


def _document_stream(spark: SparkSession, sf_dir: str, files: int = 2) -> DataFrame:
    """Pairs of all documents from a source of ``STREAM_FILES`` parts, so many for each trigger.

    A part of a large table is several files, so that all tasks write and read it.
    """
    folder = shared_folder(spark, "stream-source")
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    pieces = math.ceil(documents.count() / STREAM_FILES / STREAM_FILE_ROWS) or 1
    documents.repartition(STREAM_FILES * pieces, "doc_id").write.parquet(folder)
    found = len(spark.read.schema(documents.schema).parquet(folder).inputFiles())
    each = math.ceil(found * files / STREAM_FILES)
    reader = spark.readStream.schema(documents.schema).option("maxFilesPerTrigger", each)
    return fixtures.pairs_of_documents(reader.parquet(folder))


def _state_tasks(spark: SparkSession) -> int:
    """Two tasks for each core, but no more than other shuffles have."""
    cores = spark.sparkContext.defaultParallelism
    return min(2 * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case-blind content that a deduplicating stream over all documents wrote.

    Which copy survives depends on processing order, so the texts are compared
    in lower case.
    """
    output = shared_folder(spark, "stream")
    start_clean_stream(
        _document_stream(spark, sf_dir),
        output,
        shared_folder(spark, "stream-state"),
        RULES,
        EVERYTHING,
        dedup=True,
        salt_column="seq",
        state_tasks=_state_tasks(spark),
    ).awaitTermination()
    texts = spark.read.schema("instruction string, output string").json(output)
    return texts.select(F.lower("instruction").alias("q"), F.lower("output").alias("r"))


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that a deduplicating stream over all documents reported while it ran."""
    query = start_clean_stream(
        _document_stream(spark, sf_dir),
        shared_folder(spark, "stream"),
        shared_folder(spark, "stream-state"),
        RULES,
        QUARTER,
        dedup=True,
        salt_column="seq",
        state_tasks=_state_tasks(spark),
    )
    log = ProgressLog(query, QUARTER)
    log.follow()
    schema = ", ".join(f"{name} bigint" for name in log.counts)
    counts = spark.createDataFrame([tuple(log.counts.values())], schema)
    return counts.withColumn("p", F.lit(log.p))


def stream_progress_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the same stream as Spark pushed them, one file for each trigger."""
    progress, state = PushedProgress(), shared_folder(spark, "stream-state")
    first = next_batch(spark, state)
    spark.streams.addListener(progress)
    try:
        query = start_clean_stream(
            _document_stream(spark, sf_dir, files=1),
            shared_folder(spark, "stream"),
            state,
            RULES,
            QUARTER,
            dedup=True,
            salt_column="seq",
            state_tasks=_state_tasks(spark),
        )
        progress.expect(query, first)
        query.awaitTermination()
        report = progress.report(query, QUARTER)
    finally:
        spark.streams.removeListener(progress)
    counts = {name: value for name, value in report.items() if isinstance(value, int)}
    schema = ", ".join(f"{name} bigint" for name in counts)
    rows = spark.createDataFrame([tuple(counts.values())], schema)
    return rows.withColumn("p", F.lit(report["p"]))


def stream_first_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First copies that a stream kept over several triggers, of which the last one ran twice."""
    source = shared_folder(spark, "stream-source")
    documents = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    last = documents.agg(F.max("doc_id")).first()[0] or 0
    reader = spark.readStream.schema(documents.schema)
    copies = FirstCopies(shared_folder(spark, "first-copies"), RULES, EVERYTHING, keep=("seq",))
    state = shared_folder(spark, "stream-state")
    # All tasks write a part, in files of no order; the stream takes them in one trigger.
    for part in range(STREAM_TRIGGERS):
        bounds = (last + 1) * part // STREAM_TRIGGERS, (last + 1) * (part + 1) // STREAM_TRIGGERS
        arrived = documents.filter(F.col("doc_id").between(bounds[0], bounds[1] - 1))
        arrived.write.mode("append").parquet(source)
        pairs = fixtures.pairs_of_documents(reader.parquet(source))
        start_first_copy_stream(pairs, copies, state).awaitTermination()
    rows = spark.read.schema(documents.schema).parquet(source)
    again = rows.filter(F.col("doc_id") >= (last + 1) * (STREAM_TRIGGERS - 1) // STREAM_TRIGGERS)
    copies(fixtures.pairs_of_documents(again), STREAM_TRIGGERS - 1)
    schema = "seq bigint, instruction string, output string"
    return spark.read.schema(schema).json(copies.records).select(
        "seq", F.col("instruction").alias("q"), F.col("output").alias("r")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "coerce_fields": coerce_fields,
    "normalize_text": normalize_text,
    "text_length": text_lengths,
    "char_run_flag": char_run_flag,
    "token_share": token_share,
    "empty_filter": empty_filter,
    "length_filter": length_filter,
    "char_run_filter": char_run_filter,
    "repetition_filter": repetition_filter,
    "garbled_share": garbled_shares,
    "garbled_filter": garbled_filter,
    "garbled_waterfall": garbled_waterfall,
    "near_duplicate_pairs": near_duplicate_pairs,
    "drop_reason": drop_reason,
    "drop_waterfall": drop_waterfall,
    "bad_records": bad_records,
    "content_key": content_keys,
    "hash_score": hash_score,
    "hash_sample": hash_sample,
    "max_samples": max_samples,
    "dedup_keep_first": dedup_keep_first,
    "dedup_in_order": dedup_in_order,
    "instruction_records": records_of_valid_pairs,
    "clean_records": clean_records,
    "json_records": json_records,
    "demo_200": demo_200,
    "demo_dataset": demo_dataset,
    "manifest": manifests,
    "jsonl_roundtrip": jsonl_roundtrip,
    "published_dataset": published_dataset,
    "written_order": written_order,
    "prepare_first_n": prepare_first_n,
    "cleaning_stats": cleaning_stats,
    "stats_roundtrip": stats_roundtrip,
    "source_scan": source_scan,
    "source_scan_many_files": source_scan_many_files,
    "source_scan_json": source_scan_json,
    "pinned_scan": pinned_scan,
    "first_n_rows": first_n_rows,
    "metric_resolve": metric_resolve,
    "result_files": result_files,
    "metric_compare": metric_compare,
    "metric_compare_many_runs": metric_compare_many_runs,
    "metric_markdown": metric_markdown,
    "metric_format": metric_format,
    "metric_csv": metric_csv,
    "conversation_pairs": conversation_pairs,
    "conversation_records": conversation_records,
    "role_check": role_checks,
    "stream_clean": stream_clean,
    "stream_progress": stream_progress,
    "stream_progress_pushed": stream_progress_pushed,
    "stream_first_copy": stream_first_copy,
}
