"""Inputs for the registered queries, derived from whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnower import fixed_values as fixed
from winnower.sources.spread import PIECES_SETTING, spread

_SALTS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs_of_documents(documents: DataFrame) -> DataFrame:
    """Question/response pairs of all documents, with faults spread over them.

    A question is a document's first sentence, or all of it for one in eleven.
    The documents themselves never trip the empty and character-run rules, so
    some questions are made NULL or blank, and some texts get a long run.
    """
    doc_id, text = F.col("doc_id"), F.col("text")
    first_sentence = F.substring_index(text, ".", 1)
    question = (
        F.when(doc_id % 97 == 5, F.lit(None).cast("string"))
        .when(doc_id % 101 == 7, F.lit("  \t"))
        .when(doc_id % 107 == 3, F.concat(first_sentence, F.lit("y" * 130)))
        .when(doc_id % 11 == 2, text)
        .otherwise(first_sentence)
    )
    response = F.when(doc_id % 103 == 9, F.concat(text, F.lit("z" * 130))).otherwise(text)
    return documents.select(
        doc_id.alias("seq"),
        question.alias("question"),
        response.alias("response"),
        F.when(doc_id % 3 != 0, F.concat(F.lit("lang "), F.col("lang"))).alias("system_prompt"),
        doc_id.cast("string").alias("id"),
    )


def document_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of all documents, dealt to as many tasks as the session asks for, if it does."""
    pieces = spark.conf.get(PIECES_SETTING, None)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return pairs_of_documents(spread(documents, int(pieces) if pieces else None))


_SWAPPED = "aeiounrst", "qxzjkwvyq"


def garbled_pairs(pairs: DataFrame) -> DataFrame:
    """The pairs with some responses garbled: letters lost, or swapped for others."""
    seq, response = F.col("seq"), F.col("response")
    garbled = (
        F.when(seq % 53 == 11, F.replace(response, F.lit("e"), F.lit("\ufffd")))
        .when(seq % 59 == 13, F.translate(response, *_SWAPPED))
        .otherwise(response)
    )
    return pairs.withColumn("response", garbled)


def faulty_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns, some of them in a wrong role, an unknown one or none."""
    place = F.col("conv_id") * 7 + F.col("turn")
    role = (
        F.when(place % 23 == 4, "system")
        .when(place % 29 == 5, F.lit(None).cast("string"))
        .when(place % 31 == 6, "bot")
        .when(place % 19 == 3, "assistant")
        .otherwise(F.col("role"))
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", role.alias("role"))


def json_lines_of_pairs(pairs: DataFrame) -> DataFrame:
    """The pairs as lines of JSON, of which some are cut short."""
    line = F.to_json(F.struct("seq", "question", "response", "system_prompt", "id"))
    return pairs.select(
        F.when(F.col("seq") % 89 == 3, F.left(line, F.lit(20))).otherwise(line).alias("value")
    )


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn with the assistant turn right after it.

    Joined on unique ``(conv_id, turn)`` keys rather than by a window over the
    conversation, so one huge conversation still spreads over all tasks. The
    system prompt is the first system turn of the conversation, if earlier; its
    narrow row is joined by a salt as well, for the same reason.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("question"), (F.col("turn") + 1).alias("_next")
    )
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", F.col("turn").alias("_next"), F.col("text").alias("response")
    )
    system = (
        turns.where(F.col("role") == "system")
        .groupBy("conv_id")
        .agg(F.min("turn").alias("_since"), F.min_by("text", "turn").alias("_system"))
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt")
    pairs = (
        asked.join(answered, ["conv_id", "_next"])
        .withColumn("_salt", F.pmod(F.xxhash64("turn"), F.lit(_SALTS)).cast("int"))
        .join(system.select("*", salts), ["conv_id", "_salt"], "left")
    )
    return pairs.select(
        "conv_id",
        "turn",
        "question",
        "response",
        F.when(F.col("_since") < F.col("turn"), F.col("_system")).alias("system_prompt"),
        F.concat_ws("-", "conv_id", "turn").alias("id"),
    )


def _result_json(nested: Column) -> Column:
    """Result file of one run and task, either per task or flat."""
    metrics = F.struct(
        F.col("task").alias("alias"),
        F.lit("N/A").alias("acc_stderr,none"),
        F.col("f1").alias("f1,none"),
        F.col("acc_norm").alias("acc_norm,none"),
        F.col("acc").alias("acc,none"),
    )
    flat = F.to_json(F.struct(metrics.alias("results")))
    by_task = F.to_json(F.struct(F.create_map("task", metrics).alias("results")))
    return F.when(nested, by_task).otherwise(flat)


def evaluation_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result files ``(run, task, fewshot, value)`` made of labelled documents.

    Each source is a run and each document belongs to one of the report tasks;
    the metrics are averages of its labels and lengths. A run without labelled
    documents for a task has no file for it.
    """
    names = F.lit([task for task, _ in fixed.TASKS])
    shots = F.lit([fewshot for _, fewshot in fixed.TASKS])
    slot = (F.col("doc_id") % len(fixed.TASKS)).cast("int")
    labelled = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").join(
        table(spark, sf_dir, "labels"), "doc_id"
    )
    averages = (
        labelled.groupBy(F.col("source").alias("run"), slot.alias("slot"))
        .agg(
            F.avg("quality").alias("acc"),
            F.avg("toxic").alias("acc_norm"),
            F.avg("n_chars").alias("f1"),
        )
        .withColumns({"task": F.get(names, "slot"), "fewshot": F.get(shots, "slot")})
    )
    return averages.select(
        "run", "task", "fewshot", _result_json(F.col("slot") % 2 == 0).alias("value")
    )
