"""Quality rules: text counts and cross-document line frequency, in built-ins only.

A line that many documents of one host share is boilerplate. Lines are
normalised, hashed and counted once for each group of near copies in a host, so
copies of one page do not make all of its lines boilerplate: they are the business
of near-duplicate detection, which needs one of them left. Lines that reach the
limit are removed, whatever the size of the host, and a document that loses more
than half of its words is rejected.

A group of near copies is known by sketches of a text: for each of a dozen orders of
hashes, the six first ones of its lines, or half of them if they are fewer. Copies
that differ in a few lines agree in some sketch; the most frequent one that they
have, or that leads on from one they have, names the group. Texts that share a header or a footer rarely agree in so
many lines: of those that have half their lines in common about a sixth counts as
one, of those that have nine in ten nearly all.

Defined cases: a null text has no words and fails the base rules; a null host
is the host ""; repeated rows, also of one null doc_id, get equal results, one
each; a line without a word is never counted or removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower.storage import written

_WORD_CHARACTER = "[^ \\x09-\\x0D]"
_SYMBOL = "[#*$%&|<>]"
_SKETCHES = 12
_SKETCH_LINES = 6
_ODD_SPACES = "[\\t\\x0B\\f\\r][ \\t\\x0B\\f\\r]*| [ \\t\\x0B\\f\\r]+"  # one blank alone stays


@dataclass(frozen=True)
class QualityLimits:
    """A line is boilerplate at ``line_docs`` groups of near copies of one host."""

    min_words: int = 50
    max_repeat_percent: int = 50
    line_docs: int = 10
    min_left_percent: int = 50


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, "[ \\x09-\\x0D]+"), "")


def _word_lines(text: Column) -> Column:
    lines = F.split(text, "\n", -1)
    return F.filter(lines, lambda line: line.rlike(_WORD_CHARACTER))


def _normal_text(text: Column) -> Column:
    """Lower case, one blank for inner spaces, any digit as 0; line breaks stay."""
    digits = F.regexp_replace(F.lower(text), "[1-9]", "0")
    return F.regexp_replace(digits, _ODD_SPACES, " ")


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def with_text_counts(docs: DataFrame, text: Column) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Windows of three words are compared by a 64-bit hash, sorted within each
    text together with their positions; equal neighbours mark repeated windows.
    """
    whole = F.coalesce(text, F.lit(""))
    counted = docs.withColumn("_text", whole).withColumn("_words", _words(F.col("_text")))
    lines = counted.withColumn("_lines", _word_lines(F.col("_text"))).select(
        "*",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda word: F.xxhash64(word)).alias("_hashes"),
    )
    count = F.size("_hashes")
    pairs = F.zip_with("_hashes", F.slice("_hashes", 2, count), lambda a, b: F.xxhash64(a, b))
    triples = F.zip_with(pairs, F.slice("_hashes", 3, count), lambda a, b: F.xxhash64(a, b))
    windows = F.slice(triples, 1, F.greatest(count - 2, F.lit(0)))
    placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ordered = lines.drop("_text", "_words", "_lines").withColumn("_windows", F.sort_array(placed))
    equal = F.filter(
        F.zip_with(
            "_windows",
            F.slice("_windows", 2, F.size("_windows")),
            lambda a, b: F.when(a.h == b.h, F.struct(a.i.alias("a"), b.i.alias("b"))),
        ),
        lambda pair: pair.isNotNull(),
    )
    repeated = ordered.withColumn("_equal", equal).withColumn(
        "_starts", F.sort_array(F.concat(F.col("_equal.a"), F.col("_equal.b")))
    )
    new_words = F.zip_with(
        "_starts",
        F.slice("_starts", 2, F.size("_starts")),
        lambda here, following: F.coalesce(F.least(following - here, F.lit(3)), F.lit(3)),
    )
    covered = F.aggregate(new_words, F.lit(0), lambda total, n: total + n)
    return repeated.withColumn("n_repeat_words", covered.cast("long")).drop(
        "_hashes", "_windows", "_equal", "_starts"
    )


def _base_failed(limits: QualityLimits) -> Column:
    return (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")
    )


def _host_name(host: str) -> Column:
    return F.coalesce(F.col(host).cast("string"), F.lit(""))


def line_table(
    docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id"
) -> DataFrame:
    """(_id, _host, _text_hash, _lines, _sketches) of every document with a word, written.

    A line is its place, its hash and its words; no text leaves the first scan.
    """
    lines = F.transform(
        F.split(_normal_text(F.col(text)), "\n", -1),
        lambda line, i: F.struct(
            i.alias("_at"),
            _line_hash(line).alias("_line"),
            F.size(_words(line)).alias("_n"),
            F.md5(F.trim(line)).alias("_order"),
        ),
    )
    found = docs.select(
        F.col(doc_id).alias("_id"),
        _host_name(host).alias("_host"),
        F.xxhash64(text).alias("_text_hash"),
        F.filter(lines, lambda line: line["_n"] > 0).alias("_found"),
    ).filter(F.size("_found") > 0)
    orders = F.array_distinct(F.col("_found._order"))
    taken = F.least(F.floor((F.size(orders) + 1) / 2).cast("int"), F.lit(_SKETCH_LINES))

    def sketch(i: int) -> Column:
        ends = F.transform(orders, lambda order: F.substr(order, F.lit(1 + 2 * i)))
        first = F.array_join(F.slice(F.sort_array(ends), 1, taken), " ")
        return F.conv(F.substr(F.md5(first), F.lit(1), F.lit(15)), 16, 10).cast("bigint")

    bare = F.transform("_found", lambda line: F.struct(line["_at"], line["_line"], line["_n"]))
    narrow = found.select(
        "_id",
        "_host",
        "_text_hash",
        bare.cast("array<struct<_at:int,_line:bigint,_n:int>>").alias("_lines"),
        F.array(*(sketch(i) for i in range(_SKETCHES))).alias("_sketches"),
    )
    return written(docs.sparkSession, narrow, "lines")


def copy_groups(table: DataFrame) -> DataFrame:
    """(_host, _text_hash, _group): texts that nearly repeat each other have one group.

    A text takes the most frequent of its sketches; then every sketch leads to the
    best one that a text with it has taken, so that copies which differ where that
    sketch looks get to it by another.
    """
    spark, text, key = table.sparkSession, ["_host", "_text_hash"], ["_place", "_i", "_sketch"]
    texts = written(spark, table.select(*text, "_sketches").distinct(), "sketches")
    place = F.xxhash64("_host").alias("_place")
    marks = texts.select(place, "_text_hash", F.posexplode("_sketches").alias("_i", "_sketch"))
    common = marks.groupBy(*key).agg(F.count("*").alias("_texts")).filter("_texts > 1")
    # Most sketches have one text; only the others go on.
    shared = written(spark, marks.join(common, key), "shared-sketches")
    own = ["_place", "_text_hash"]
    rank = F.struct("_texts", (-F.col("_i")).alias("_i"), "_sketch")
    best = shared.groupBy(*own).agg(F.max(rank).alias("_best"))
    leads = shared.select(*own, *key[1:]).join(best, own).groupBy(*key).agg(F.max("_best").alias("_best"))
    found = shared.select(*own, *key[1:]).join(leads, key).groupBy(*own).agg(F.max("_best").alias("_best"))
    name = F.concat_ws(" ", F.col("_best._i").cast("string"), F.col("_best._sketch").cast("string"))
    alone = F.col("_text_hash").cast("string")
    group = F.when(F.col("_best").isNotNull(), name).otherwise(alone).alias("_group")
    return texts.select(*text, place).join(found, own, "left").select(*text, group)


def frequent_lines(table: DataFrame, limits: QualityLimits) -> DataFrame:
    """(_host, _line) of boilerplate lines, as hashes of normalised lines.

    Every aggregation sums or removes repeats in the map tasks first, so neither
    a host nor a line with a third of all rows gathers in one task.
    """
    lines = F.explode(F.array_distinct(F.col("_lines._line"))).alias("_line")
    return (
        table.select("_host", "_text_hash", lines)
        .distinct()
        .join(copy_groups(table), ["_host", "_text_hash"])
        .select("_host", "_line", "_group")
        .distinct()
        .groupBy("_host", "_line")
        .agg(F.count("*").alias("_groups"))
        .filter(F.col("_groups") >= limits.line_docs)
        .select("_host", "_line")
    )


def boilerplate_lines(
    docs: DataFrame,
    limits: QualityLimits,
    text: str = "text",
    host: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per document that has boilerplate: where its lines are, and their words.

    Columns _id, _host, _text_hash, _lost (indexes of lines), _lost_words. Only
    hashes of lines are shuffled. The list of a document is bounded by its own
    number of lines.
    """
    table = line_table(docs, text, host, doc_id)
    found = table.select("_id", "_host", "_text_hash", F.inline("_lines"))
    return (
        found.join(frequent_lines(table, limits), ["_host", "_line"])
        .select("_id", "_host", "_text_hash", "_at", "_n")
        .distinct()
        .groupBy("_id", "_host", "_text_hash")
        .agg(F.collect_list("_at").alias("_lost"), F.sum("_n").alias("_lost_words"))
    )


def _with_lost(
    rows: DataFrame, docs: DataFrame, limits: QualityLimits, text: str, host: str, doc_id: str
) -> DataFrame:
    """Rows that carry _id, _host and _text_hash, with _lost and _lost_words of their document."""
    lost = boilerplate_lines(docs, limits, text, host, doc_id)
    same = (
        rows["_id"].eqNullSafe(lost["_id"])
        & (rows["_host"] == lost["_host"])
        & (rows["_text_hash"] == lost["_text_hash"])
    )
    return rows.join(lost, same, "left").select(
        *[rows[name] for name in rows.columns if name not in ("_id", "_host", "_text_hash")],
        lost["_lost"],
        F.coalesce(lost["_lost_words"], F.lit(0)).alias("n_lost_words"),
    )


def _verdict(limits: QualityLimits) -> Column:
    left = F.col("n_words") - F.col("n_lost_words")
    return ~F.col("base_failed") & (100 * left >= limits.min_left_percent * F.col("n_words"))


def score_quality(
    docs: DataFrame,
    limits: QualityLimits = QualityLimits(),
    text: str = "text",
    host: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Per row: doc_id, the text counts, base_failed, n_lost_words and kept; no text moves."""
    rows = docs.select(
        F.col(doc_id).alias("_id"),
        _host_name(host).alias("_host"),
        F.xxhash64(text).alias("_text_hash"),
        F.col(text).alias("_raw"),
    )
    counted = (
        with_text_counts(rows, F.col("_raw"))
        .drop("_raw")
        .withColumn("base_failed", _base_failed(limits))
        .withColumn("doc_id", F.col("_id"))
    )
    scored = _with_lost(counted, docs, limits, text, host, doc_id).drop("_lost")
    return scored.withColumn("kept", _verdict(limits))


def clean_by_quality(
    docs: DataFrame,
    limits: QualityLimits = QualityLimits(),
    text: str = "text",
    host: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """The kept rows in the columns of the input, without their boilerplate lines.

    Documents that fail the base rules go before the text is shuffled; the line
    statistics still come from all documents.
    """
    keyed = docs.select(
        *[F.col(name).alias(f"c_{i}") for i, name in enumerate(docs.columns)],
        F.col(doc_id).alias("_id"),
        _host_name(host).alias("_host"),
        F.xxhash64(text).alias("_text_hash"),
    )
    raw = f"c_{docs.columns.index(text)}"
    # Observing the counts also keeps the filter above them: pushed below, it
    # would repeat every array expression inside every other that uses it.
    counted = (
        with_text_counts(keyed, F.col(raw))
        .withColumn("base_failed", _base_failed(limits))
        .observe(
            "quality rules",
            F.count(F.lit(1)).alias("seen_rows"),
            F.count_if("base_failed").alias("failed_rows"),
        )
        .filter(~F.col("base_failed"))
    )
    scored = _with_lost(counted, docs, limits, text, host, doc_id).filter(_verdict(limits))
    split = scored.withColumn("_all", F.split(raw, "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), F.col("_lost"))
    cleaned = F.array_join(F.transform(left, lambda i: F.get("_all", i)), "\n")
    result = F.when(F.col("_lost").isNull(), F.col(raw)).otherwise(cleaned)
    return split.withColumn(raw, result).select(
        *[F.col(f"c_{i}").alias(name) for i, name in enumerate(docs.columns)]
    )
