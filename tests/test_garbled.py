from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from winnower import fixtures
from winnower.functions.garbled import (
    GarbledRule,
    count_pairs,
    fit_pair_model,
    garbled_share,
    is_garbled,
)
from winnower.operators.cleaning import garbled_check, label_rows
from winnower.operators.tally import drop_waterfall

MIDDLE = "/root/testdata/sf0.01"


def _texts(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, text string")


def test_share_of_bad_characters(spark):
    texts = ["", "abc", "a�b\x01", "\t\n\x85 ok", "\x9f", "äöü €", "\x00"]
    rows = _texts(spark, texts).select("n", garbled_share(F.col("text")).alias("s")).orderBy("n").collect()
    assert [row.s for row in rows] == [0, 0, 0.5, 0, 1, 0, 1]


def _plain_model(texts):
    counted = Counter()
    for text in texts:
        codes = [ord(c) for c in text.lower()]
        for a, b in zip(codes, codes[1:], strict=False):
            counted[(a * 257 + b) % 4093, a % 4093] += 1
    firsts = Counter()
    for (_, first), n in counted.items():
        firsts[first] += n
    by_pair = {}
    for (pair, first), n in counted.items():
        total, best = by_pair.get(pair, (0, (0, 0)))
        by_pair[pair] = total + n, max(best, (n, first))
    return {
        pair: max(0, math.floor(-math.log2((n + 0.5) / (firsts[best[1]] + 0.5 * 4093)) * 1000))
        for pair, (n, best) in by_pair.items()
    }


def test_model_and_surprise_equal_plain_loops(spark):
    texts = ["the cat sat on the mat", "Der Hund läuft im Wald", "", "x", "🙂🙂 ok", "the the the"] * 3
    rows = _texts(spark, texts)
    model, plain = fit_pair_model(rows, F.col("text")), _plain_model(texts)
    assert all(model.millibits[pair] == value for pair, value in plain.items())
    unseen = math.floor(-math.log2(0.5 / (sum(max(0, len(t) - 1) for t in texts) + 0.5 * 4093)) * 1000)
    assert all(model.millibits[pair] == unseen for pair in range(4093) if pair not in plain)
    found = rows.select("text", model.surprise(F.col("text")).alias("b")).collect()
    for row in found:
        codes = [ord(c) for c in row.text.lower()]
        pairs = [(a * 257 + b) % 4093 for a, b in zip(codes, codes[1:], strict=False)]
        assert row.b == (sum(plain[p] for p in pairs) // len(pairs) if pairs else None)


def test_pairs_are_counted_in_one_scan_without_a_function_for_each_letter(spark, tmp_path):
    texts = ["the cat", "x", "", None, "İ", "İx", "🙂🙂 ok"]
    _texts(spark, texts).write.parquet(f"{tmp_path}/texts")
    counted = count_pairs(spark.read.parquet(f"{tmp_path}/texts"), F.col("text"))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "lambdafunction" not in plan
    plain = Counter()
    for text in texts:
        codes = [ord(c) for c in text.lower()] if text and len(text) > 1 else []
        plain.update((a * 257 + b) % 4093 for a, b in zip(codes, codes[1:], strict=False))
    assert {row["pair"]: row["n"] for row in counted.collect()} == plain


def test_model_of_no_text(spark):
    rows = _texts(spark, ["", "a"])
    model = fit_pair_model(rows.limit(0), F.col("text"))
    assert set(model.millibits) == {math.floor(math.log2(2 + 4093) * 1000)} or len(set(model.millibits)) == 1
    assert rows.select(is_garbled(F.col("text"), GarbledRule(), model).alias("g")).distinct().collect()[0].g is False


def test_garbled_responses_are_told_from_good_ones(spark):
    pairs = fixtures.document_pairs(spark, MIDDLE)
    bad = fixtures.garbled_pairs(pairs)
    check = garbled_check(bad)
    rows = label_rows(bad, garbled=check).select("seq", "drop_reason").collect()
    plain = {r.seq: r.drop_reason for r in label_rows(pairs).select("seq", "drop_reason").collect()}
    found = [row.seq for row in rows if row.drop_reason == "garbled"]
    changed = [row.seq for row in rows if row.seq % 53 == 11 or row.seq % 59 == 13]
    judged = [seq for seq in changed if plain[seq] == "valid"]
    assert set(found) <= set(changed)  # no good response is lost
    # A swapped text of one repeated word is as likely as any, once it is in the table.
    assert len(set(found) & set(judged)) >= 0.8 * len(judged) > 20


def test_the_rule_is_off_unless_asked_for(spark):
    pairs = fixtures.garbled_pairs(fixtures.document_pairs(spark, MIDDLE))
    reasons = {row.drop_reason for row in drop_waterfall(label_rows(pairs)).collect()}
    assert "garbled" not in reasons


@pytest.mark.parametrize("share", [0.0, 0.5])
def test_limits(spark, share):
    rule = GarbledRule(max_share=share)
    rows = _texts(spark, ["ab", "a�"]).select("n", is_garbled(F.col("text"), rule).alias("g"))
    assert [row.g for row in rows.orderBy("n").collect()] == [share == 0.0, True]
