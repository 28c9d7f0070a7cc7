from __future__ import annotations

import sys

import pytest
import restated
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from winnower.functions import text


def values(spark, rows, column):
    frame = spark.createDataFrame([(n, row) for n, row in enumerate(rows)], "n int, t string")
    return [row.v for row in frame.select("n", column.alias("v")).orderBy("n").collect()]


def test_every_whitespace_code_point(spark):
    scalars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    wide = [c for c in scalars if ord(c) < 0x3100 or ord(c) % 257 == 0]
    rows = [f"a{c}b" for c in wide]
    spaces = {c for c, v in zip(wide, values(spark, rows, text.normalise(F.col("t")))) if v == "a b"}
    assert spaces == {c for c in scalars if c.isspace()}
    assert len(spaces) == 29


@settings(max_examples=20, deadline=None)
@given(rows=st.lists(st.text(st.sampled_from("ab \t\n\x1c\x85\xa0\N{EM SPACE}\N{IDEOGRAPHIC SPACE}\U0001f600")),
                     min_size=1, max_size=60))
def test_normalise_like_python(spark, rows):
    assert values(spark, rows, text.normalise(F.col("t"))) == [restated.squeeze(t) for t in rows]


@pytest.mark.parametrize("length", [0, 1, 2, 3, 6, 7, 8, 9, 119, 120, 121])
def test_char_run(spark, length):
    rows = ["", "ab"]
    for pad in (0, 1, 59, 60, 61):
        for run in (1, 2, 5, 6, 7, 8, 9, 118, 119, 120, 121):
            for char in ("z", "\n", "\U0001f600"):
                rows.append("ab" * (pad // 2) + "c" * (pad % 2) + char * run + "tail")
    expected = [length > 1 and restated.longest_run(t) >= length for t in rows]
    assert values(spark, rows, text.has_char_run(F.col("t"), length)) == expected


def test_char_run_of_a_long_text_needs_no_deep_stack(spark):
    rows = ["ab" * 2_000_000 + "c" * 120, "ab" * 2_000_000]
    assert values(spark, rows, text.has_char_run(F.col("t"), 120)) == [True, False]


def _share_texts():
    rows = ["", "a", "a a b", "b a", "A a a"]
    for total in (5, 79, 80, 81, 100, 250):
        for common in {0, 1, total // 3, total * 2 // 5 - 1, total * 2 // 5, total * 2 // 5 + 1,
                       total // 2, total}:
            other = [f"w{n}" for n in range(total - common)]
            for word in ("m", "w5x", "~"):
                rows.append(" ".join(other[::2] + [word] * common + other[1::2]))
    return rows


def test_top_token_share(spark):
    rows = _share_texts()
    assert values(spark, rows, text.top_token_share(F.col("t"))) == [
        restated.top_share(t) for t in rows
    ]
    assert values(spark, rows, text.token_count(F.col("t"))) == [len(t.split()) for t in rows]


@pytest.mark.parametrize("share", [-1.0, 0.0, 0.01, 0.05, 0.3, 0.4, 0.5, 1.0, 1.5])
@pytest.mark.parametrize("least", [1, 5, 80])
def test_is_repetitive(spark, share, least):
    rows = [t for t in _share_texts() if t]
    expected = [len(t.split()) >= least and restated.top_share(t) >= share for t in rows]
    assert values(spark, rows, text.is_repetitive(F.col("t"), share, least)) == expected


@settings(max_examples=15, deadline=None)
@given(rows=st.lists(st.lists(st.sampled_from(["a", "b", "c", "d", "e"]), min_size=1, max_size=40),
                     min_size=1, max_size=40),
       share=st.sampled_from([0.2, 1 / 3, 0.4, 0.45, 0.6]))
def test_is_repetitive_on_random_tokens(spark, rows, share):
    texts = [" ".join(row) for row in rows]
    expected = [len(row) >= 4 and restated.top_share(t) >= share for row, t in zip(rows, texts)]
    assert values(spark, texts, text.is_repetitive(F.col("t"), share, 4)) == expected


def test_fields_of_other_types(spark):
    frame = spark.createDataFrame(
        [("x", 7, True), ("", 0, False), (None, None, None)], "s string, n int, b boolean"
    )
    fields = [text.text_field(frame, name) for name in ("s", "n", "b", "absent")]
    assert [tuple(row) for row in frame.select(*fields).collect()] == [
        ("x", "7", "True", ""), ("", "", "", ""), ("", "", "", "")
    ]
    literals = [text.literal_field(frame, name) for name in ("s", "n", "b", "absent")]
    assert [tuple(row) for row in frame.select(*literals).collect()] == [
        ("x", "7", "True", ""), ("", "0", "False", ""), ("None", "None", "None", "")
    ]
    assert frame.select(text.literal_field(frame, "s", null_as="")).collect()[2][0] == ""
