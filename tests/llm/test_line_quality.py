"""Line frequency: groups of near copies, hosts that grow, and footers."""

from __future__ import annotations

import random

from winnower.llm.line_quality import QualityLimits, clean_by_quality, frequent_lines, line_table, score_quality
from winnower.llm.simhash import drop_near_duplicates

SCHEMA = "doc_id long, text string, source string"


def _line(rng):
    return " ".join("".join(rng.choices("abcdefghijklm", k=6)) for _ in range(9))


def _document(rng, lines=12):
    return [_line(rng) for _ in range(lines)]


def _changed(rng, lines, changes=1):
    lines = list(lines)
    for _ in range(changes):
        lines[rng.randrange(len(lines))] = _line(rng)
    return lines


def _kept(spark, rows):
    found = score_quality(spark.createDataFrame(rows, SCHEMA)).collect()
    return {row["doc_id"]: row["kept"] for row in found}


def test_near_copies_are_not_boilerplate_to_each_other(spark):
    """Groups of 12 and of 400 near copies in one host: all stay, and near-dedup leaves some."""
    rng = random.Random(1)
    rows = []
    for size in (12, 400):
        base = _document(rng)
        rows += [_changed(rng, base, rng.randint(0, 1)) for _ in range(size)]
    rows = [(i, "\n".join(lines), "host") for i, lines in enumerate(rows)]
    kept = _kept(spark, rows)
    assert all(kept.values()) and len(kept) == 412
    docs = spark.createDataFrame(rows, SCHEMA)
    cleaned = clean_by_quality(docs)
    assert {r.doc_id: r.text for r in cleaned.collect()} == {row[0]: row[1] for row in rows}
    assert drop_near_duplicates(cleaned).count() >= 2


def test_a_footer_of_different_texts_is_boilerplate(spark):
    """One line or four of sixteen, in a host of any size; ten texts are enough for one line."""
    rng = random.Random(2)
    footer = [f"footer of {word} and contact" for word in ("terms", "privacy", "imprint", "help")]
    one = [_document(rng) + footer[:1] for _ in range(10)]
    four = [_document(rng) + footer for _ in range(60)]
    for more in (0, 2000):
        rows = [("a", lines) for lines in one] + [("b", lines) for lines in four]
        rows += [(host, _document(rng)) for host in "ab" for _ in range(more)]
        table = [(i, "\n".join(lines), host) for i, (host, lines) in enumerate(rows)]
        table = line_table(spark.createDataFrame(table, SCHEMA))
        found = frequent_lines(table, QualityLimits())
        assert sorted(row["_host"] for row in found.collect()) == ["a", "b", "b", "b", "b"]


def test_a_host_that_doubles_keeps_its_verdicts(spark):
    rng = random.Random(3)
    boilerplate = [_line(rng) for _ in range(14)]
    rows = [(i, "\n".join([*_document(rng, 4), *rng.sample(boilerplate, 9)]), "host") for i in range(60)]
    rows += [(i, "\n".join(_document(rng)), "host") for i in range(60, 120)]
    before = _kept(spark, rows)
    assert not all(before.values()) and any(before.values())
    doubled = rows + [(1000 + i, "\n".join(_document(rng)), "host") for i in range(1200)]
    after = _kept(spark, doubled)
    assert {i: after[i] for i in before} == before
