"""Mixing by a budget: rare cells, whole cells, convergence and the gaps that are reported."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from winnower.llm.mixing import MixTargets, fit_cells, mix_report, with_probability

MIDDLE = "/root/testdata/sf0.01"
CELLS = "_source string, _lang string, _topic string, _tokens long"


def _tokens_kept(rows):
    total = sum(r.n_tokens for r in rows)
    return sum(r.p * r.n_tokens for r in rows) / total


def test_one_odd_document_decides_about_itself_only(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame([(-5, "odd " * 100, "xx", "odd")], docs.schema)
    before = {r.doc_id: r for r in with_probability(docs).collect()}
    after = {r.doc_id: r for r in with_probability(docs.union(odd)).collect()}
    assert after.pop(-5).p == pytest.approx(1, abs=0.05)
    assert _tokens_kept(before.values()) == pytest.approx(0.5, abs=0.02)
    own = 100 / sum(r.n_tokens for r in before.values())
    change = abs(_tokens_kept(after.values()) / _tokens_kept(before.values()) - 1)
    assert change < 0.002 + own
    assert max(abs(after[d].p - before[d].p) for d in before) < 0.02


@pytest.mark.parametrize("rate", [0.1, 0.5, 0.9])
def test_the_rate_is_the_size_of_the_sample(spark, rate):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rows = with_probability(docs, MixTargets(rate=rate)).collect()
    assert _tokens_kept(rows) == pytest.approx(rate, abs=0.03)
    assert all(0 <= r.p <= 1 for r in rows)


def _plain(cells, shares, rate, sweeps):
    weights = {cell: float(n) for cell, n in cells.items()}
    budget = rate * sum(cells.values())
    for _ in range(sweeps):
        for at, share in enumerate(shares):
            now = {}
            for cell, weight in weights.items():
                now[cell[at]] = now.get(cell[at], 0) + weight
            for cell in weights:
                factor = share.get(cell[at], 0) * budget / now[cell[at]] if now[cell[at]] else 0
                weights[cell] = min(cells[cell], weights[cell] * factor)
    return weights


def test_cells_equal_plain_sweeps(spark):
    cells = {("a", "x", "p"): 900, ("a", "y", "p"): 100, ("b", "x", "q"): 50, ("b", "y", "p"): 400}
    shares = [{"a": 0.3, "b": 0.7}, {"x": 0.4, "y": 0.6}, {"p": 0.9, "q": 0.1}]
    targets = MixTargets(*shares, rate=0.4, most_sweeps=6, tolerance=0.0)
    table = spark.createDataFrame([(*cell, n) for cell, n in cells.items()], CELLS)
    mix = fit_cells(table, targets)
    plain = _plain(cells, shares, 0.4, mix.sweeps)
    for row in mix.cells.collect():
        assert row._weight == pytest.approx(plain[row._source, row._lang, row._topic], rel=1e-9)
    assert mix.sweeps == 6


def test_sweeps_stop_at_the_tolerance_and_gaps_are_reported(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    report = mix_report(docs).collect()
    assert {r.margin for r in report} == {"source", "lang", "topic"}
    assert max(abs(r.gap) for r in report) <= 0.001
    for margin in ("source", "lang", "topic"):
        assert sum(r.target for r in report if r.margin == margin) == pytest.approx(1)
        assert sum(r.reached for r in report if r.margin == margin) == pytest.approx(1)


def test_targets_that_contradict_each_other_show_a_gap(spark):
    """Source a is language x alone: both cannot have these shares."""
    docs = spark.createDataFrame(
        [(i, "word " * 50, "x" if i % 2 else "y", "a" if i % 2 else "b") for i in range(40)],
        "doc_id long, text string, lang string, source string",
    )
    targets = MixTargets(source={"a": 0.9, "b": 0.1}, lang={"x": 0.1, "y": 0.9}, topic=1.0)
    gaps = mix_report(docs, targets).agg(F.max(F.abs("gap"))).first()[0]
    assert gaps > 0.05
    absent = MixTargets(source={"a": 0.5, "c": 0.5})
    report = {r["class"]: r for r in mix_report(docs, absent).collect() if r.margin == "source"}
    assert report["c"].reached == 0 and report["b"].target == 0 and report["b"].reached == 0
