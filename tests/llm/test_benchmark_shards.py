"""Decontamination must not depend on how benchmark items are dealt to shards."""

from __future__ import annotations

import random

import pytest

from winnower.llm import decontaminate


@pytest.mark.parametrize("answer", [None, "a"])
def test_one_shard_and_many_give_equal_rows(spark, monkeypatch, answer):
    rng = random.Random(6)
    common = [f"c{i}" for i in range(12)]

    def words(n):
        return [rng.choice(common) if rng.random() < 0.6 else f"r{rng.randrange(900)}" for _ in range(n)]

    items = [(i, words(rng.randint(20, 150)), words(30)) for i in range(60)]
    docs = []
    for i, question, reply in items:
        kept = rng.uniform(0.3, 0.9)  # partly copied: scores on both sides of the threshold
        copied = [w if rng.random() < kept else f"z{rng.randrange(900)}" for w in question + reply]
        docs.append((i, " ".join(words(40) + copied + words(40))))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    rows = [(i, " ".join(q), " ".join(a)) for i, q, a in items] + [(98, None, None), (99, "", "")]
    table = spark.createDataFrame(rows, "item_id long, q string, a string")
    rule = decontaminate.OverlapRule(min_overlap=0.0, min_part_overlap=0.0)

    def found():
        pairs = decontaminate.find_contamination(docs, table, rule, item_text="q", item_answer=answer)
        return sorted(map(tuple, pairs.collect()))

    whole = found()
    assert len(whole) > 20
    monkeypatch.setattr(decontaminate, "ITEMS_PER_SHARD", 10)
    assert found() == whole
