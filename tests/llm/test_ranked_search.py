"""Ranked search against a plain version that scores every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from winnower.llm.ranked_search import Collection, InvertedBlock, SearchBounds, search_ranked

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]


def _plain(docs, items, k):
    held = [(doc, Counter(_terms(text))) for doc, text in docs]
    held = [(doc, tf) for doc, tf in held if tf]
    n_docs, all_terms = len(held), sum(sum(tf.values()) for _, tf in held)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(_terms(text))
    rows = []
    for item, terms in asked.items():
        scored = []
        for doc, tf in held:
            m = 50 + 50 * sum(tf.values()) * n_docs // all_terms
            score = 0
            for term in terms:
                df = sum(term in other for _, other in held)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += w * (1_000_000_000 * tf[term] // (1000 * tf[term] + 20 * m)) if tf[term] else 0
            if score > 0:
                scored.append((-score, doc is not None, doc or 0, doc, score))
        scored.sort(key=lambda x: x[:3])
        rows += [(item, rank, doc, score) for rank, (*_, doc, score) in enumerate(scored[:k], 1)]
    return sorted(rows, key=str)


def _found(spark, docs, items, k, bounds=SearchBounds()):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    docs = docs.selectExpr("*", "'own' as terms", "'own' as score", "'own' as term")
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, search_ranked(docs, items, k, bounds).collect()), key=str)


def _random_case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.paretovariate(0.5))}" for _ in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(150)]
    docs += [(i, docs[7][1]) for i in range(500, 540)]  # ties
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 9)))) for i in range(12)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("bounds", [SearchBounds(), SearchBounds(7, 40)], ids=["one block", "small blocks"])
def test_random_collections(spark, seed, bounds):
    docs, items = _random_case(seed)
    assert _found(spark, docs, items, 10, bounds) == _plain(docs, items, 10)


def test_floors_from_shares_change_nothing(spark, monkeypatch):
    monkeypatch.setattr("winnower.llm.ranked_search._FIRST_SHARE_DOCS", 8)
    monkeypatch.setattr("winnower.llm.ranked_search._SHARE_GROWTH", 4)
    docs, items = _random_case(3)
    assert _found(spark, docs, items, 5) == _plain(docs, items, 5)


def test_edge_cases(spark):
    docs = [(None, "Alpha beta"), (1, "alpha beta"), (1, "alpha beta"), (2, None), (3, " .,\n"), (4, "ALPHA é É")]
    docs += [(5, "long words " * 400_000 + "beta"), (-(2**63), "alpha beta")]
    items = [(1, "alpha alpha Beta"), (2, None), (3, "…"), (None, "É"), (None, "words"), (4, "absent")]
    rows = _found(spark, docs, items, 3)
    assert rows == _plain(docs, items, 3)
    assert [(item, doc) for item, rank, doc, _ in rows if item == 1] == [(1, None), (1, -(2**63)), (1, 1)]
    assert _found(spark, [(1, None)], items, 3) == _found(spark, docs, [(1, "")], 3) == []
    empty = spark.createDataFrame([], "doc_id long, text string, item_id long")
    assert search_ranked(empty, empty).collect() == []


def test_accumulators_are_limited():
    """A common term opens no accumulators once a rare one has filled the ranking."""
    sizes = np.full(1000, 10)
    rare = np.zeros(1000, bool)
    rare[::100] = True
    counts = np.where(rare, 2, 1)
    terms = np.concatenate([[0, 1] if r else [1] for r in rare])
    block = InvertedBlock(sizes, counts, terms, np.ones(len(terms), np.int64), Collection(1000, 10_000))
    docs, scores = block.search([(0, 5000), (1, 3)], k=10, least=1)
    assert docs.tolist() == np.flatnonzero(rare).tolist()
    assert len(set(scores.tolist())) == 1 and scores[0] == 5003 * (10**9 // (1000 + 20 * 100))
    everything, _ = block.search([(0, 5000), (1, 3)], k=11, least=1)
    assert len(everything) == 1000
