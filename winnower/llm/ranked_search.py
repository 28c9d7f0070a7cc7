"""Ranked search of all documents for a set of items, one term at a time.

One scan turns every whole text into its length and the counts of the terms that
any item asks for; this narrow index is written and gives the statistics of the
whole collection. Tasks then turn blocks of its rows into inverted lists and
serve each item term-at-a-time, rarest first. Accumulators are limited: as soon
as the bounds of the terms left cannot reach the kth score (of the accumulators
so far, or of the blocks before), no accumulator is created any more, and the
terms left only update those that exist, exactly. Blocks give their k best, and
a ranking window with a limit in the map tasks picks the k best of all.

A pass over a small share of the documents precedes the pass over all: their kth
score is a lower bound of the final one, so that tasks need not report k
documents for each item. It decides what is reported, never what is found.

Items are served in blocks of so many (item, term) pairs, which bounds what is
broadcast and what a task holds, with one index for each block of items.

Defined cases: a null or wordless document is not in the collection; an item
without terms or without scoring documents gives no rows; the terms of rows that
share an item_id (nulls too) are united; rows that share a doc_id are ranked each
on its own, and a null doc_id comes first among equal scores; an empty table of
either kind gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnower.llm.ascii_words import words_of
from winnower.storage import written

_FIRST_SHARE_DOCS = 1 << 13
_SHARE_GROWTH = 512
_HASH_SPACE = 1 << 30


@dataclass(frozen=True)
class SearchBounds:
    """What one task and one broadcast may hold; results do not depend on it."""

    pairs_per_block: int = 50_000
    postings_per_block: int = 2_000_000


@dataclass(frozen=True)
class Collection:
    """What all documents hold: how many have a term, and how many terms they have."""

    docs: int
    terms: int


@dataclass(frozen=True)
class Queries:
    """The items of a block: each a list of (term number, weight), rarest first."""

    item_ids: list[int | None]
    terms: list[list[tuple[int, int]]]


def item_terms(items: DataFrame, text: str, item_id: str) -> DataFrame:
    """(item_id, term) without repeats."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for item, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = set(words_of(raw))
                ids += [item] * len(own)
                terms += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"]
            )

    rows = items.select(F.col(item_id).cast("long"), F.col(text).cast("binary"))
    return rows.mapInArrow(split, "item_id long, term binary").distinct()


def term_index(docs: DataFrame, vocabulary: list[bytes], text: str, doc_id: str) -> DataFrame:
    """(doc_id, n_terms, terms, tfs) of every document that has a term.

    ``terms`` are places in the vocabulary, which is broadcast.
    """
    places = docs.sparkSession.sparkContext.broadcast(
        {term: place for place, term in enumerate(vocabulary)}
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place_of = places.value
        known = place_of.keys()
        for batch in batches:
            ids, sizes, ends, terms, tfs = [], [], [0], [], []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(raw)
                if not words:
                    continue
                counts = Counter(words)
                own = known & counts.keys()
                ids.append(doc)
                sizes.append(len(words))
                terms += map(place_of.__getitem__, own)
                tfs += map(counts.__getitem__, own)
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
                ],
                ["doc_id", "n_terms", "terms", "tfs"],
            )

    rows = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"))
    schema = "doc_id long, n_terms long, terms array<int>, tfs array<long>"
    return rows.mapInArrow(count, schema)


def term_weight(docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * holding + 1)))


class InvertedBlock:
    """Inverted lists of a block of documents, with the impact of each posting."""

    def __init__(
        self,
        sizes: np.ndarray,
        counts: np.ndarray,
        terms: np.ndarray,
        tfs: np.ndarray,
        all_docs: Collection,
    ):
        self.size = len(sizes)
        m = 50 + 50 * sizes * all_docs.docs // all_docs.terms
        order = np.argsort(terms, kind="stable")
        self.docs = np.repeat(np.arange(self.size), counts)[order]
        tf = tfs[order]
        self.impacts = 1_000_000_000 * tf // (1000 * tf + 20 * m[self.docs])
        held, starts = np.unique(terms[order], return_index=True)
        ends = [*starts[1:].tolist(), len(order)]
        highest = np.maximum.reduceat(self.impacts, starts) if len(starts) else starts
        self.lists = dict(
            zip(held.tolist(), zip(starts.tolist(), ends, highest.tolist(), strict=True), strict=True)
        )
        self._score = np.zeros(self.size, np.int64)
        self._open = np.zeros(self.size, bool)

    def search(self, query: list[tuple[int, int]], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents of the block, scores): those of ``least`` or more that may be among the k best."""
        found = [(*self.lists[t], w) for t, w in query if t in self.lists and w > 0]
        rest = np.cumsum([high * w for *_, high, w in found][::-1])[::-1].tolist() + [0]
        score, opened = self._score, self._open
        step = 0
        while step < len(found) and rest[step] >= least:
            start, end, _, weight = found[step]
            here = self.docs[start:end]
            score[here] += weight * self.impacts[start:end]
            opened[here] = True
            step += 1
            if least <= rest[step]:
                partial = score[opened]
                if len(partial) >= k:
                    least = max(least, int(np.partition(partial, len(partial) - k)[len(partial) - k]))
        survivors = np.flatnonzero(opened)
        for start, end, _, weight in found[step:] if len(survivors) else ():
            here = self.docs[start:end]
            at = np.minimum(np.searchsorted(here, survivors), len(here) - 1)
            hit = here[at] == survivors
            score[survivors[hit]] += weight * self.impacts[start:end][at[hit]]
        scores = score[survivors]
        score[survivors], opened[survivors] = 0, False
        good = scores >= least
        return survivors[good], scores[good]


class BestDocuments:
    """The k best documents of each item so far, as (null flags, ids, scores), best first."""

    def __init__(self, k: int, floors: list[int]):
        self.k, self.floors = k, list(floors)
        none = np.zeros(0, bool), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held: list[tuple[np.ndarray, ...]] = [none] * len(floors)

    def add(self, item: int, *rows: np.ndarray) -> None:
        if not len(rows[-1]):
            return
        nulls, ids, scores = map(np.concatenate, zip(self.held[item], rows, strict=True))
        best = np.lexsort((ids, ~nulls, -scores))[: self.k]
        self.held[item] = nulls[best], ids[best], scores[best]
        if len(best) == self.k:
            self.floors[item] = max(self.floors[item], int(scores[best[-1]]))


def _blocks(
    batches: Iterator[pa.RecordBatch], all_docs: Collection, most_postings: int
) -> Iterator[tuple[np.ndarray, np.ndarray, InvertedBlock]]:
    """(null flags, doc_ids, lists) of so many postings at most, unless one document has more."""
    parts, postings = [], 0

    def close():
        nulls, ids, *lists = (np.concatenate(part) for part in zip(*parts, strict=True))
        return nulls, ids, InvertedBlock(*lists, all_docs)

    for batch in batches:
        ids, sizes, terms, tfs = batch.columns
        cut = terms.offsets.to_numpy()
        of_docs = (
            ids.is_null().to_numpy(zero_copy_only=False),
            ids.fill_null(0).to_numpy(),
            sizes.to_numpy(),
            np.diff(cut).astype(np.int64),
        )
        of_postings = terms.values.to_numpy(), tfs.values.to_numpy()
        start = 0
        while start < len(ids):
            room = cut[start] + max(most_postings - postings, 0)
            end = int(np.searchsorted(cut, room, side="right")) - 1
            end = max(end, start if parts else start + 1)
            if end > start:
                held = (flat[cut[start] : cut[end]] for flat in of_postings)
                parts.append((*(column[start:end] for column in of_docs), *held))
                postings += int(cut[end] - cut[start])
            if end < len(ids):
                yield close()
                parts, postings = [], 0
            start = end
    if parts:
        yield close()


def _best_of_tasks(
    index: DataFrame, queries: Queries, all_docs: Collection, floors: list[int], k: int, most: int
) -> DataFrame:
    """(item, doc_id, score): at most the k best of each task and item."""
    shared = index.sparkSession.sparkContext.broadcast((queries, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, least = shared.value
        best = BestDocuments(k, least)
        for nulls, ids, block in _blocks(batches, all_docs, most):
            for item, query in enumerate(asked.terms):
                docs, scores = block.search(query, k, best.floors[item])
                best.add(item, nulls[docs], ids[docs], scores)
        for item, (nulls, ids, scores) in enumerate(best.held):
            if len(ids):
                items = pa.array(np.full(len(ids), item, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [items, pa.array(ids, mask=nulls), pa.array(scores)], ["item", "doc_id", "score"]
                )

    held = index.filter(F.size("terms") > 0)
    return held.mapInArrow(run, "item int, doc_id long, score long")


def _top(rows: DataFrame, k: int) -> DataFrame:
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return rows.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)


def _floors(
    index: DataFrame, queries: Queries, all_docs: Collection, k: int, most: int
) -> list[int]:
    """For each item a score that its kth best document reaches, or 1.

    Found on shares of the documents that grow by a fixed factor, each with the
    floors of the one before.
    """
    floors = [1] * len(queries.terms)
    size = _FIRST_SHARE_DOCS
    while size < all_docs.docs:
        share = F.pmod(F.xxhash64("doc_id"), F.lit(_HASH_SPACE)) < int(_HASH_SPACE * size / all_docs.docs)
        rows = _best_of_tasks(index.filter(share), queries, all_docs, floors, k, most)
        for row in _top(rows, k).filter(F.col("rank") == k).collect():
            floors[row["item"]] = row["score"]
        size *= _SHARE_GROWTH
    return floors


def _block_of_queries(pairs: DataFrame) -> tuple[list[int | None], list[bytes], list[list[int]]]:
    """Ids, vocabulary and term numbers of the items of a block."""
    by_item: dict[int | None, list[bytes]] = defaultdict(list)
    for row in pairs.collect():
        by_item[row["item_id"]].append(bytes(row["term"]))
    vocabulary = sorted({term for terms in by_item.values() for term in terms})
    place = {term: i for i, term in enumerate(vocabulary)}
    return list(by_item), vocabulary, [[place[t] for t in terms] for terms in by_item.values()]


def _served(
    docs: DataFrame, pairs: DataFrame, k: int, bounds: SearchBounds, text: str, doc_id: str
) -> DataFrame | None:
    """The result for a block of items; None if no document has a term."""
    spark = docs.sparkSession
    item_ids, vocabulary, asked = _block_of_queries(pairs)
    index = written(spark, term_index(docs, vocabulary, text, doc_id), "terms")
    total = index.agg(F.count("*").alias("docs"), F.sum("n_terms").alias("terms")).first()
    if not total["docs"]:
        return None
    all_docs = Collection(total["docs"], total["terms"])
    held = index.select(F.explode("terms").alias("term")).groupBy("term").count()
    holding = {row["term"]: row["count"] for row in held.collect()}  # at most the vocabulary
    weighed = [
        [(t, term_weight(all_docs.docs, holding[t])) for t in sorted(terms, key=holding.get)]
        for terms in ([t for t in terms if t in holding] for terms in asked)
    ]
    queries = Queries(item_ids, weighed)
    floors = _floors(index, queries, all_docs, k, bounds.postings_per_block)
    rows = _best_of_tasks(index, queries, all_docs, floors, k, bounds.postings_per_block)
    names = spark.createDataFrame(list(enumerate(item_ids)), "item int, item_id long")
    return _top(rows, k).join(F.broadcast(names), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )


def search_ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    bounds: SearchBounds = SearchBounds(),
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    spark = docs.sparkSession
    pairs = written(spark, item_terms(items, item_text, item_id), "item-terms")
    blocks = -(-pairs.count() // bounds.pairs_per_block)
    number = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in range(blocks):
        served = _served(docs, pairs.filter(number == block), k, bounds, text, doc_id)
        found = found if served is None else served if block == 0 else found.union(served)
    return found
