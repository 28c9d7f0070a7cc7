"""Benchmark decontamination: BM25 over an inverted index, with block-max WAND.

The index holds test items, cut into units of at most ``UNIT_WORDS`` words and
sorted by length, so that a block of neighbours has tight bounds. An impact is
a unit's BM25 contribution of a term over the unit's score against itself;
scores therefore lie between 0 and 1 and one threshold suits units of any
length. Every training passage is a query: overlapping windows of two chunks,
so any unit that a text repeats lies wholly in one of them. A block is opened
only where the sum of its block maxima reaches the threshold (no unit in it can
otherwise), and its units are then scored exactly. Items retrieved are verified
by the overlap of their question and answer with the passages.

The index is a stated side input. Items are dealt to shards of bounded size,
and only one shard is broadcast with a scan of the documents, so the size of
what is broadcast does not grow with the benchmark. Units by term, their number
and mean length are counted over the whole benchmark before, so that a score
does not depend on how items are dealt.

Defined cases: a null or wordless text, or item, matches nothing; repeated
items are reported once for each row; repeated documents likewise; an empty
benchmark leaves every document clean.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnower.storage import written

UNIT_WORDS = 64
UNITS_PER_BLOCK = 4
ITEMS_PER_SHARD = 500
SHARD_BYTES = 1 << 20
_K1, _B = 1.2, 0.75
_NGRAM = 3
_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class OverlapRule:
    """Retrieve at ``min_score``; verify by shared n-grams of the whole item and of each part."""

    min_score: float = 0.5
    min_overlap: float = 0.5
    min_part_overlap: float = 0.1


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _ngrams(words: list[str]) -> set[tuple[str, ...]]:
    size = max(1, min(_NGRAM, len(words)))
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def _units(words: list[str]) -> list[list[str]]:
    return [words[i : i + UNIT_WORDS] for i in range(0, len(words), UNIT_WORDS)]


@dataclass(frozen=True)
class Statistics:
    """Units, their mean length, and for each term the units that hold it."""

    units: int
    mean_words: float
    holding: dict[str, int]

    @classmethod
    def of(cls, units: list[list[str]]) -> Statistics:
        holding = Counter(chain.from_iterable(map(set, units)))
        return cls(len(units), sum(map(len, units)) / max(1, len(units)), holding)


class Index:
    """Inverted index over the units of one shard of items.

    ``statistics`` are those of the whole benchmark; without them the items
    given are all there are.

    ``block_max[term, block]`` is the highest impact of a term in a block, and
    ``impacts[slot[term, block]]`` its impacts on the units of that block.
    """

    def __init__(
        self,
        items: list[tuple[int, list[str], list[str]]],
        statistics: Statistics | None = None,
    ):
        self.items = [item for item in items if item[1] or item[2]]
        units = []
        for at, (_, question, answer) in enumerate(self.items):
            units += [(at, words) for words in _units(question + answer)]
        units.sort(key=lambda unit: len(unit[1]))
        self.unit_item = [at for at, _ in units]
        vocabulary = dict.fromkeys(chain.from_iterable(words for _, words in units))
        self.terms = {word: i for i, word in enumerate(vocabulary)}
        blocks = -(-len(units) // UNITS_PER_BLOCK)
        self.block_max = np.zeros((len(self.terms), blocks), np.float32)
        self.slot = np.zeros((len(self.terms), blocks), np.int32)
        impacts = [np.zeros(UNITS_PER_BLOCK, np.float32)]
        statistics = statistics or Statistics.of([words for _, words in units])
        for unit, found in enumerate(self._unit_impacts(units, statistics)):
            block, place = divmod(unit, UNITS_PER_BLOCK)
            for term, impact in found.items():
                if not self.slot[term, block]:
                    self.slot[term, block] = len(impacts)
                    impacts.append(np.zeros(UNITS_PER_BLOCK, np.float32))
                impacts[self.slot[term, block]][place] = impact
                self.block_max[term, block] = max(self.block_max[term, block], impact)
        self.impacts = np.array(impacts)

    def _unit_impacts(self, units, statistics: Statistics) -> Iterator[dict[int, float]]:
        n_units, holding = statistics.units, statistics.holding
        for _, words in units:
            long = _K1 * (1 - _B + _B * len(words) / statistics.mean_words)
            raw = {
                self.terms[word]: log(1 + (n_units - holding[word] + 0.5) / (holding[word] + 0.5))
                * n * (_K1 + 1) / (n + long)
                for word, n in Counter(words).items()
            }
            total = sum(raw.values())
            yield {t: impact / total for t, impact in raw.items()}

    def retrieve(self, words: list[str], min_score: float) -> dict[int, dict[int, float]]:
        """{item: {passage: score}} of all units that reach the score in a passage."""
        if not words or not self.items:
            return {}
        terms, size = len(self.terms), UNIT_WORDS
        ids = np.fromiter(map(self.terms.get, words, repeat(terms)), np.int64, len(words))
        known = np.flatnonzero(ids < terms)
        if not len(known):
            return {}
        ids, chunk, last = ids[known], known // size, max(0, (len(words) - 1) // size - 1)
        earlier = chunk > 0  # a passage is a chunk and the one after it
        keys = np.concatenate(
            (np.minimum(chunk, last) * terms + ids, (chunk[earlier] - 1) * terms + ids[earlier])
        )
        keys.sort()
        keys = keys[np.flatnonzero(np.diff(keys, prepend=-1))]
        passage, ids = np.divmod(keys, terms)
        starts = np.flatnonzero(np.diff(passage, prepend=-1))
        bounds = np.add.reduceat(self.block_max[ids], starts, axis=0)
        ends = np.append(starts, len(ids))
        found: dict[int, dict[int, float]] = defaultdict(dict)
        slack = np.float32(min_score * 0.9999)  # sums of single precision
        for at, block in zip(*np.nonzero(bounds >= slack), strict=True):
            own = ids[ends[at] : ends[at + 1]]
            # In double precision, so that the order of terms in a shard does not matter.
            scores = self.impacts[self.slot[own, block]].sum(axis=0, dtype=np.float64)
            for place in np.flatnonzero(scores >= slack).tolist():
                item = self.unit_item[block * UNITS_PER_BLOCK + place]
                where, score = int(passage[starts[at]]), round(float(scores[place]), 6)
                if score >= min_score:
                    found[item][where] = max(score, found[item].get(where, 0.0))
        return found

    def matches(self, text: str | None, rule: OverlapRule) -> list[tuple]:
        """(item_id, score, question_overlap, answer_overlap) of verified items."""
        words = words_of(text)
        verified = []
        for item, passages in self.retrieve(words, rule.min_score).items():
            item_id, question, answer = self.items[item]
            shared, total, parts = 0, 0, []
            for part in (question, answer):
                grams = _ngrams(part) if part else set()
                size = len(next(iter(grams), ()))
                seen = set()
                for passage in passages if grams else ():
                    start = passage * UNIT_WORDS
                    span = words[start : start + 2 * UNIT_WORDS]
                    seen.update(zip(*(span[i:] for i in range(size)), strict=False))
                shared += len(grams & seen)
                total += len(grams)
                parts.append(len(grams & seen) / len(grams) if grams else 1.0)
            if shared >= rule.min_overlap * total and min(parts) >= rule.min_part_overlap:
                verified.append((item_id, max(passages.values()), *parts))
        return verified


def _halves(text: str | None) -> tuple[list[str], list[str]]:
    words = words_of(text)
    middle = -(-len(words) // 2)
    return words[:middle], words[middle:]


def _parts(row, answer: str | None) -> tuple[list[str], list[str]]:
    if answer is None:
        return _halves(row["question"])
    return words_of(row["question"]), words_of(row["answer"])


def _shard_terms(dealt: DataFrame, answer: str | None) -> DataFrame:
    """(shard, word, holding, size): units of the whole benchmark that hold a shard's words.

    The row of a shard whose word is null has the number of its own units and
    the sum of their words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for item in batch.to_pylist():
                units = _units([*chain.from_iterable(_parts(item, answer))])
                rows.append((item["shard"], None, len(units), sum(map(len, units))))
                holding = Statistics.of(units).holding
                rows += [(item["shard"], word, n, 0) for word, n in holding.items()]
            names = ["shard", "word", "holding", "size"]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    counted = dealt.select(F.col("shard").cast("long").alias("shard"), "question", "answer")
    counted = counted.mapInArrow(count, "shard long, word string, holding long, size long")
    counted = counted.groupBy("shard", "word").agg(
        F.sum("holding").alias("holding"), F.sum("size").alias("size")
    )
    counted = written(dealt.sparkSession, counted, "shard-terms")
    whole = counted.filter("word is not null").groupBy("word").agg(F.sum("holding").alias("holding"))
    named = counted.select("shard", "word").join(whole, "word").select("shard", "word", "holding")
    sizes = counted.filter("word is null")
    return written(
        dealt.sparkSession,
        named.withColumn("size", F.lit(0).cast("long")).union(sizes),
        "benchmark-terms",
    )


def _shards(items: DataFrame, item_id: str, text: str, answer: str | None) -> Iterator[Index]:
    """One index at a time. ``answer`` None: the second half of the text is the answer."""
    rows = items.select(
        F.col(item_id).cast("long").alias("item_id"),
        F.col(text).alias("question"),
        (F.lit(None).cast("string") if answer is None else F.col(answer)).alias("answer"),
    )
    size = F.coalesce(F.sum(F.length("question") + F.coalesce(F.length("answer"), F.lit(0))), F.lit(0))
    total = rows.agg(F.count("*").alias("n"), size.alias("size")).first()
    shards = max(-(-total["n"] // ITEMS_PER_SHARD), -(-total["size"] // SHARD_BYTES))
    if not shards:
        return
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("item_id", "question"), F.lit(shards)))
    terms = _shard_terms(dealt, answer)
    sizes = terms.filter("word is null").agg(F.sum("holding").alias("n"), F.sum("size").alias("w"))
    whole = sizes.first()
    mean = whole["w"] / max(1, whole["n"])
    for shard in range(shards):
        here = F.col("shard") == shard
        known = terms.filter(here & F.col("word").isNotNull()).toLocalIterator()
        holding = {row["word"]: row["holding"] for row in known}
        own = dealt.filter(here).toLocalIterator()
        found = [(row["item_id"], *_parts(row, answer)) for row in own]
        yield Index(found, Statistics(whole["n"], mean, holding))


def _mapped(docs: DataFrame, index: Index, make: Callable, schema) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield make(batch, held.value)

    return docs.mapInArrow(run, schema)


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    rule: OverlapRule = OverlapRule(),
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    item_answer: str | None = None,
) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of verified matches."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = (
        "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    )

    def make(batch: pa.RecordBatch, index: Index) -> pa.RecordBatch:
        rows = [
            (doc, *match)
            for doc, whole in zip(*(column.to_pylist() for column in batch.columns), strict=True)
            for match in index.matches(whole, rule)
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
        arrays = [pa.array(values, kind) for values, kind in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    found = docs.sparkSession.createDataFrame([], schema)
    for index in _shards(items, item_id, item_text, item_answer):
        found = found.union(_mapped(narrow, index, make, schema))
    return found


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    rule: OverlapRule = OverlapRule(),
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    item_answer: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` without a verified match; nothing is shuffled."""
    at = docs.columns.index(text)

    def make(batch: pa.RecordBatch, index: Index) -> pa.RecordBatch:
        clean = [not index.matches(whole, rule) for whole in batch.column(at).to_pylist()]
        return batch.filter(pa.array(clean, pa.bool_()))

    names, clean = docs.columns, docs.toDF(*[f"c_{i}" for i in range(len(docs.columns))])
    schema = clean.schema
    for index in _shards(items, item_id, item_text, item_answer):
        clean = _mapped(clean, index, make, schema)
    return clean.toDF(*names)
