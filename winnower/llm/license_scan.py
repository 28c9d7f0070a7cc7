"""Licence detection by ordered signature rules.

Every whole text becomes its words, joined by one blank. A rule runs only if the
text holds one of its keywords as a word, which one set intersection decides for
all rules at once. What the rules find is then resolved in order of priority: a
detection that lies wholly inside one already taken is suppressed, so that the
sentence of a licence text hides the names inside it, and a name with a version
the bare name. Detections that only overlap both stay. The phrases of the base
are counted at every place, suppressed or not, and their labels always stay.

Rows are independent: nothing is shuffled, and memory holds one text at a time.

Defined cases: a null or wordless text has no words, no places and score 0, with
null first and last words and empty labels; rows with repeated or null doc_ids
get a result each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnower.llm.ascii_words import words_of
from winnower.llm.license_rules import TIERS

#: Phrases of the base and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
_PHRASES = [(phrase.encode().split(), label) for phrase, label in BASE.items()]
_FIRST_WORDS = frozenset(words[0] for words, _ in _PHRASES)


@dataclass(frozen=True)
class Rule:
    place: int
    label: str
    weight: float
    keywords: tuple[bytes, ...]
    pattern: re.Pattern[bytes]


@dataclass(frozen=True)
class Detection:
    """What a rule found: the words from ``start`` up to ``end``."""

    rule: Rule
    start: int
    end: int


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in order of priority, compiled once in each process."""
    lines = [(weight, line) for weight, tier in TIERS for line in tier.strip().splitlines()]
    parsed = [(weight, *line.split(" ~ ")) for weight, line in lines]
    return tuple(
        Rule(
            place,
            label,
            weight,
            tuple(keywords.encode().split(b"|")),
            re.compile(rb"(?:%s)(?![^ ])" % pattern.encode()),
        )
        for place, (weight, label, keywords, pattern) in enumerate(parsed)
    )


@cache
def _by_keyword() -> dict[bytes, list[Rule]]:
    gate: dict[bytes, list[Rule]] = {}
    for rule in rules():
        for keyword in rule.keywords:
            gate.setdefault(keyword, []).append(rule)
    return gate


def awake(words: list[bytes]) -> list[Rule]:
    """The rules of which the text holds a keyword."""
    gate = _by_keyword()
    found = {rule.place: rule for word in gate.keys() & words for rule in gate[word]}
    return [found[place] for place in sorted(found)]


def matches(rule: Rule, joined: bytes) -> Iterator[tuple[int, int]]:
    """(first, one past the last) character of every match, from left to right, none overlapping."""
    at = 0
    while found := rule.pattern.search(joined, at):
        start, end = found.span()
        if start and joined[start - 1] != 32:  # inside a word; go on at the next one
            at = start + 1
            continue
        yield start, end
        at = end


def detections(words: list[bytes], asked: Iterable[Rule]) -> list[Detection]:
    """What the rules find in a text."""
    joined = b" ".join(words)
    found = []
    for rule in asked:
        place = at = 0
        for start, end in matches(rule, joined):
            place += joined.count(b" ", at, start)
            found.append(Detection(rule, place, place + joined.count(b" ", start, end) + 1))
            at = start
    return found


def resolved(found: list[Detection]) -> list[Detection]:
    """The detections that no detection of higher priority contains.

    Taken intervals are held without those that another taken one contains, so
    both their starts and their ends ascend and one lookup answers for all.
    """
    kept, starts, ends = [], [], []
    for one in sorted(found, key=lambda d: (d.rule.place, d.start - d.end, d.start)):
        before = bisect_right(starts, one.start)
        if before and ends[before - 1] >= one.end:
            continue
        kept.append(one)
        first, last = bisect_left(starts, one.start), bisect_right(ends, one.end)
        starts[first:last], ends[first:last] = [one.start], [one.end]
    return kept


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(word, label) of every place where a phrase of the base stands."""
    return [
        (at, label)
        for at, word in enumerate(words)
        if word in _FIRST_WORDS
        for phrase, label in _PHRASES
        if words[at : at + len(phrase)] == phrase
    ]


def scan_text(text: bytes | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one text."""
    words = words_of(text)
    asked = awake(words)
    if not asked:
        return len(words), 0, None, None, "", "", 0.0
    places = base_places(words)
    base = {label for _, label in places}
    kept = resolved(detections(words, asked))
    labels = base | {one.rule.label for one in kept}
    return (
        len(words),
        len(places),
        places[0][0] if places else None,
        places[-1][0] if places else None,
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        max((one.rule.weight for one in kept), default=0.0),
    )


_RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long,"
    " base_labels string, labels string, score double"
)


def scan_licenses(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Words, base places, labels and score of every row; ``score`` is the weight of its best rule."""
    names = [field.split()[0] for field in _RESULT.split(",")]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan_text(raw.as_py()) for raw in batch.column(1)]
            columns = zip(*rows, strict=True) if rows else ([] for _ in kinds)
            arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    rows = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"))
    return rows.mapInArrow(run, _RESULT)
