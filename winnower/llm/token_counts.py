"""Token counts by byte-pair merging with a heap and a linked list.

A text is a chain of symbols, one for each character; a heap holds the adjacent
pairs that the vocabulary knows, and the pair of lowest rank (of equal ranks
the leftmost) is merged until none is left. A text has as many tokens as it had
symbols, less the merges; no identifiers are made. A character outside the
vocabulary is as many symbols as it has bytes.

No piece of the vocabulary crosses from another character to a blank mark, so
blanks cut a text into words that merge on their own, and so does every pair of
characters that no piece has side by side. Counts of short words are kept in a
cache of bounded size; what is counted never depends on it.

Defined cases: a null text is empty; an empty text has no tokens; repeated rows
get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLANK = "▁"
_CACHED_WORDS = 400_000
_CACHED_LENGTH = 40


class MergeRules:
    """Ranks of the normal pieces of a sentencepiece vocabulary file."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor

        pieces = SentencePieceProcessor(model_file=model_file)
        self.rank: dict[str, float] = {}
        for i in range(pieces.get_piece_size()):
            special = pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_unused(i)
            if not special and not pieces.is_byte(i):
                self.rank[pieces.id_to_piece(i)] = -pieces.get_score(i)
        neighbours = {piece[i : i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        self.joined = {pair for pair in neighbours if not (pair[1] == _BLANK and pair[0] != _BLANK)}
        if neighbours != self.joined:
            raise ValueError("a piece has a blank inside; words do not merge on their own")


def merged_count(symbols: str, rank: dict[str, float]) -> int:
    """Symbols left after merging; ``symbols`` has known and unknown characters."""
    size = len(symbols)
    start = size + sum(len(c.encode()) - 1 for c in symbols if c not in rank)
    text = list(symbols)
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    heap = []
    for i in range(size - 1):
        pair = text[i] + text[i + 1]
        if pair in rank:
            heap.append((rank[pair], i, pair))
    heapify(heap)
    merges = 0
    while heap:
        _, left, pair = heappop(heap)
        right = after[left]
        if text[left] is None or right >= size or text[left] + text[right] != pair:
            continue  # one of its symbols has been merged since
        merges += 1
        text[left], text[right] = pair, None
        follower = after[left] = after[right]
        if follower < size:
            before[follower] = left
            longer = pair + text[follower]
            if longer in rank:
                heappush(heap, (rank[longer], left, longer))
        leader = before[left]
        if leader >= 0:
            longer = text[leader] + pair
            if longer in rank:
                heappush(heap, (rank[longer], leader, longer))
    return start - merges


class WordCounts(dict):
    """Tokens by word; unknown words are counted on first sight."""

    def __init__(self, rules: MergeRules):
        super().__init__()
        self.rules = rules

    def __missing__(self, word: str) -> int:
        joined = self.rules.joined
        cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in joined]
        if not cuts:
            return self._part(word)
        ends = [*cuts, len(word)]
        tokens = sum(self._part(word[a:b]) for a, b in zip([0, *cuts], ends, strict=True))
        return self._kept(word, tokens)

    def _part(self, word: str) -> int:
        known = self.get(word)
        if known is not None:
            return known
        return self._kept(word, merged_count(word, self.rules.rank))

    def _kept(self, word: str, tokens: int) -> int:
        if len(word) <= _CACHED_LENGTH:
            if len(self) >= _CACHED_WORDS:
                self.clear()
            self[word] = tokens
        return tokens


@lru_cache(maxsize=2)
def _counts_of(model_file: str) -> WordCounts:
    """The cache of one worker process, which outlives its tasks."""
    return WordCounts(MergeRules(model_file))


_SEGMENT = re.compile(f"{_BLANK}*[^{_BLANK}\n]+|{_BLANK}+|\n")


def text_tokens(text: str | None, counts: WordCounts) -> int:
    """Tokens of a whole text: a blank mark is put before it and for each blank."""
    if not text:
        return 0
    marked = _BLANK + text.replace(" ", _BLANK)
    return sum(map(counts.__getitem__, _SEGMENT.findall(marked)))


def count_tokens(
    docs: DataFrame,
    model_file: str,
    text: str = "text",
    doc_id: str = "doc_id",
    limit: int = 4096,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row for each row; nothing is shuffled.

    ``model_file`` is a path that every executor can open.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _counts_of(model_file)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokens = [text_tokens(t, counts) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return rows.mapInArrow(run, schema)
