"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text is built for each language. A text is
parsed into phrases, each the longest match that the automaton has from there
on; few long phrases mean a familiar language. Phrases are normalised to an
estimate of entropy, phrases x log2(training letters) / letters, so languages
with unlike amounts of training text compare; the lowest wins.

Texts become sequences of letter codes: lower case, one code for any run of
other characters, one for letters not seen in training. They are cut into
segments of ``SEGMENT`` codes, at whose ends a phrase ends in every language,
and all segments of a batch are parsed side by side; a transition that an
automaton lacks leads to the start of the next phrase and is counted. A letter
that no training text has is a phrase of its own.

Training reads a bounded sample of whole texts: of each language's distinct texts
those lowest by their hash, at most ``docs_per_language``, as long as their
characters add up to no more than ``characters``; texts of over ``long_text``
characters come last, and the first text is taken whatever its length. Every
document is predicted from its whole text.

Defined cases: a null text or one without a letter is ``und`` with score 0;
without any labelled text all are ``und``; a null doc_id is never trained on and
not held out; ties go to the first language in order of name; repeated rows get
equal results.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
SEGMENT = 256
_LANES = 8192
_ENDED = 29  # bits above hold how many phrases a move ends
_GAP, _OTHER = 0, 1
_CODE_POINTS = 0x110000
_SHARPNESS = 24.0


@dataclass(frozen=True)
class Training:
    """Bounds of the labelled sample; documents of fold ``held_out_fold`` are not learnt from."""

    docs_per_language: int = 48
    characters: int = 72_000
    long_text: int = 20_000
    folds: int = 3
    held_out_fold: int = 1


def held_out(doc_id: Column, training: Training = Training()) -> Column:
    fold = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(training.folds))
    return F.coalesce(fold == training.held_out_fold, F.lit(False))


def _letters(text: str) -> list[str]:
    """Lower-case letters of a text, runs of other characters as one blank."""
    kept = "".join(c if c.isalpha() else " " for c in text.lower())
    return list(" ".join(kept.split()))


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of each state; the start is state 0. Every path spells a substring."""
    moves: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return moves


class Languages:
    """Automata of all languages in one table of moves.

    ``moves[state, code]`` is the next state and how many phrases the move ends:
    none within a match, one where the next phrase begins with this code, and
    the code itself as well if no phrase can begin with it.
    """

    def __init__(self, texts: dict[str, list[str]]):
        joined = {name: " ".join(texts[name]) for name in sorted(texts)}
        joined = {name: text for name, text in joined.items() if text.strip()}
        self.names = list(joined)
        alphabet = sorted(set("".join(joined.values())) - {" "})
        self.codes = {" ": _GAP} | {c: i + 2 for i, c in enumerate(alphabet)}
        self.width = len(alphabet) + 2
        tables, self.starts, states = [], [], 0
        for text in joined.values():
            moves = suffix_automaton(text)
            self.starts.append(states)
            tables.append(self._moves(moves, states))
            states += len(moves)
            if states * self.width >= 1 << _ENDED:
                raise ValueError("training text is too large for the table of moves")
        self.moves = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        self.weights = np.array([np.log2(max(2, len(text))) for text in joined.values()])
        self._by_point: np.ndarray | None = None

    def _moves(self, moves: list[dict[str, int]], first: int) -> np.ndarray:
        """Moves of one automaton whose states begin at ``first``, worked out in place.

        Next states are kept as offsets of their rows, which saves a product.
        """
        table = np.full((len(moves), self.width), -1, np.int32)
        for state, found in enumerate(moves):
            for c, target in found.items():
                table[state, self.codes[c]] = (target + first) * self.width
        lacking = table[0] < 0
        start = np.where(lacking, first * self.width, table[0]).astype(np.int32)
        table[0] = start | lacking.astype(np.int32) << _ENDED
        ended = (1 + lacking).astype(np.int32) << _ENDED
        np.copyto(table, start | ended, where=table < 0)
        return table

    def _table(self) -> np.ndarray:
        """Code of every code point."""
        if self._by_point is None:
            points = np.full(_CODE_POINTS, _GAP, np.uint16)
            for point in range(_CODE_POINTS):
                if unicodedata.category(chr(point))[0] == "L":
                    points[point] = self.codes.get(chr(point).lower()[:1], _OTHER)
            self._by_point = points
        return self._by_point

    def _codes(self, text: str) -> tuple[np.ndarray, int]:
        """Codes of a text with runs of gaps as one, and how many are letters."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self._table()[points]
        gap = codes == _GAP
        keep = ~gap
        keep[1:] |= gap[1:] & ~gap[:-1]
        return codes[keep], int(len(codes) - gap.sum())

    def _phrases(self, lanes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases of each lane (longest first) in each language."""
        counts = np.zeros((len(self.names), len(lanes)), np.int32)
        start = np.array(self.starts, np.int32)[:, None] * self.width
        state = np.repeat(start, len(lanes), axis=1)
        for t in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -t, "left"))
            found = self.moves.take(state[:, :n] + lanes[:n, t])
            counts[:, :n] += found >> _ENDED
            state[:, :n] = found & ((1 << _ENDED) - 1)
        return counts + (state != start)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        coded = [self._codes(text or "") for text in texts]
        segments = [-(-len(codes) // SEGMENT) if letters else 0 for codes, letters in coded]
        owner = np.repeat(np.arange(len(texts)), segments)
        total = len(owner)
        lanes = np.zeros((total, SEGMENT), np.uint16)
        sizes, at = np.zeros(total, np.int64), 0
        for (codes, _), count in zip(coded, segments, strict=True):
            if count:
                lanes[at : at + count].reshape(-1)[: len(codes)] = codes
                sizes[at : at + count] = SEGMENT
                sizes[at + count - 1] = len(codes) - SEGMENT * (count - 1)
                at += count
        phrases = np.zeros((len(self.names), len(texts)))
        order = np.argsort(-sizes, kind="stable")
        for start in range(0, total, _LANES):
            part = order[start : start + _LANES]
            found = self._phrases(lanes[part], sizes[part])
            for language, row in enumerate(found):
                phrases[language] += np.bincount(owner[part], row, len(texts))
        results = []
        for i, (codes, letters) in enumerate(coded):
            if not letters or not self.names:
                results.append((UNKNOWN, 0.0))
                continue
            entropy = phrases[:, i] * self.weights / len(codes)
            best = int(np.argmin(entropy))
            # Share of the best among all, sharper for longer texts.
            power = min(1.0, len(codes) / 100) * _SHARPNESS / max(entropy[best], 1e-9)
            odds = np.exp(-(entropy - entropy[best]) * power)
            results.append((self.names[best], float(round(1 / odds.sum(), 6))))
        return results


def train(docs: DataFrame, training: Training, text: str, doc_id: str, lang: str) -> Languages:
    """Automata from the bounded sample of distinct whole texts.

    Copies of a text are one candidate, so a text that fills most rows of a
    language takes one of its places. Candidates are hashes and lengths, combined
    in the map tasks; only the chosen texts go to the driver.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    ).filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.filter(~held_out(F.col("doc_id"), training)).select(
        "lang", "text", F.xxhash64("text", F.lit("language sample")).alias("hash")
    )
    sizes = rows.select("lang", "hash", F.char_length("text").alias("size"))
    length = F.greatest("size", F.lit(training.long_text))
    order = Window.partitionBy("lang").orderBy(length, "hash")
    candidates = sizes.groupBy("lang", "hash").agg(F.max("size").alias("size"))
    candidates = candidates.withColumn("place", F.row_number().over(order))
    candidates = candidates.filter(F.col("place") <= training.docs_per_language).collect()
    left: dict[str, int] = {}
    chosen: dict[str, list[int]] = {}
    for row in sorted(candidates, key=lambda row: row["place"]):
        room = left.setdefault(row["lang"], training.characters)
        if row["size"] <= room or row["place"] == 1:
            chosen.setdefault(row["lang"], []).append(row["hash"])
            left[row["lang"]] = room - row["size"]
    wanted = F.lit(False)
    for name, hashes in chosen.items():
        wanted = wanted | ((F.col("lang") == name) & F.col("hash").isin(hashes))
    sample = rows.filter(wanted).dropDuplicates(["lang", "hash"])
    texts: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "hash").collect():
        texts.setdefault(row["lang"], []).append("".join(_letters(row["text"])))
    return Languages(texts)


def identify_language(
    docs: DataFrame,
    training: Training = Training(),
    text: str = "text",
    doc_id: str = "doc_id",
    lang: str = "lang",
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row for each row; predictions shuffle nothing."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, training, text, doc_id, lang))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        held_out(F.col(doc_id), training).alias("held_out"),
        F.col(text).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([name for name, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
