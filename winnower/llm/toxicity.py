"""Toxicity by weak supervision.

Many voters look at a text: one for each word of a lexicon, patterns (address,
dismissal, disguised insults, shouting, silence of all others), and one for each
word stem mined from labelled rows, which fires where the stem is frequent enough
for the length of the text. A generative label model holds, for each voter, how
often it fires on toxic and on clean texts, and how voters correlate within a
class; the given label is one more voter, which may err. Expectation maximisation
starts at the given labels and counts correlated voters as less than one each.
Its posterior labels, not the given ones, train a linear classifier over the
other voters' counts, which scores every whole text.

Stems are prefixes of words, so they need neither a list of words nor the
language. Of the stems far more frequent in toxic texts, each counted by its best
frequency, a greedy cover takes those that add toxic texts which few chosen ones
mark, so that a language of few texts gets its stems beside one of many.

Labels are read from a bounded sample, ``max_rows`` labelled doc_ids lowest by a
hash, with one text each; rows of the held-out fold are never among them. Rows
whose rare words have an equal minimum hash count once for mining, so that many
copies of one text cannot make its words look toxic.

Defined cases: a null or empty text gets the classifier's intercept; without
labelled rows the label model keeps its prior rates and its log-odds are the
classifier; a null label is no label, and of several labels of one doc_id the
highest counts; of several texts of one doc_id the lowest by hash is learnt from;
repeated rows get equal results.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower.llm.language_id import Training as Folds
from winnower.llm.language_id import held_out
from winnower.storage import written

#: Words that insult a person.
INSULTS = (
    "idiot idiots moron morons stupid dumb imbecile fool dunce loser losers clown clowns scum trash"
    " garbage filth vermin worthless pathetic disgusting repulsive revolting freak creep coward"
    " bastard bitch asshole dumbass retard pig swine jerk"
).split()
_DISGUISES = str.maketrans("01345@$!", "oieasasi")
_WORD = re.compile(r"\w+")
_DISGUISED = re.compile(r"\b\w*[0134@$!]\w+\b")
_ADDRESS = re.compile(r"\byou(?:'re| are| were)? (?:all |such |a |an |so )*(?:%s)\b" % "|".join(INSULTS))
_DISMISSAL = re.compile(r"\b(?:shut up|get lost|go to hell|drop dead|hate you|kill yourself)\b")
_UPPER = bytes(range(65, 91))
PATTERNS = ("disguised", "address", "dismissal", "shouting", "exclaiming", "any", "several", "quiet")


_STEM_LETTERS = range(4, 9)
#: How often a stem stands in a text of few words, or more in a longer one; see ``_strength``.
_LEVELS = (0.5, 1.0, 1.5, 2.0, 3.0)
_TEXTS_AT_ONCE = 256
_LABEL_ERROR = 0.05


@dataclass(frozen=True)
class Supervision:
    """Bounds and settings of training; predicted is 1 at ``threshold`` or more."""

    max_rows: int = 20_000
    least_texts: int = 5
    least_ratio: float = 10.0
    candidates: int = 4_000
    stems: int = 96
    least_gain: float = 3.0
    clean_cost: float = 3.0
    rounds: int = 25
    threshold: float = 0.7
    folds: Folds = Folds()


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _strength(words: int) -> float:
    """What one occurrence counts in a text of so many words."""
    return 1 / (1 + words / 1000)


class Stems:
    """Looks up which of the given stems begin a word."""

    def __init__(self, stems: list[str]):
        self.places: dict[str, list[int]] = defaultdict(list)
        for place, stem in enumerate(stems):
            self.places[stem].append(place)
        self.heads = {stem[: _STEM_LETTERS[0]] for stem in stems}
        self.sizes = sorted({len(stem) for stem in stems})
        self.size = len(stems)

    def strengths(self, words: list[str], counts: Counter[str]) -> np.ndarray:
        found, first = np.zeros(self.size), _STEM_LETTERS[0]
        for word, n in counts.items():
            if word[:first] in self.heads:
                for size in self.sizes[: bisect_right(self.sizes, len(word))]:
                    for place in self.places.get(word[:size], ()):
                        found[place] += n
        return found * _strength(len(words))


class Voters:
    """Counts of all voters on a text, in a fixed order, and which of them fire."""

    def __init__(self, mined: list[tuple[str, float]]):
        self.words = INSULTS
        self.place = {word: i for i, word in enumerate(self.words)}
        self.stems = Stems([stem for stem, _ in mined])
        self.size = self.stems.size + len(self.words) + len(PATTERNS)
        least = [level for _, level in mined] + [1e-9] * (len(self.words) + len(PATTERNS))
        self.least = np.array(least)

    def counts(self, text: str | None) -> np.ndarray:
        found = np.zeros(self.size)
        text = text or ""
        lower, lexicon = text.lower(), self.stems.size
        patterns = lexicon + len(self.words)
        words = _WORD.findall(lower)
        all_words = Counter(words)
        found[:lexicon] = self.stems.strengths(words, all_words)
        hits = self.place.keys() & all_words.keys()
        for word in hits:
            found[lexicon + self.place[word]] = all_words[word]
        disguised = (m.translate(_DISGUISES) for m in _DISGUISED.findall(lower))
        found[patterns] = sum(word in self.place for word in disguised)
        found[patterns + 1] = len(_ADDRESS.findall(lower))
        found[patterns + 2] = len(_DISMISSAL.findall(lower))
        raw = text.encode("utf-8", "surrogatepass")
        capitals = len(raw) - len(raw.translate(None, _UPPER))
        found[patterns + 3] = 2 * capitals > max(len(raw), 20)
        found[patterns + 4] = text.count("!!") > 2
        found[patterns + 5] = len(hits) > 0
        found[patterns + 6] = len(hits) > 1
        found[patterns + 7] = not self.votes(found)[: patterns + 3].any()
        return found

    def votes(self, counts: np.ndarray) -> np.ndarray:
        return counts >= self.least

    def features(self, counts: np.ndarray) -> np.ndarray:
        """Votes and damped counts side by side."""
        return np.concatenate([self.votes(counts), np.log1p(counts)], axis=-1).astype(float)


class LabelModel:
    """Firing rates of voters by class, and their correlations.

    The share of toxic texts is that of the labels and is not estimated again.

    Voters that fire on the same text share their evidence: each counts as one
    over one plus its correlations with the others that fired. The last voter is
    the given label, the one before it the silence of all others.
    """

    def __init__(self, voters: int):
        self.share = 0.1
        self.rates = np.array([np.full(voters + 1, 0.001), np.full(voters + 1, 0.2)])
        self.rates[:, -2] = 0.9, 0.3
        self.overlap = np.zeros((voters + 1, voters + 1))

    def fit(self, votes: np.ndarray, labels: np.ndarray, rounds: int) -> np.ndarray:
        """Posterior labels of the votes; starts at the given labels."""
        votes = np.hstack([votes, labels[:, None]])
        belief = 0.9 * labels + 0.05
        self.share = float(np.clip(labels.mean(), 0.01, 0.99))
        for _ in range(rounds):
            sides = (1 - belief, belief)
            for side, mass in enumerate(sides):
                self.rates[side] = (mass @ votes + 0.05) / (mass.sum() + 1.0)
            # A label that seems never to err would hold on to its own errors.
            self.rates[:, -1] = np.clip(self.rates[:, -1], _LABEL_ERROR, 1 - _LABEL_ERROR)
            self.overlap = self._correlations(votes, sides)
            belief = self.posterior(votes)
        return belief

    def _correlations(self, votes: np.ndarray, sides) -> np.ndarray:
        """Positive correlations of pairs of voters, averaged over the classes."""
        total = np.zeros((votes.shape[1], votes.shape[1]))
        for side, mass in enumerate(sides):
            apart = votes - self.rates[side]
            covariance = (apart * mass[:, None]).T @ apart / (mass.sum() + 1e-9)
            spread = np.sqrt(np.maximum(np.diag(covariance), 1e-6))
            share = mass.sum() / len(votes)
            total += share * np.clip(covariance / spread / spread[:, None], 0, 1)
        np.fill_diagonal(total, 0)
        return total

    def log_odds(self) -> tuple[np.ndarray, float]:
        """What each voter adds when it fires, and the prior's part; silence abstains."""
        clean, toxic = self.rates
        return np.log(toxic / clean), float(np.log(self.share / (1 - self.share)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        fired, prior = self.log_odds()
        odds = (votes * fired / (1 + votes @ self.overlap)).sum(axis=1) + prior
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_linear(x: np.ndarray, target: np.ndarray, ridge: float = 0.05, steps: int = 40):
    """Weights and intercept of a ridge logistic regression on soft labels, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - target) + penalty * weights
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        weights -= np.linalg.solve(curve, gradient)
    return weights[:-1], float(weights[-1])


def _unlike(sample: DataFrame) -> DataFrame:
    """(text, toxic) of rows that no other row resembles by its rare words."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[\\p{L}]{6,}"), F.lit(0)))
    same = F.array_min(F.transform(words, lambda w: F.xxhash64(w)))
    return sample.withColumn("_same", same).dropDuplicates(["toxic", "_same"]).select("text", "toxic")


def _stem_counts(rows: DataFrame) -> DataFrame:
    """(stem, t0, c0, t1, c1, ..): toxic and clean texts in which a stem reaches each level."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS_AT_ONCE):
                part = batch.slice(start, _TEXTS_AT_ONCE)
                found: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(2 * len(_LEVELS), np.int64))
                for text, toxic in zip(*(part.column(i).to_pylist() for i in (0, 1)), strict=True):
                    words = _words(text)
                    stems: Counter[str] = Counter()
                    for word, n in Counter(words).items():
                        for size in range(_STEM_LETTERS[0], min(_STEM_LETTERS[-1], len(word)) + 1):
                            stems[word[:size]] += n
                    one = _strength(len(words))
                    for stem, n in stems.items():
                        reached = bisect_right(_LEVELS, n * one)
                        found[stem][1 - toxic : 2 * reached : 2] += 1
                if found:
                    columns = np.array(list(found.values())).T
                    arrays = [pa.array(found, pa.string()), *map(pa.array, columns)]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["stem", *(f"{side}{i}" for i in range(len(_LEVELS)) for side in "tc")]
    schema = "stem string, " + ", ".join(f"{name} long" for name in names[1:])
    counted = rows.select("text", "toxic").mapInArrow(count, schema)
    return counted.groupBy("stem").agg(*(F.sum(name).alias(name) for name in names[1:]))


def _evidence(toxic: Column, clean: Column, share: float) -> Column:
    """Half the likelihood ratio statistic of so many toxic and clean texts, for an excess of toxic ones."""

    def part(n: Column, expected: float) -> Column:
        return F.when(n > 0, n * F.ln(n / ((toxic + clean) * expected))).otherwise(0.0)

    return part(toxic, share) + part(clean, 1 - share)


def _candidates(rows: DataFrame, how: Supervision) -> list[tuple[str, float]]:
    """Stems with the level that tells most, best first; none begins another."""
    total = rows.agg(
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"), F.count("*").alias("n")
    ).first()
    toxic, clean = total["toxic"], total["n"] - total["toxic"]
    if not toxic or not clean:
        return []
    levels = []
    for i, level in enumerate(_LEVELS):
        t, c = F.col(f"t{i}"), F.col(f"c{i}")
        often = (t >= how.least_texts) & (t / toxic >= how.least_ratio * (c + 0.5) / clean)
        evidence = _evidence(t, c, toxic / total["n"])
        levels.append(F.when(often, F.struct(evidence.alias("evidence"), F.lit(level).alias("level"))))
    best = _stem_counts(rows).select("stem", F.array_max(F.array(*levels)).alias("best"))
    best = best.filter("best is not null").select("stem", "best.*")
    order = F.desc("evidence"), F.desc(F.length("stem")), "stem"
    chosen: dict[str, float] = {}
    begun: set[str] = set()
    for row in best.orderBy(*order).limit(5 * how.candidates).collect():
        stem = row["stem"]
        heads = [stem[:size] for size in range(_STEM_LETTERS[0], len(stem) + 1)]
        if stem not in begun and not any(head in chosen for head in heads):
            chosen[stem] = row["level"]
            begun.update(heads)
    return list(chosen.items())[: how.candidates]


def greedy_cover(hits: list[np.ndarray], toxic: np.ndarray, how: Supervision) -> list[int]:
    """Places of the candidates that are taken, in the order of their gain.

    A toxic row that n taken candidates mark is worth 1 / (1 + n), a clean row
    costs ``clean_cost``. Gains only fall, so the best of a heap that is still the
    best when its gain is counted again is the best of all.
    """
    marked = np.zeros(len(toxic))

    def gain(place: int) -> float:
        rows = hits[place]
        bad = toxic[rows] == 1
        return float((1 / (1 + marked[rows[bad]])).sum() - how.clean_cost * (~bad).sum())

    heap = [(-gain(place), place) for place in range(len(hits))]
    heapq.heapify(heap)
    taken: list[int] = []
    while heap and len(taken) < how.stems and -heap[0][0] >= how.least_gain:
        _, place = heapq.heappop(heap)
        now = (-gain(place), place)
        if heap and now > heap[0]:
            heapq.heappush(heap, now)
        elif -now[0] >= how.least_gain:
            taken.append(place)
            marked[hits[place]] += 1
    return taken


def mined_stems(sample: DataFrame, how: Supervision) -> list[tuple[str, float]]:
    """(stem, level) of the stems that become voters."""
    rows = written(sample.sparkSession, _unlike(sample), "unlike")
    candidates = _candidates(rows, how)
    stems, least = Stems([stem for stem, _ in candidates]), np.array([level for _, level in candidates])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0):
                words = _words(text.as_py())
                found.append(np.flatnonzero(stems.strengths(words, Counter(words)) >= least).tolist())
            places = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([places, batch.column(1)], ["places", "toxic"])

    if not candidates:
        return []
    marks = rows.select("text", "toxic").mapInArrow(mark, "places array<long>, toxic int")
    marks = marks.filter(F.size("places") > 0).toPandas()
    by_stem: list[list[int]] = [[] for _ in candidates]
    for row, places in enumerate(marks["places"]):
        for place in places:
            by_stem[place].append(row)
    hits = [np.array(rows, np.int64) for rows in by_stem]
    return [candidates[place] for place in greedy_cover(hits, marks["toxic"].to_numpy(), how)]


def _labelled(docs: DataFrame, labels: DataFrame, how: Supervision, text, doc_id) -> DataFrame:
    """(text, toxic) of the bounded sample, written; its ids are few enough to broadcast."""
    known = labels.select(
        F.col("doc_id").alias("_id"), (F.col("toxic") > 0).cast("int").alias("toxic")
    ).filter(F.col("_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.filter(~held_out(F.col("_id"), how.folds))
    known = known.groupBy("_id").agg(F.max("toxic").alias("toxic"))
    bounded = known.orderBy(F.xxhash64("_id"), "_id").limit(how.max_rows)
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(bounded), "_id").groupBy("_id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic")
    )
    return written(docs.sparkSession, rows.select("text", "toxic"), "labelled")


def train(
    docs: DataFrame, labels: DataFrame, how: Supervision, text: str, doc_id: str
) -> tuple[Voters, np.ndarray, float]:
    """Voters with the classifier's weights and intercept."""
    sample = _labelled(docs, labels, how, text, doc_id)
    voters = Voters(mined_stems(sample, how))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [voters.counts(t).tolist() for t in batch.column(0).to_pylist()]
            arrays = [pa.array(counts, pa.list_(pa.float64())), batch.column(1)]
            yield pa.RecordBatch.from_arrays(arrays, ["counts", "toxic"])

    rows = sample.mapInArrow(vote, "counts array<double>, toxic int").toPandas()
    model = LabelModel(voters.size)
    if not len(rows):
        fired, prior = model.log_odds()
        return voters, np.concatenate([fired[:-1], np.zeros(voters.size)]), prior
    counts = np.array(rows["counts"].tolist())
    # The order in which rows arrive must not matter to the last digit.
    toxic = rows["toxic"].to_numpy(float)
    order = np.lexsort([toxic, *counts.T])
    counts, toxic = counts[order], toxic[order]
    belief = model.fit(voters.votes(counts).astype(float), toxic, how.rounds)
    weights, start = fit_linear(voters.features(counts), belief)
    return voters, weights, start


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    how: Supervision = Supervision(),
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row; scoring shuffles nothing."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, how, text, doc_id))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        held_out(F.col(doc_id), how.folds).alias("held_out"),
        F.col(text).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters, weights, start = model.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            counts = np.array([voters.counts(t) for t in texts]).reshape(-1, voters.size)
            raw = voters.features(counts) @ weights + start
            score = np.round(1 / (1 + np.exp(-np.clip(raw, -30, 30))), 6)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(score),
                    pa.array(score >= how.threshold).cast(pa.int32()),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
