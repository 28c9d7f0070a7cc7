"""Language identification: predictions against plain longest matches, and the training sample."""

from __future__ import annotations

import math
import zlib

import numpy as np
import xxhash

from winnower.llm.language_id import SEGMENT, Training, _letters, identify_language, train

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string"


def _plain_prediction(text, trained, codes_of):
    """(language, score) by searching each training text for ever longer runs."""
    codes, letters = codes_of(text or "")
    if not letters:
        return "und", 0.0
    written = "".join(map(chr, codes))
    names, entropies = sorted(trained), []
    for name in names:
        phrases = 0
        for start in range(0, len(written), SEGMENT):
            rest = written[start : start + SEGMENT]
            while rest:
                size = 1
                while size < len(rest) and rest[: size + 1] in trained[name][0]:
                    size += 1
                rest, phrases = rest[size:], phrases + 1
        entropies.append(phrases * trained[name][1] / len(codes))
    best = int(np.argmin(entropies))
    power = min(1.0, len(codes) / 100) * 24.0 / max(entropies[best], 1e-9)
    odds = sum(math.exp(-(entropy - entropies[best]) * power) for entropy in entropies)
    return names[best], round(1 / odds, 6)


def test_predictions_of_a_whole_table_equal_plain_longest_matches(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    training = Training(characters=4_000)
    model = train(docs, training, "text", "doc_id", "lang")
    by_name = dict(zip(model.names, model.weights, strict=True))
    texts = _sampled(docs.select("doc_id", "text", "lang").collect(), training)
    trained = {}
    for name, own in texts.items():
        joined = " ".join("".join(_letters(text)) for text in own)
        trained[name] = "".join(chr(model.codes[c]) for c in joined), by_name[name]
    found = {r.doc_id: (r.lang_pred, r.score) for r in identify_language(docs, training).collect()}
    for row in docs.collect():
        name, score = _plain_prediction(row.text, trained, model._codes)
        assert found[row.doc_id][0] == name
        assert abs(found[row.doc_id][1] - score) < 2e-6


def _sampled(rows, training):
    """The texts that training takes, chosen in plain loops."""

    def spark_hash(text):
        first = xxhash.xxh64_intdigest(text.encode(), seed=42)
        second = xxhash.xxh64_intdigest(b"language sample", seed=first)
        return second - (1 << 64) if second >> 63 else second

    texts = {}
    for row in rows:
        if row.text is not None and row.lang is not None and zlib.crc32(str(row.doc_id).encode()) % 3 != 1:
            texts.setdefault(row.lang, set()).add(row.text)
    chosen = {}
    for lang, own in texts.items():
        ordered = sorted(own, key=lambda t: (max(len(t), training.long_text), spark_hash(t)))
        room = training.characters
        for place, text in enumerate(ordered[: training.docs_per_language]):
            if len(text) <= room or not place:
                chosen.setdefault(lang, []).append(text)
                room -= len(text)
    return {lang: sorted(own, key=spark_hash) for lang, own in chosen.items()}


def test_whole_texts_and_distinct_texts_are_learnt_from(spark):
    """A foreign header teaches nothing wrong, and copies take one place."""
    german = "der hund und die katze laufen durch den wald über die straße "
    english = "the dog and the cat are running through the woods across the street "
    rows = [(i, "#" * 7000 + german * 20, "de") for i in range(0, 300, 3)]
    rows += [(1000 + i, english * 3 + str(i % 2), "en") for i in range(300)]
    rows += [(2000 + i, f"{english} number {'x' * i}", "en") for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = train(docs, Training(docs_per_language=10), "text", "doc_id", "lang")
    assert model.names == ["de", "en"]
    assert model.predict([german])[0][0] == "de"
    assert model.predict(["across the woods"])[0][0] == "en"
    sampled = _sampled(docs.collect(), Training(docs_per_language=10))
    assert len(sampled["en"]) == 10 and len(sampled["de"]) == 1
    assert len(_letters(sampled["de"][0])) > 1000


def test_the_sample_is_bounded_by_characters(spark):
    rows = [(i, f"word{'abcdefghij'[i % 10]} " * 200 + str(i), "en") for i in range(100)]
    rows += [(500, "langer text " * 30_000, "de")]
    docs = spark.createDataFrame(rows, SCHEMA).filter("crc32(cast(doc_id as string)) % 3 <> 1")
    sampled = _sampled(docs.collect(), Training(characters=5_000))
    assert sum(map(len, sampled["en"])) <= 5_000
    model = train(docs, Training(characters=5_000), "text", "doc_id", "lang")
    assert "en" in model.names
