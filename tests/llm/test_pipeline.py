"""Every stage of the pipeline against a brute-force version, each on what the one before kept."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from winnower.llm.decontaminate import words_of
from winnower.llm.mixing import mix_sql
from winnower.llm.simhash import fingerprint
from winnower.storage import written

MIDDLE = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SPLIT = re.compile("[ \t-\r]+")


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage, and what the last one gives."""
    tables = [spark.read.parquet(f"{MIDDLE}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(written(spark, stage(spark, tables[-1], MIDDLE), name.replace(" ", "-")))
    return tables


def _rows(table):
    return {row.doc_id: row for row in table.collect()}


def test_stages_keep_the_columns(stages):
    assert [table.columns for table in stages[:-1]] == 5 * [COLUMNS]
    counts = [table.count() for table in stages]
    assert counts[0] > counts[1] > counts[2] > counts[3] > counts[4] == counts[5] > 100


def _words(text):
    return [w for w in SPLIT.split(text) if w]


def _normal(line):
    return re.sub("[ \t\x0b\x0c\r]+", " ", re.sub("[1-9]", "0", line.lower())).strip(" ")


def _sketches(lines):
    marks = [hashlib.md5(line.encode()).hexdigest() for line in set(lines)]
    taken = min((len(marks) + 1) // 2, 6)
    first = (" ".join(sorted(mark[2 * i :] for mark in marks)[:taken]) for i in range(12))
    return [hashlib.md5(lines.encode()).hexdigest()[:15] for lines in first]


def _cleaned(docs):
    """Kept texts by the base rules and line frequency, counted in plain loops."""
    texts, common = defaultdict(set), Counter()
    for row in docs.values():
        texts[row.source].add(row.text)
    lines = {text: [_normal(x) for x in text.split("\n") if _words(x)] for of in texts.values() for text in of}
    for host, of in texts.items():
        common.update((host, mark) for text in of if lines[text] for mark in enumerate(_sketches(lines[text])))
    marks = {
        (host, text): [(host, *mark) for mark in enumerate(_sketches(lines[text]))]
        for host, of in texts.items() for text in of if lines[text]
    }
    best = {key: max((common[h, (i, s)], -i, s) for h, i, s in of) for key, of in marks.items()}
    leads = defaultdict(list)
    for key, of in marks.items():
        for mark in of:
            leads[mark].append(best[key])
    found = defaultdict(set)
    for (host, text), of in marks.items():
        top = max(max(leads[mark]) for mark in of)
        for line in lines[text]:
            found[host, line].add(top[1:] if top[0] > 1 else text)
    bad = {key for key, groups in found.items() if len(groups) >= 10}
    kept = {}
    for doc_id, row in docs.items():
        words = _words(row.text)
        windows = list(zip(words, words[1:], words[2:], strict=False))
        often = Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
        if len(words) < 50 or 100 * len(repeated) > 50 * len(words):
            continue
        lines = row.text.split("\n")
        left = [x for x in lines if not _words(x) or (row.source, _normal(x)) not in bad]
        if 2 * len(_words("\n".join(left))) >= len(words):
            kept[doc_id] = "\n".join(left)
    return kept, bad


def test_quality_stage(stages):
    expected, boilerplate = _cleaned(_rows(stages[0]))
    assert {doc: row.text for doc, row in _rows(stages[1]).items()} == expected
    assert boilerplate


def test_near_duplicate_stage(stages):
    marks = {doc: fingerprint(row.text) for doc, row in _rows(stages[1]).items()}
    points = np.array(sorted(set(marks.values())), np.uint64)
    close = np.bitwise_count(points[:, None] ^ points[None]) <= 3
    label = np.arange(len(points))
    while True:
        after = np.array([label[row].min() for row in close])
        if (after == label).all():
            break
        label = after
    group = dict(zip(points.tolist(), label.tolist(), strict=True))
    first = {}
    for doc in sorted(marks):
        first.setdefault(group[marks[doc]], doc)
    assert set(_rows(stages[2])) == set(first.values())


def test_decontamination_stage(spark, stages):
    items = [words_of(r.text) for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()]
    grams = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in items]
    clean = set()
    for doc, row in _rows(stages[2]).items():
        words = words_of(row.text)
        own = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
        if all(len(g & own) < 0.5 * len(g) for g in grams):
            clean.add(doc)
    assert set(_rows(stages[3])) == clean


def test_mixing_stage(stages):
    documents = stages[3].toPandas()  # noqa: F841  read by DuckDB
    rows = duckdb.sql(mix_sql()).fetchall()
    assert {doc for doc, *_, sampled in rows if sampled} == set(_rows(stages[4]))


def test_token_stage_and_run(spark, stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, expected = 0, []
    for doc, row in sorted(_rows(stages[4]).items()):
        ids = [*library.encode(row.text, add_special_tokens=False).ids, 2]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(row) for row in stages[5].collect()) == expected
    assert sorted(tuple(row) for row in corpus_pipeline.run(spark, MIDDLE).collect()) == expected
