"""Each operator against a brute-force version, a library, a round trip or held-out labels."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from winnower.llm import queries, token_files
from winnower.llm.conversations import (
    escaped,
    formatted_turn,
    read_turn,
    to_turns,
    unescaped,
    unmapped,
)
from winnower.llm.decontaminate import Index, OverlapRule, find_contamination, words_of
from winnower.llm.files import file_system
from winnower.llm.id_coder import Shares, decode, encode
from winnower.llm.language_id import Languages, suffix_automaton
from winnower.llm.simhash import (
    connected_components,
    fingerprint,
    link_shard,
    route,
    routing_tree,
    simhash_components,
)
from winnower.llm.token_counts import MergeRules, WordCounts, text_tokens
from winnower.llm.token_files import WordIds, _read_file, _write_file
from winnower.llm.warc import read_archives, warc_record, write_archives

MIDDLE = "/root/testdata/sf0.01"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = st.text(st.sampled_from(" ▁\n\tab<s>/é́ñ你🙂 the,.!'x0"), max_size=40)


def documents(spark):
    return spark.read.parquet(f"{MIDDLE}/documents.parquet")


# Token counts and token files


@pytest.fixture(scope="module")
def pieces():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PIECES), WordCounts(MergeRules(PIECES))


@settings(max_examples=300, deadline=None)
@given(text=ODD)
def test_merging_counts_as_the_library(pieces, text):
    library, counts = pieces
    assert text_tokens(text, counts) == len(library.encode(text))


def test_token_counts_of_all_documents(spark, pieces):
    texts = {row.doc_id: row.text for row in documents(spark).collect()}
    for row in queries.op2_token_counts(spark, MIDDLE).collect():
        n = len(pieces[0].encode(texts[row.doc_id]))
        assert (row.n_tokens, row.n_bytes) == (n, len(texts[row.doc_id].encode()))
        assert row.over_limit == (n > 4096)


@pytest.fixture(scope="module")
def words():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS), WordIds(WORDS)


@settings(max_examples=300, deadline=None)
@given(text=ODD | st.sampled_from(["it's, o'clock. <|endoftext|>", "x.'s y!?.", "a<|endoftext|>,b"]))
def test_words_encode_as_the_library(words, text):
    library, own = words
    ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4")
    assert own.of_text(text) == ids.tobytes()


def test_token_files_of_all_documents(spark, words):
    start, expected = 0, []
    for row in documents(spark).orderBy("doc_id").collect():
        ids = [*words[0].encode(row.text, add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        expected.append((row.doc_id, start, len(ids), crc))
        start += len(ids)
    found = queries.op9_token_output(spark, MIDDLE).orderBy("doc_id").collect()
    assert [tuple(row) for row in found] == expected


@settings(max_examples=25, deadline=None)
@given(sizes=st.lists(st.integers(0, 60), max_size=5), seed=st.integers(0, 99))
def test_coder_round_trip(sizes, seed):
    rng = np.random.default_rng(seed)
    sizes = sorted(sizes, reverse=True)
    blocks = [rng.choice([0, 1, 7, 4096, 49407, 65535], size).astype(np.int32) for size in sizes]
    for block, again in zip(blocks, decode(encode(blocks), sizes), strict=True):
        assert (block == again).all()


def test_coder_learns_repetition():
    block = np.array([5, 900, 77] * 600, np.int32)
    rng = np.random.default_rng(1)
    noise = rng.integers(0, 65536, 1800).astype(np.int32)
    assert len(encode([block])[0]) < 500 < 3000 < len(encode([noise])[0])


def test_damaged_files_are_noticed(tmp_path):
    ids = np.arange(9000, dtype="<u4").tobytes()
    name, total = _write_file(str(tmp_path), 0, [1, None], [ids, ids[:40]])
    data = (tmp_path / name).read_bytes()
    assert total == 9010 and list(_read_file(data)) == [(1, ids), (None, ids[:40])]
    for place in (20, len(data) // 2, len(data) - 1):
        broken = bytearray(data)
        broken[place] ^= 1
        with pytest.raises((ValueError, zlib.error)):
            list(_read_file(bytes(broken)))


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.characters(max_codepoint=0x17F), max_size=40) | st.text(st.sampled_from("aZ5é́Íß.'<|\x0b\xa0 "), max_size=20))
def test_latin_words_encode_as_the_library(words, text):
    library, own = words
    ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4")
    assert own.of_text(text) == ids.tobytes()


def test_every_plain_character_encodes_as_the_library(words):
    library, own = words
    for code in range(0x21, 0x180):
        text = f"{chr(code)} x{chr(code)}y{chr(code)} {chr(code)}{chr(code)}9"
        ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4")
        assert own.of_text(text) == ids.tobytes()


def test_runs_of_plain_words_are_tokenized_once():
    class Counted:
        def __init__(self, model):
            self.model, self.seen = model, []

        def tokenize(self, run):
            self.seen.append(run)
            return self.model.tokenize(run)

    own = WordIds(WORDS)
    own.model, own.tokenizer = Counted(own.model), None
    texts = pa.array(["The cat. the CAT, cat!", None, "", "cat,The."])
    ids = list(own.of_texts(texts))
    assert sorted(own.model.seen) == ["!", ",", ".", "cat", "the"]
    assert ids[1:3] == [b"", b""] and len(ids) == 4 and len(ids[3]) == 4 * 4


def test_texts_of_several_calls_and_slices(words, monkeypatch):
    library, own = words
    texts = pa.array(["skipped", "one two", None, "", " three\tfour ", "é " * 30, "five"])[1:]
    monkeypatch.setattr(token_files, "_LETTERS_AT_ONCE", 12)
    expected = [library.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    assert list(own.of_texts(texts)) == [np.array(ids, "<u4").tobytes() for ids in expected]


@settings(max_examples=25, deadline=None)
@given(seed=st.integers(0, 99), kinds=st.sampled_from([1, 2, 300, 65536]), skew=st.floats(0, 3))
def test_coder_round_trip_with_shares(seed, kinds, skew):
    rng = np.random.default_rng(seed)
    share = np.arange(1, kinds + 1) ** -skew
    ids = rng.permutation(65536)[rng.choice(kinds, 700, p=share / share.sum())].astype(np.int32)
    blocks = [ids[:300], ids[300:600], ids[600:]]
    shares = Shares(np.bincount(ids, minlength=65536))
    again = decode(encode(blocks, shares), [300, 300, 100], shares)
    assert (np.concatenate(again) == ids).all()


def test_files_are_near_the_entropy_of_their_ids(tmp_path):
    share = 1 / np.arange(1, 5001)
    share /= share.sum()
    ids = np.random.default_rng(5).choice(5000, 200_000, p=share).astype("<u4")
    name, _ = _write_file(str(tmp_path), 0, [1], [ids.tobytes()])
    data = (tmp_path / name).read_bytes()
    assert [bytes(found) for _, found in _read_file(data)] == [ids.tobytes()]
    assert len(data) * 8 / len(ids) < 0.5 - (share * np.log2(share)).sum()


# Near-duplicates


def _slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).translate(
        dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=100, deadline=None)
@given(text=st.text(st.sampled_from("aB É\t\n\x0b　 x\x1c"), max_size=30))
def test_fingerprint_is_the_bit_majority(text):
    assert fingerprint(text) == _slow_fingerprint(text)


def _brute_components(points, max_bits):
    label = list(range(len(points)))
    close = np.bitwise_count(points[:, None] ^ points[None]) <= max_bits
    while True:
        after = [min(label[j] for j in np.flatnonzero(row)) for row in close]
        if after == label:
            return label
        label = after


def _clustered(seed, centres, size):
    rng = random.Random(seed)
    points = set()
    for _ in range(centres):
        point = rng.getrandbits(64)
        for _ in range(size):
            points.add(point)
            for _ in range(rng.randint(1, 4)):
                point ^= 1 << rng.randrange(64)
    return np.array(sorted(points), np.uint64)


@pytest.mark.parametrize("centres, size", [(1, 700), (40, 12), (700, 1), (3, 200)])
def test_shard_links_equal_brute_force(centres, size):
    points = _clustered(centres, centres, size)
    assert link_shard(points, 3) == _brute_components(points, 3)


def test_close_points_meet_in_a_shard():
    points = _clustered(3, 60, 8)
    nodes = routing_tree(points[::5], 16, 3)
    shard, index = route(points, nodes, 3)
    visits = defaultdict(set)
    for s, i in zip(shard.tolist(), index.tolist(), strict=True):
        visits[i].add(s)
    close = np.bitwise_count(points[:, None] ^ points[None]) <= 3
    assert all(visits[a] & visits[b] for a, b in zip(*np.nonzero(close), strict=True))
    assert len(set(shard.tolist())) > 8


def test_components_of_all_documents(spark):
    rows = documents(spark).collect()
    marks = {row.doc_id: fingerprint(row.text) for row in rows}
    points = np.array(sorted(set(marks.values())), np.uint64)
    labels = dict(zip(points.tolist(), _brute_components(points, 3), strict=True))
    least = defaultdict(lambda: 1 << 62)
    for doc, mark in marks.items():
        least[labels[mark]] = min(least[labels[mark]], doc)
    expected = {doc: (f"{m:016x}", least[labels[m]]) for doc, m in marks.items()}
    found = queries.op7_simhash(spark, MIDDLE).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == expected
    one_shard = simhash_components(documents(spark), points_per_shard=20).collect()
    assert {r.doc_id: r.component_id for r in one_shard} == {d: c for d, (_, c) in expected.items()}


def test_a_long_chain_is_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    links = links.union(spark.createDataFrame([(1000, 1001), (1003, 1001)], "a long, b long"))
    found = {r.node: r.root for r in connected_components(spark, links).collect()}
    assert found == {n: 0 for n in range(1, 301)} | {1001: 1000, 1003: 1000}


# Decontamination


def test_block_max_search_misses_nothing():
    rng = random.Random(4)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    items = [(i, [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))], []) for i in range(120)]
    index = Index(items)
    whole = Index.__new__(Index)
    whole.__dict__ = index.__dict__ | {"block_max": np.full_like(index.block_max, 1.0)}
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 400))]
        at = rng.randrange(len(words))
        words[at:at] = items[rng.randrange(120)][1]
        assert dict(index.retrieve(words, 0.5)) == dict(whole.retrieve(words, 0.5))


def _shared(item, words):
    grams = [tuple(item[i : i + 3]) for i in range(len(item) - 2)]
    own = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
    return sum(g in own for g in grams) / max(1, len(grams))


def test_contamination_of_all_documents(spark):
    items = [(r.item_id, words_of(r.text)) for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()]
    expected = set()
    for row in documents(spark).collect():
        words = words_of(row.text)
        expected |= {(row.doc_id, i) for i, item in items if _shared(item, words) >= 0.5}
    found = queries.op3_decontaminate(spark, MIDDLE).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(expected) > 10


def test_planted_items_are_found(spark):
    words = [f"word{i}" for i in range(400)]
    item, other = words[100:150], words[300:330]
    edited = [w if i % 12 else "edit" for i, w in enumerate(item)]
    docs = [(1, words), (2, item), (3, words[:90] + edited + words[200:]), (4, item[:12] + words[350:]),
            (5, other[::-1])]
    docs = spark.createDataFrame([(i, " ".join(w).title()) for i, w in docs], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(item), " ".join(other))], "item_id long, q string, a string")
    halves = find_contamination(docs, items, item_text="q").collect()
    assert {r.doc_id for r in halves} == {1, 2, 3}
    both = find_contamination(docs, items, OverlapRule(), item_text="q", item_answer="a").collect()
    assert {r.doc_id for r in both} == {1, 3}


# Language and toxicity


def test_automaton_spells_just_the_substrings():
    text = "abcbc abc"
    moves = suffix_automaton(text)
    substrings = {text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)}

    def spelled(word):
        state = 0
        for c in word:
            if c not in moves[state]:
                return False
            state = moves[state][c]
        return True

    assert all(map(spelled, substrings))
    assert not any(map(spelled, {a + b for a in "abc " for b in "abc "} - substrings))


@settings(max_examples=50, deadline=None)
@given(text=st.text("abcß .", max_size=60))
def test_phrases_are_longest_matches(text):
    model = Languages({"x": ["abcabba"], "y": ["cc ßa"]})
    codes, letters = model._codes(text)
    if not letters:
        assert model.predict([text]) == [("und", 0.0)]
        return
    lanes = codes[None].astype(np.uint16)
    for language, training in enumerate(["abcabba", "cc ßa"]):
        training_codes = "".join(chr(model.codes[c]) for c in training)
        rest, phrases = "".join(map(chr, codes)), 0
        while rest:
            size = max((k for k in range(1, len(rest) + 1) if rest[:k] in training_codes), default=1)
            rest, phrases = rest[size:], phrases + 1
        assert model._phrases(lanes, np.array([len(codes)]))[language, 0] == phrases


def test_held_out_languages(spark):
    langs = {r.doc_id: r.lang for r in documents(spark).collect()}
    found = queries.op4_language_id(spark, MIDDLE).collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert sum(langs[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_toxicity(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    found = queries.op8_toxicity(spark, MIDDLE).collect()
    held = [r for r in found if r.held_out and r.doc_id in labels]
    alarms = [r for r in held if r.predicted]
    assert all(labels[r.doc_id] for r in alarms)  # the labels also hold random errors,
    assert len(alarms) >= 0.4 * sum(labels[r.doc_id] for r in held)  # which nothing can find
    insults = {"idiot", "scum", "moron", "pathetic", "trash", "worthless"}
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    hits = {d for d, t in texts.items() if len(insults & set(words_of(t))) > 1}
    assert hits <= {r.doc_id for r in found if r.predicted}


# Quality rules and mixing are compared with their SQL in test_oracles.py


# Archives and conversations


def test_archive_records(spark, tmp_path):
    pages = spark.read.parquet(f"{MIDDLE}/pages.parquet")
    folder = str(tmp_path / "archives")
    index = write_archives(pages, folder)
    texts = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    largest = {}
    for page, payload in sorted(texts.items()):
        largest[payload] = page
    store, base = file_system(folder)
    assert len(store.get_file_info(__import__("pyarrow").fs.FileSelector(base))) >= 1
    some = index.filter("page_id % 7 = 3")
    for r in read_archives(some, folder).collect():
        payload = texts[r.page_id]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), digest)
        head = largest[payload]
        assert r.record_type == ("response" if head == r.page_id else "revisit")
        assert r.refers_to == (None if head == r.page_id else head)
        assert r.payload == (payload if head == r.page_id else None)
    assert read_archives(some, folder).count() == some.count() > 10


def test_record_bytes():
    record = warc_record(5, "http://a/\r\nX: y", b"<p>", None, "2000-01-01T00:00:00Z")
    head, _, rest = record.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"\nX: y" not in head
    length = int(head.split(b"\r\nContent-Length: ")[1].split(b"\r\n")[0])
    assert rest[length:] == b"\r\n\r\n" and rest[:length].endswith(b"\r\n\r\n<p>")


CONTROLS = ["<|end|>", "|>", "<|", "</s>", "<s>", "[INST]", "[/INST]", "\\", "\\\\<|", "<", "|", ">", "a", "\n"]


@settings(max_examples=15, deadline=None)
@given(turns=st.lists(st.tuples(*2 * [st.lists(st.sampled_from(CONTROLS), max_size=6).map("".join)]),
                      min_size=1, max_size=30))
def test_escaping_is_reversible(spark, turns):
    rows = spark.createDataFrame(turns, "role string, text string")
    formatted = rows.withColumn("f", formatted_turn(F.col("role"), F.col("text")))
    role, text = read_turn(F.col("f"))
    read = formatted.select("role", "text", role.alias("r"), text.alias("t"), escaped(F.col("text")).alias("e"),
                            unescaped(escaped(F.col("text"))).alias("u"))
    for row in read.collect():
        assert (row.r, row.t, row.u) == (row.role, row.text, row.text)
        assert not any(c in row.e for c in ("<|", "|>", "</s>", "<s>", "[INST]", "[/INST]"))


def test_layouts_become_turns(spark):
    records = [
        (1, '{"prompt":"p","completion":"c"}'),
        (2, '{"output":"o","instruction":"i","input":""}'),
        (3, '{"input":"x","output":"o","instruction":"i"}'),
        (4, '{"messages":[{"role":"system","content":"s"},{"content":"u","role":"user"}]}'),
        (5, '{"conversations":[{"from":"human","value":"h"},{"from":"gpt","value":"g"}]}'),
        (6, '{"text":null,"role":"assistant"}'),
        (7, '{"question":"q"}'),
        (8, None),
        (9, "broken"),
    ]
    frame = spark.createDataFrame(records, "id long, record string")
    turns = defaultdict(list)
    for r in to_turns(frame).orderBy("id", "at").collect():
        turns[r.id].append((r.role, r.text))
    assert dict(turns) == {
        1: [("user", "p"), ("assistant", "c")],
        2: [("user", "i"), ("assistant", "o")],
        3: [("user", "i\nx"), ("assistant", "o")],
        4: [("system", "s"), ("user", "u")],
        5: [("user", "h"), ("assistant", "g")],
        6: [("assistant", "")],
    }
    unknown = Counter({tuple(r.fields or ()): r.rows for r in unmapped(frame).collect()})
    assert unknown == {("question",): 1, (): 2}
