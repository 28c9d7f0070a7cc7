"""The prefix trie against plain dictionaries of whole prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from winnower.llm.prefix_trie import Matrix, TrieBounds, prefix_trie
from winnower.llm.queries import op13_prefix_trie

SMALL = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]


def _md5(role, text):
    return hashlib.md5(f"{len(role)}\n{role}\n{text}".encode()).digest()


def _plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, _md5(role, text), role, text))
    own = {conv: [t[3:] for t in sorted(turns)] for conv, turns in own.items()}
    said = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        said[conv] = (*own.get(conv // 20 * 20, [])[:h], *turns[h:])
    nodes = defaultdict(list)
    for conv, turns in said.items():
        for depth in range(len(turns) + 1):
            nodes[turns[:depth]].append(conv)
    children = defaultdict(list)
    for node in nodes:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(nodes, key=len, reverse=True):
        below = [sums[child] for child in children[node]]
        words = len(WORD.findall(node[-1][1])) if node else 0
        leaves = sum(x for x, _ in below) if below else 1
        sums[node] = leaves, sum(x for _, x in below) + (len(nodes[node]) - 1) * words
    rows = []
    for node, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(said[c]) == len(node))))
        parent = min(nodes[node[:-1]]) if node else None
        hashed = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((min(members), len(node), parent, len(members), len(children[node]), *sums[node], hashed))
    return sorted(rows, key=str)


def _found(spark, rows, bounds):
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    table = table.selectExpr("*", "'own' as id", "'own' as seg", "'own' as words", "'own' as piece")
    found = prefix_trie(table, bounds)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=str)


def _dialogues(seed, convs, depth, turns):
    """Conversations that share beginnings; some start anywhere, some twice."""
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        size = rng.randint(0, depth)
        copied = rng.random() < 0.3
        for turn in range(size):
            text = f"same {turn}" if copied else f"{'x ' * rng.randint(0, 3)}{rng.randint(0, turns)}"
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", text))
    rng.shuffle(rows)
    return rows


BOUNDS = [TrieBounds(), TrieBounds(2, 3, 2), TrieBounds(3, 50, 4), TrieBounds(1, 1, 1)]


@pytest.mark.parametrize("bounds", BOUNDS, ids=str)
def test_random_dialogues(spark, bounds):
    rows = _dialogues(4, 90, 9, 2)
    assert _found(spark, rows, bounds) == _plain(rows)


def test_one_huge_conversation_and_a_copy_of_it(spark, monkeypatch):
    """Spans of segments are summed apart; both conversations cross many blocks."""
    monkeypatch.setattr("winnower.llm.prefix_trie._SEGMENTS_PER_SPAN", 3)
    rows = [(conv, turn, "user", f"turn {turn}") for conv in (40, 41) for turn in range(150)]
    rows += [(41, 150, "user", "one more")] + _dialogues(5, 30, 3, 1)
    assert _found(spark, rows, TrieBounds(4, 8, 2)) == _plain(rows)


def test_many_equal_conversations(spark):
    rows = [(conv, turn, "user", f"turn {turn}") for conv in range(300) for turn in range(4)]
    found = _found(spark, rows, TrieBounds(8, 16, 7))
    assert found == _plain(rows)
    assert len(found) == 5


def test_edge_cases(spark):
    rows = [(20, None, None, None), (20, 0, "user", ""), (20, 0, "user", ""), (20, 0, "user", "a b")]
    rows += [(None, 0, "user", "nobody"), (21, 3, "user", "x"), (45, 0, "user", "no base"), (46, 0, None, "")]
    rows += [(60, 0, "user", "long words " * 300_000), (61, 0, "user", "y"), (62, 1, "user", "y\n")]
    rows += [(c, 0, "user", "one turn") for c in range(80, 100)]  # some are left without a turn
    for bounds in (TrieBounds(), TrieBounds(1, 2, 1)):
        assert _found(spark, rows, bounds) == _plain(rows)
    assert _found(spark, [(None, 0, "user", "nobody")], TrieBounds()) == []
    turnless = [(c, 0, "user", "x") for c in range(45, 60) if zlib.crc32(str(c).encode()) % 4]
    found = _found(spark, turnless, TrieBounds())
    assert found == _plain(turnless) and [row[1:7] for row in found] == [(0, None, len(turnless), 0, 1, 0)]


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    assert sorted(map(tuple, op13_prefix_trie(spark, SMALL).collect()), key=str) == _plain(rows)


def test_matrix_marks_nodes_by_column():
    """Three rows a b, a, a b c: one node of depths 1 and 2, and a padded row above them."""
    ids = {"a": 5, "b": -7, "c": 2}
    said = ["ab", "a", "abc"]
    flat = np.array([ids[c] for turns in said for c in turns])
    block = {
        "conv": np.array([3, 1, 2]),
        "seg": np.zeros(3, np.int64),
        "x": np.zeros(3, np.int64),
        "y": np.zeros(3, np.int64),
        "last": np.ones(3, bool),
        "n": np.array([len(turns) for turns in said]),
        "u": flat,
        "v": flat,
        "words": np.ones(len(flat), np.int64),
    }
    matrix = Matrix(block, 8)
    assert matrix.conv.tolist() == [1, 3, 2]
    spans = [list(zip(level.start.tolist(), level.end.tolist(), strict=True)) for level in matrix.levels]
    assert spans == [[(0, 3)], [(0, 3)], [(1, 3)], [(2, 3)]]
