"""Near-duplicate classes against a comparison of all sets."""

from __future__ import annotations

import random
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from winnower.operators.components import connected_classes
from winnower.operators.near_duplicates import Likeness, near_duplicate_classes
from winnower.storage import written

SCHEMA = "seq long, text string"


def _shingles(text, size=5):
    words = text.split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def _alike(a, b):
    return a == b or 100 * len(a & b) >= 80 * len(a | b)


def _plain(rows):
    """Class of each (seq, text) by union of all alike pairs."""
    sets = [(seq, _shingles(text or "")) for seq, text in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            if _alike(a, sets[j][1]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, (seq, _) in enumerate(sets):
        groups.setdefault(root(i), []).append(seq)
    return {sets[i][0]: min(groups[root(i)]) for i in range(len(sets))}


def _found(spark, rows, how=Likeness()):
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = near_duplicate_classes(table, F.col("text"), "seq", how)
    return {row["id"]: row["class_id"] for row in found.collect()}


def _text(rng, words=120, vocabulary=400):
    return [f"w{rng.randint(0, vocabulary)}" for _ in range(words)]


def _changed(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**9)}"
    return words


def _family(seed, families, members, changes):
    rng = random.Random(seed)
    texts = []
    for _ in range(families):
        base = _text(rng)
        texts += [base] + [_changed(rng, base, rng.randint(0, changes)) for _ in range(members)]
    rng.shuffle(texts)
    return [(i, " ".join(words)) for i, words in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_copies_equal_the_comparison_of_all(spark, seed):
    rows = _family(seed, families=30, members=4, changes=5)
    assert _found(spark, rows) == _plain(rows)


def test_recall_at_the_least_similarity(spark):
    """Of pairs of two texts at 0.80 to 0.85 nearly all are found; the docstring says 0.9998."""
    rng = random.Random(3)
    rows, wanted = [], []
    while len(wanted) < 150:
        base = _text(rng, 200, 10**6)
        other = _changed(rng, base, 4)
        a, b = _shingles(" ".join(base)), _shingles(" ".join(other))
        if 0.80 <= len(a & b) / len(a | b) <= 0.85:
            wanted.append((len(rows), len(rows) + 1))
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(other))]
    found = _found(spark, rows)
    assert sum(found[a] == found[b] for a, b in wanted) >= 0.99 * len(wanted)
    assert len(set(found.values())) >= len(wanted)


def test_crowded_buckets_are_linked_by_hubs(spark):
    """Buckets of more members than are compared with each other, of two families and strangers."""
    rng = random.Random(4)
    how = Likeness(whole_bucket=6)
    texts = []
    for _ in range(2):
        base = _text(rng)
        texts += [_changed(rng, base, rng.randint(0, 2)) for _ in range(60)]
    texts += [_text(rng) for _ in range(40)]
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    found, expected = _found(spark, rows, how), _plain(rows)
    assert sum(found[i] == expected[i] for i in expected) >= 0.98 * len(expected)
    for a, b in pairwise(sorted(expected)):  # no class joins what is not connected
        if found[a] == found[b]:
            assert expected[a] == expected[b]


def test_a_crowd_that_is_not_alike_costs_no_square(spark):
    """Variants of one text below the least similarity meet in buckets but are not all compared."""
    rng = random.Random(5)
    base = _text(rng, 150)
    rows = [(i, " ".join(_changed(rng, base, 5))) for i in range(300)]
    how = Likeness(whole_bucket=8)
    from winnower.operators import near_duplicates as own

    texts = spark.createDataFrame(rows, SCHEMA).select(F.col("seq").alias("id"), "text")
    nodes = own._signatures(texts, how)
    entries = own._entries(nodes, how, 1)
    buckets = own._buckets(entries, how, 1)
    met = entries.groupBy("band", "key").count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0]
    compared = own._candidates(entries, buckets, how).count()
    assert met > 20_000
    assert compared <= len(rows) * how.bands * (how.hubs + how.whole_bucket / 2)


def test_a_third_of_all_rows_is_one_group(spark):
    """The hub's set is copied for its spokes, so that no task holds a whole group."""
    rng = random.Random(6)
    base = _text(rng)
    rows = [(i, " ".join(_changed(rng, base, rng.randint(0, 1)))) for i in range(400)]
    rows += [(i, " ".join(_text(rng))) for i in range(400, 1200)]
    found = _found(spark, rows)
    expected = _plain(rows[:400])
    assert sum(found[i] == expected[i] for i in range(400)) >= 396
    assert all(found[i] == i for i in range(400, 1200))
    from winnower.operators import near_duplicates as own

    pairs = spark.range(10_000).select(
        F.encode(F.col("id").cast("string"), "utf-8").alias("a"), F.encode(F.lit("hub"), "utf-8").alias("b")
    )
    sets = pairs.select(F.col("a").alias("node")).union(pairs.select("b").distinct())
    sets = sets.withColumn("hashes", F.array(F.lit(1).cast("bigint")))
    plan = own._verified(pairs, sets, Likeness())
    assert plan.count() == 10_000
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in text and "Generate explode(sequence" in text


def test_only_texts_that_are_asked_for_are_built(spark):
    """A text in no pair is neither normalised nor hashed again."""
    from winnower.operators import near_duplicates as own

    how = Likeness()
    rows = [(1, "a b c d e f"), (2, "a b c d e g"), (None, "x y"), (3, "never built")]
    table = spark.createDataFrame(rows, "id long, raw string")
    signed = own._signatures(table.filter("id is null or id < 3").select("id", F.col("raw").alias("text")), how)
    nodes = signed.select("node", F.struct("id", "text_hash").alias("first"))
    a, b, c = (row["node"] for row in nodes.orderBy(F.col("first.id").asc_nulls_first()).collect())
    pairs = spark.createDataFrame([(b, a), (c, a)], "a binary, b binary")
    fails = F.raise_error(F.lit("built")).cast("string")
    texts = table.select("id", F.when(F.col("id") == 3, fails).otherwise(F.col("raw")).alias("text"))
    none = spark.createDataFrame([], "node binary, hashes array<bigint>")
    sets = own._with_sets_of(none, texts, nodes, pairs, how)
    assert {row["node"]: len(row["hashes"]) for row in sets.collect()} == {a: 1, b: 2, c: 2}


def test_longer_keys_are_made_of_open_nodes_alone(spark):
    from winnower.operators import near_duplicates as own

    how = Likeness()
    texts = spark.createDataFrame(_family(9, families=5, members=3, changes=2), SCHEMA)
    nodes = own._signatures(texts.select(F.col("seq").alias("id"), "text"), how).dropDuplicates(["node"])
    nodes = written(spark, nodes, "nodes")
    some = {bytes(row["node"]) for row in nodes.orderBy("node").limit(4).collect()}
    open_nodes = spark.createDataFrame([(band, node) for node in some for band in (0, 7)], "band int, node binary")
    wanted = own._entries(nodes, how, 2).join(open_nodes, ["band", "node"], "left_semi")
    found = own._open_entries(nodes, open_nodes, how, 2)
    columns = ["band", "key", "node", "n"]
    assert sorted(found.select(columns).collect()) == sorted(wanted.select(columns).collect())
    assert found.count() == 8
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan[plan.index("Generate") :]  # all keys of a node are made above it


def test_hubs_are_chosen_among_shared_entries_alone(spark):
    """What no other node has is dropped before hubs are made; the buckets stay the same."""
    from winnower.operators import near_duplicates as own

    how = Likeness()
    texts = spark.createDataFrame(_family(10, families=4, members=3, changes=3), SCHEMA)
    nodes = own._signatures(texts.select(F.col("seq").alias("id"), "text"), how)
    entries = written(spark, own._entries(nodes, how, 1), "entries")
    shared = own._shared(entries)
    met = {}
    for row in entries.collect():
        met.setdefault((row["band"], row["key"]), []).append(bytes(row["node"]))
    kept = sorted((band, key, node) for (band, key), all_of in met.items() if len(all_of) > 1 for node in all_of)
    assert sorted((row["band"], row["key"], bytes(row["node"])) for row in shared.collect()) == kept
    assert 0 < len(kept) < entries.count()
    columns = ["band", "key", "size", "hubs"]
    found, wanted = (own._buckets(rows, how, 1).select(columns) for rows in (shared, entries))
    assert sorted(found.collect()) == sorted(wanted.collect())


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (4, "a b"), (4, "a b"), (5, "b a")]
    rows += [(6, long), (7, long + " end"), (8, "one two three four five"), (9, "one two three four five")]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' as node", "'own' as n")
    found = near_duplicate_classes(table, F.col("text")).collect()
    assert sorted((str(r["id"]), r["class_id"]) for r in found) == [
        ("1", 1), ("2", 1), ("3", 3), ("4", 3), ("4", 3), ("5", 5), ("6", 6), ("7", 6), ("8", 8), ("9", 8), ("None", 3),
    ]
    assert near_duplicate_classes(table.limit(0), F.col("text")).collect() == []


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)]
    links += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 60)]
    parent = {n: n for pair in links for n in pair}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    found = connected_classes(spark.createDataFrame(links, "a long, b long"))
    loops = {a for a, b in links if a == b}
    expected = {n: root(n) for n in parent}
    got = {row["node"]: row["root"] for row in found.collect()}
    assert all(expected[n] == r for n, r in got.items())
    assert {n for n in expected if n not in got} <= {n for n in expected if root(n) == n} | loops
