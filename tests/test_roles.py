from __future__ import annotations

import random

import pytest

from winnower.operators.roles import role_check

SCHEMA = "conv_id long, turn long, role string"
KNOWN = ("user", "assistant", "system")


def _plain(roles):
    for at, role in enumerate(roles):
        before = roles[at - 1] if at else None
        if role not in KNOWN:
            return "unknown_role", at
        if role == "system" and at:
            return "late_system", at
        if (at == 0 or before == "system") and role == "assistant":
            return "answer_first", at
        if at and role == before:
            return "repeated_role", at
    return (None, None) if roles[-1] == "assistant" else ("open_end", len(roles) - 1)


def _expected(rows):
    talks = {}
    for conv, turn, role in rows:
        talks.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", role))
    return {
        conv: (len(turns), *(lambda roles: (roles[0], roles[-1], *_plain(roles)))([t[-1] for t in sorted(turns)]))
        for conv, turns in talks.items()
    }


def _found(spark, rows, parts):
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return {row[0]: tuple(row)[1:] for row in role_check(table).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(120):
        start = ["system"] if rng.random() < 0.3 else []
        roles = start + ["user", "assistant"] * rng.randint(0, 5)
        for _ in range(rng.randint(0, 2)):
            if roles:
                roles[rng.randrange(len(roles))] = rng.choice([*KNOWN, "bot", None])
        rows += [(conv, turn, role) for turn, role in enumerate(roles)]
    assert _found(spark, rows, 7) == _expected(rows)


def test_one_conversation_of_a_third_of_all_turns(spark):
    """It is cut into runs over tasks; a fault where two runs meet or within one is found."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for bad in (None, 0, 1, 2499, 2500, 2501, 4998):
            huge = [(0, turn, KNOWN[turn % 2]) for turn in range(5000)]
            if bad is not None:
                huge[bad] = (0, bad, KNOWN[(bad + 1) % 2])
            rest = [(c, turn, KNOWN[turn % 2]) for c in range(1, 2500) for turn in range(4)]
            assert _found(spark, huge + rest, 5) == _expected(huge + rest)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_edge_cases(spark):
    rows = [(1, None, "user"), (1, 0, "assistant"), (1, 0, "assistant"), (None, 0, "user"), (None, 1, "assistant")]
    rows += [(2, 0, None), (3, 5, "system"), (4, 0, "system"), (4, 1, "system"), (5, 1, ""), (6, 1, "User")]
    assert _found(spark, rows, 3) == _expected(rows)
    assert _found(spark, rows, 3)[1] == (3, "user", "assistant", "repeated_role", 2)
    assert role_check(spark.createDataFrame([], SCHEMA)).collect() == []
