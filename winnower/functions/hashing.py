"""Content keys and the seeded score that decides sampling."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCORE_BITS = 160


def content_key(question: Column, response: Column) -> Column:
    """20-byte key of a normalised pair, blind to case."""
    return F.unhex(F.sha1(F.concat(F.lower(question), F.lit("\n"), F.lower(response))))


def score_hex(key: Column, seed: int) -> Column:
    """Seeded 160-bit score of a content key, as 40 lowercase hex digits."""
    return F.sha1(F.concat(F.unhex(F.lit(f"{seed:016x}")), key))


def score_value(hex_digits: Column) -> Column:
    """Score as a double in [0, 1), for display; sampling compares hex digits."""
    high = F.conv(F.substring(hex_digits, 1, 13), 16, 10).cast("double")
    low = F.conv(F.substring(hex_digits, 14, 13), 16, 10).cast("double")
    return high * F.lit(2.0**-52) + low * F.lit(2.0**-104)


def score_bound(probability: float) -> str:
    """Hex digits ``t`` such that ``score < probability`` is ``hex < t``.

    A 160-bit score is compared as the nearest double, and Spark has no type
    for it. The smallest score that rounds to ``probability`` or more lies at
    the midpoint between that double and the one before it, found here in exact
    arithmetic; hex digits of equal length then compare as text.
    """
    if not 0.0 < probability <= 1.0:
        raise ValueError(f"selection probability {probability} is not in (0, 1]")
    scale = 2**_SCORE_BITS
    below = Fraction(math.nextafter(probability, 0.0))
    bound = math.ceil((below + Fraction(probability)) / 2 * scale)
    if float(bound) / float(scale) < probability:
        bound += 1
    return f"{bound:040x}"


def is_sampled(score: Column, probability: float) -> Column:
    return score < F.lit(score_bound(probability))
