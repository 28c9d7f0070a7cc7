"""Text expressions: coercion, whitespace, runs and repeated tokens.

Everything is a built-in Spark expression on one row, so it fuses into the
scan stage and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 29 whitespace code points of Unicode as Python's ``str.strip`` knows them.
# Java's ``\s`` misses 23 of them, with or without the Unicode flag. Code points
# below U+0100 are listed one by one because Java tests those with one bit set,
# and the others hide behind a range test that Latin text fails at once; this
# is three times faster than the same class written as plain ranges.
_LATIN_NOT_SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
_BEYOND_LATIN = (
    r"[\x{1680}-\x{3000}"
    r"&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
)
WHITESPACE_RUN = rf"[\x20{_LATIN_NOT_SPACE}{_BEYOND_LATIN}]+"
# Whitespace that normalising would change, other than at the two ends.
_UNTIDY = rf"[{_LATIN_NOT_SPACE}{_BEYOND_LATIN}]|\x20\x20"

# Below this share so many tokens qualify that counting all of them is cheaper.
_SMALL_SHARE = 0.05


def text_field(df: DataFrame, name: str) -> Column:
    """Field as text; a missing column, NULL, 0 and false all become ``""``."""
    if name not in df.columns:
        return F.lit("")
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.coalesce(column, F.lit(""))
    if isinstance(kind, T.BooleanType):
        return F.when(column, F.lit("True")).otherwise(F.lit(""))
    text = column.cast("string")
    if isinstance(kind, T.NumericType):
        return F.when(column != 0, text).otherwise(F.lit(""))
    return F.coalesce(text, F.lit(""))


def literal_field(df: DataFrame, name: str, null_as: str = "None") -> Column:
    """Field as text where NULL becomes ``null_as`` and a missing column ``""``."""
    if name not in df.columns:
        return F.lit("")
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.BooleanType):
        column = F.when(column, F.lit("True")).when(~column, F.lit("False"))
    return F.coalesce(column.cast("string"), F.lit(null_as))


def normalise(text: Column) -> Column:
    """Strip, and turn every run of Unicode whitespace into one space.

    Text that is tidy already skips the replacement, which would otherwise
    rebuild the string at every single space.
    """
    tidied = F.when(text.rlike(_UNTIDY), F.regexp_replace(text, WHITESPACE_RUN, " "))
    return F.trim(tidied.otherwise(text))


def text_length(text: Column) -> Column:
    """Length in code points."""
    return F.char_length(text)


def token_count(normalised: Column) -> Column:
    """Number of space-separated tokens of normalised text; empty text has none."""
    return F.when(normalised == "", F.lit(0)).otherwise(F.size(F.split(normalised, " ")))


def has_char_run(text: Column, length: int) -> Column:
    """Whether one code point repeats ``length`` times in a row.

    A run of ``length`` always covers one whole block of about half of that,
    counted from the start of the text. Looking at whole blocks first needs one
    comparison per block, not one per position; only texts with a uniform block
    reach the exact search.
    """
    if length <= 1:
        return F.lit(False)
    exact = text.rlike(rf"(?s)(.)\1{{{length - 1}}}")
    block = (length + 1) // 2
    if block < 4:
        return exact
    uniform_block = text.rlike(rf"(?s)\A(?:.{{{block}}})*?(.)\1{{{block - 1}}}")
    return uniform_block & exact


def top_token_share(normalised: Column) -> Column:
    """Share of the most frequent token; 1.0 if there is no token.

    Equal tokens are neighbours once sorted. Going through the positions, the
    longest run so far grows by one exactly where the token equals the one that
    many places back.
    """

    def longest_run(ordered: Column) -> Column:
        def extend(longest: Column, position: Column) -> Column:
            same = F.get(ordered, position) == F.get(ordered, position - longest)
            return F.when(same, longest + 1).otherwise(longest)

        return F.aggregate(F.sequence(F.lit(1), F.size(ordered) - 1), F.lit(1), extend)

    def share(ordered: Column) -> Column:
        return F.when(F.size(ordered) < 2, F.lit(1.0)).otherwise(
            longest_run(ordered) / F.size(ordered)
        )

    # A one-element array names the sorted tokens, so they are sorted once.
    return F.get(
        F.transform(F.array(F.sort_array(F.split(normalised, " "))), share), F.lit(0)
    )


def is_repetitive(normalised: Column, min_share: float, min_tokens: int) -> Column:
    """Whether text of ``min_tokens`` or more has a token of ``min_share`` or more.

    A token with that share fills a run of sorted tokens, and a run of n tokens
    or more covers one of the positions n, 2n, 3n... Counting just the tokens
    found there decides the rule with array built-ins, not a step per token.
    """
    share = F.lit(float(min_share))
    if min_share > 1:
        return F.lit(False)
    if min_share < _SMALL_SHARE:
        return (token_count(normalised) >= min_tokens) & (top_token_share(normalised) >= share)

    def share_reached(ordered: Column) -> Column:
        total = F.size(ordered)
        distance = F.greatest(F.ceil(total * share) - 1, F.lit(1)).cast("int")

        def reached(position: Column) -> Column:
            others = F.array_remove(ordered, F.get(ordered, position - 1))
            return (total - F.size(others)) / total >= share

        return F.exists(F.sequence(distance, total, distance), reached)

    # ``exists`` over a one-element array names a value, so the text is split
    # and sorted once for all uses; too short a text is not split at all.
    return (text_length(normalised) >= 2 * min_tokens - 1) & F.exists(
        F.array(F.split(normalised, " ")),
        lambda words: (F.size(words) >= F.lit(min_tokens))
        & F.exists(F.array(F.sort_array(words)), share_reached),
    )
