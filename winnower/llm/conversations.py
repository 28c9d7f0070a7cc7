"""Chat formatting with schema fingerprints, in built-ins only.

Records arrive as JSON in unlike layouts: a prompt with its completion, an
instruction with its input and output, one message, or a list of messages under
names of its own. The nested field paths of a record, without values and types,
are its schema fingerprint; it selects a declarative mapping, which lists the
paths of the turns. Mapped records become canonical turns of role and text.

The template writes a turn as ``<|role|>text<|end|>``. In roles and texts a
backslash is doubled, and one is put after the first character of every control
string, so that no text can close or open a turn; reading back drops the first
backslash of each pair. Training loss covers the texts of assistant turns.

Defined cases: a null text or role is empty; a record whose fingerprint has no
mapping gives no turn and is reported by ``unmapped``; repeated rows are
repeated turns; equal turn numbers are ordered by role and text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
_END = "<|end|>"
_CONTROL = r"<(?=\||/?s>)|\|(?=>)|\[(?=/?INST\])"
_TURN = r"(?s)^<\|(.*?)\|>(.*)<\|end\|>$"


@dataclass(frozen=True)
class Mapping:
    """How one layout gives turns.

    ``fields`` are the record's paths in order. ``turns`` are (role, paths):
    the texts of the paths, joined by a line break where not empty; a role that
    starts with $ is read from that path. ``each``: the path of a list whose
    elements give the turns, with paths relative to an element. ``roles``
    renames roles to canonical ones.
    """

    name: str
    fields: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...]], ...]
    each: str | None = None
    roles: tuple[tuple[str, str], ...] = ()


MAPPINGS = (
    Mapping("message", ("role", "text"), (("$role", ("text",)),)),
    Mapping(
        "prompt",
        ("completion", "prompt"),
        (("user", ("prompt",)), (ASSISTANT, ("completion",))),
    ),
    Mapping(
        "instruction",
        ("input", "instruction", "output"),
        (("user", ("instruction", "input")), (ASSISTANT, ("output",))),
    ),
    Mapping(
        "messages",
        ("messages", "messages[].content", "messages[].role"),
        (("$role", ("content",)),),
        each="messages",
    ),
    Mapping(
        "conversations",
        ("conversations", "conversations[].from", "conversations[].value"),
        (("$from", ("value",)),),
        each="conversations",
        roles=(("human", "user"), ("gpt", ASSISTANT)),
    ),
)


def _object(record: Column) -> Column:
    return F.from_json(record, "map<string,string>")


def _paths(record: Column) -> Column:
    """Nested field paths of a record of objects and lists, to a depth of two."""

    def of_field(entry: Column) -> Column:
        listed = F.from_json(entry["value"], "array<map<string,string>>")
        names = F.array_distinct(F.flatten(F.transform(listed, lambda m: F.map_keys(m))))
        inner = F.transform(names, lambda name: F.concat(entry["key"], F.lit("[]."), name))
        nested = F.when(entry["value"].startswith("[{"), inner)
        none = F.array().cast("array<string>")
        return F.concat(F.array(entry["key"]), F.coalesce(nested, none))

    return F.array_sort(F.flatten(F.transform(F.map_entries(_object(record)), of_field)))


def schema_fingerprint(record: Column) -> Column:
    """64-bit hash of the sorted nested field paths of a JSON record."""
    return F.xxhash64(F.array_join(_paths(record), "\n"))


def _fingerprint_of(mapping: Mapping) -> Column:
    return F.xxhash64(F.lit("\n".join(sorted(mapping.fields))))


def _turns(mapping: Mapping, fields: Column) -> Column:
    """Array of (role, text) of one object, given as a map of strings."""

    def value(path: str) -> Column:
        return F.coalesce(fields[path], F.lit(""))

    def text(paths: tuple[str, ...]) -> Column:
        if len(paths) == 1:
            return value(paths[0])
        parts = F.filter(F.array(*map(value, paths)), lambda part: part != "")
        return F.array_join(parts, "\n")

    def role(name: str) -> Column:
        found = value(name[1:]) if name.startswith("$") else F.lit(name)
        for own, canonical in mapping.roles:
            found = F.when(found == own, F.lit(canonical)).otherwise(found)
        return found

    return F.array(
        *[
            F.struct(role(name).alias("role"), text(paths).alias("text"))
            for name, paths in mapping.turns
        ]
    )


def _of_element(mapping: Mapping):
    return lambda fields: _turns(mapping, fields)


def canonical_turns(record: Column, fingerprint: Column, mappings=MAPPINGS) -> Column:
    """Array of (role, text) of a JSON record by the mapping of its fingerprint, else null."""
    found = F.lit(None).cast("array<struct<role:string,text:string>>")
    for mapping in mappings:
        if mapping.each is None:
            turns = _turns(mapping, _object(record))
        else:
            listed = F.from_json(_object(record)[mapping.each], "array<map<string,string>>")
            turns = F.flatten(F.transform(listed, _of_element(mapping)))
        found = F.when(fingerprint == _fingerprint_of(mapping), turns).otherwise(found)
    return found


def to_turns(records: DataFrame, record: str = "record", mappings=MAPPINGS) -> DataFrame:
    """A row for each turn: ``at`` (place in the record), role, text and the other columns.

    Columns of these three names in the input give way.
    """
    marked = records.withColumn("_fingerprint", schema_fingerprint(F.col(record)))
    turns = canonical_turns(F.col(record), F.col("_fingerprint"), mappings)
    others = [c for c in records.columns if c not in (record, "at", "role", "text")]
    return marked.select(*others, F.posexplode(turns).alias("at", "_turn")).select(
        *others, "at", F.col("_turn.role").alias("role"), F.col("_turn.text").alias("text")
    )


def unmapped(records: DataFrame, record: str = "record", mappings=MAPPINGS) -> DataFrame:
    """(fingerprint, fields, rows) of layouts that no mapping knows."""
    known = [_fingerprint_of(mapping) for mapping in mappings]
    marked = records.select(
        schema_fingerprint(F.col(record)).alias("fingerprint"), _paths(F.col(record)).alias("fields")
    )
    return (
        marked.filter(F.col("fingerprint").isNull() | ~F.col("fingerprint").isin(*known))
        .groupBy("fingerprint", "fields")
        .agg(F.count("*").alias("rows"))
    )


def escaped(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), escaped(role), F.lit("|>"), escaped(text), F.lit(_END))


def format_turns(turns: DataFrame) -> DataFrame:
    """Turns with ``formatted`` and, for assistants, the loss span within it.

    ``loss_start`` and ``loss_chars`` count code points of the formatted turn;
    other turns have a span of zero. A row for each turn, however long the
    conversation: nothing is gathered.
    """
    head = F.length(F.concat(F.lit("<|"), escaped(F.col("role")), F.lit("|>")))
    learns = F.col("role") == ASSISTANT
    return turns.withColumns(
        {
            "formatted": formatted_turn(F.col("role"), F.col("text")),
            "loss_start": F.when(learns, head).otherwise(0),
            "loss_chars": F.when(learns, F.length(escaped(F.col("text")))).otherwise(0),
        }
    )


def read_turn(formatted: Column) -> tuple[Column, Column]:
    """Role and text of a formatted turn."""
    return (
        unescaped(F.regexp_extract(formatted, _TURN, 1)),
        unescaped(F.regexp_extract(formatted, _TURN, 2)),
    )


def conversation_digests(formatted: DataFrame, conv_id: str, order: list[str]) -> DataFrame:
    """What each conversation's output holds, read back from its formatted turns.

    A digest needs a conversation's turns in one place, and so does nothing else:
    partial lists are gathered in the map tasks, and counts are summed there.
    """
    role, text = read_turn(F.col("formatted"))
    masked = F.substring("formatted", F.col("loss_start") + 1, F.col("loss_chars"))
    read = formatted.select(
        F.col(conv_id).alias("conv_id"),
        *order,
        role.alias("_role"),
        text.alias("_text"),
        unescaped(masked).alias("_loss"),
        F.length("formatted").cast("long").alias("_chars"),
    )
    place = F.struct(*order, "_role", "_text", "_loss")
    turns = F.sort_array(F.collect_list(place))
    gathered = read.groupBy("conv_id").agg(
        turns.alias("_turns"), F.count("*").alias("n_turns"), F.sum("_chars").alias("formatted_chars")
    )
    every = F.transform("_turns", lambda t: F.concat(t["_role"], F.lit("\n"), t["_text"], F.lit("\n")))
    loss = F.array_join("_turns._loss", "")
    return gathered.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(every, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
