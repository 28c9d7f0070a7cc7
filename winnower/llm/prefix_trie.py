"""Prefix trie of conversations from padded matrices of turn ids.

Conversations are cut into segments of so many turns. A segment is a row of a
matrix: padded turn ids, headed by a digest of all turns before it, so that
segments with equal heads share their history whatever its length. Rows are
sorted by range over all tasks and cut into blocks of bounded size. In a block,
numpy sorts the rows by all columns (lexsort); a mask says where a column differs
from the row above, and OR-accumulated from column to column it marks where the
nodes of each depth start, so that reduceat sums every depth over its runs.

A node that holds the first or the last row of its block may go on in the next
one, and the nodes between two segments belong to both. Only those boundary nodes
are recombined, by a digest of their path, from one partial row for each block.

Two passes over the blocks: the first finds members, children and the words of
each node; the second sums leaves and saved tokens over subtrees. For the sums
each node charges its share to one row that it holds, and a row knows what its
conversation was charged in later segments, so no task ever walks a path.

A huge conversation is many segments in many blocks, and a node that a third of
all conversations share is one partial row for each of its blocks. Ids of
conversations that end in a boundary node are sorted by range and joined to
chunks before one task hashes the chunks of a node in order.

Defined cases: rows without conv_id belong to no conversation and are left out;
a null role or text is empty; turns of equal number (nulls come first) follow
the hash of their role and text, and repeated rows are repeated turns; a
conversation whose base is absent keeps its own turns after the first h; an empty
table has no root and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnower.storage import written

_WORD = r"[^\x20\x09-\x0D]+"
_PAD = np.iinfo(np.int64).min
_SEGMENTS_PER_SPAN = 4096
_NOTHING = hashlib.sha256(b"").hexdigest()
_KEY = ["depth", "x", "y"]


@dataclass(frozen=True)
class TrieBounds:
    """What a matrix holds at most; results do not depend on it."""

    segment_turns: int = 32
    rows_per_block: int = 4096
    ids_per_chunk: int = 1024


# Rebuilding conversations


def _numbered_turns(rows: DataFrame) -> DataFrame:
    """Narrow rows (piece, conv_id, at, id, words) in order of range.

    ``at`` counts the turns of a conversation within its piece, which is what one
    task holds of the sorted table, so a huge conversation has many pieces.
    """
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    narrow = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat_ws("\n", F.char_length(role).cast("string"), role, text))).alias("id"),
        F.regexp_count(text, F.lit(_WORD)).alias("words"),
    )
    order = ["conv_id", "turn", "id"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            conv = batch.column(0).to_numpy()
            if not len(conv):
                continue
            starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
            at = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
            if conv[0] == last:
                at[: starts[1] if len(starts) > 1 else None] += count
            last, count = conv[-1], at[-1] + 1
            pieces = pa.array(np.full(len(conv), piece, np.int32))
            yield pa.RecordBatch.from_arrays(
                [pieces, batch.column(0), pa.array(at), batch.column(2), batch.column(3)],
                ["piece", "conv_id", "at", "id", "words"],
            )

    ordered = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "piece int, conv_id long, at long, id binary, words int"
    return written(rows.sparkSession, ordered.mapInArrow(number, schema), "turns")


def _rebuilt(rows: DataFrame, borrowed: int, family: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, id, words) of all rebuilt turns, and the turnless conversations' ids."""
    turns = _numbered_turns(rows)
    pieces = turns.groupBy("piece", "conv_id").agg(F.count("*").alias("n"))
    pieces = written(rows.sparkSession, pieces, "pieces")
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "piece", "conv_id", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    sizes = pieces.groupBy("conv_id").agg(F.sum("n").alias("own"))
    convs = sizes.select(
        "conv_id",
        "own",
        (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % borrowed).alias("h"),
    )
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("of_base"))
    taken = F.least("h", F.coalesce("of_base", F.lit(0))).alias("taken")
    convs = convs.join(bases, "base", "left").select("conv_id", "own", "base", "h", taken)
    convs = written(rows.sparkSession, convs, "conversations")
    placed = turns.join(pieces.join(convs, "conv_id"), ["piece", "conv_id"]).withColumn(
        "pos", F.col("at") + F.col("before")
    )
    own = placed.filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "words"
    )
    heads = placed.filter((F.col("pos") < borrowed) & (F.col("conv_id") == F.col("base")))
    heads = heads.select("base", "pos", "id", "words")
    lent = convs.select("conv_id", "base", "h").join(heads, "base").filter("pos < h")
    turnless = convs.filter("own <= h and taken = 0").select("conv_id")
    return own.union(lent.select("conv_id", "pos", "id", "words")), turnless


# Segments and blocks


def _totals_before(
    rows: DataFrame,
    names: list[str],
    total: Callable[[str], Column],
    join: Callable[[Column, Column], Column],
    backwards: bool = False,
) -> DataFrame:
    """``rows`` with each name replaced by its total over earlier segments of the conversation.

    A conversation of very many segments is summed by spans of them first, so
    that no task has to hold all of it. Backwards, later segments are meant.
    """
    span = F.floor(F.col("seg") / _SEGMENTS_PER_SPAN).alias("span")
    before = (Window.unboundedPreceding, -1)
    rows = rows.withColumn("span", span)

    def window(*keys: str, by: str):
        order = F.desc(by) if backwards else F.asc(by)
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(*before)

    spans = rows.groupBy("conv_id", "span").agg(*(total(n).alias(n) for n in names))
    of_spans = window("conv_id", by="span")
    spans = spans.select("conv_id", "span", *(total(n).over(of_spans).alias(f"{n}_span") for n in names))
    within = window("conv_id", "span", by="seg")
    others = [name for name in rows.columns if name not in names]
    rows = rows.select(*others, *(total(n).over(within).alias(n) for n in names))
    zero = F.lit(0).cast("long")
    sums = [join(F.coalesce(n, zero), F.coalesce(f"{n}_span", zero)).alias(n) for n in names]
    return rows.join(spans, ["conv_id", "span"]).select(*others, *sums).drop("span")


def _segments(turns: DataFrame, turnless: DataFrame, size: int) -> DataFrame:
    """(conv_id, seg, x, y, last, turns): the digest of all turns before, and the turns."""
    spark = turns.sparkSession
    own = F.struct(
        F.col("pos"),
        F.xxhash64("pos", "id").alias("u"),
        F.xxhash64("id", "pos").alias("v"),
        F.col("words").cast("long").alias("words"),
    )
    rows = turns.select("conv_id", F.floor(F.col("pos") / size).alias("seg"), own.alias("own"))
    rows = rows.groupBy("conv_id", "seg").agg(
        F.bit_xor("own.u").alias("x"),
        F.bit_xor("own.v").alias("y"),
        F.sort_array(F.collect_list("own")).alias("turns"),
    )
    kind = rows.schema["turns"].dataType
    empty = turnless.select(
        "conv_id",
        F.lit(0).cast("long").alias("seg"),
        F.lit(0).cast("long").alias("x"),
        F.lit(0).cast("long").alias("y"),
        F.array().cast(kind).alias("turns"),
    )
    rows = written(spark, rows.unionByName(empty), "segments")
    heads = _totals_before(
        rows.select("conv_id", "seg", "x", "y"), ["x", "y"], F.bit_xor, Column.bitwiseXOR
    )
    ends = rows.groupBy("conv_id").agg(F.max("seg").alias("end"))
    heads = heads.join(ends, "conv_id").select(
        "conv_id", "seg", "x", "y", (F.col("seg") == F.col("end")).alias("last")
    )
    return heads.join(rows.select("conv_id", "seg", "turns"), ["conv_id", "seg"])


_BLOCK = (
    "block long, conv array<long>, seg array<long>, x array<long>, y array<long>,"
    " last array<boolean>, n array<long>, u array<long>, v array<long>, words array<long>"
)
_BLOCK_NAMES = [field.split()[0] for field in _BLOCK.split(", ")]


def _blocks(segments: DataFrame, most_rows: int) -> DataFrame:
    """Sorted segments in blocks of so many rows, each one row of a written table."""
    order = ["seg", "x", "y", "turns", "conv_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def close():
            columns = [np.concatenate(parts) for parts in zip(*held, strict=True)]
            lists = [pa.array([column]) for column in columns]
            number = pa.array([(task << 32) + made], pa.int64())
            return pa.RecordBatch.from_arrays([number, *lists], _BLOCK_NAMES)

        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, most_rows - rows)
                turns = part.column(5)
                flat = turns.flatten()
                held.append(
                    [
                        *(part.column(i).to_numpy(zero_copy_only=False) for i in range(5)),
                        np.diff(turns.offsets.to_numpy()).astype(np.int64),
                        *(flat.field(name).to_numpy() for name in ("u", "v", "words")),
                    ]
                )
                rows += part.num_rows
                start += part.num_rows
                if rows == most_rows:
                    yield close()
                    made, held, rows = made + 1, [], 0
        if rows:
            yield close()

    ordered = segments.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = ordered.select("conv_id", "seg", "x", "y", "last", "turns").mapInArrow(cut, _BLOCK)
    return written(segments.sparkSession, rows, "blocks")


# Matrices


@dataclass
class Level:
    """Nodes of one column of a matrix: runs of rows from ``start`` up to ``end``."""

    start: np.ndarray
    end: np.ndarray
    depth: np.ndarray
    x: np.ndarray
    y: np.ndarray
    words: np.ndarray
    parent: np.ndarray
    boundary: np.ndarray
    starts: np.ndarray
    runs: np.ndarray

    def reduced(self, by: np.ufunc, values: np.ndarray) -> np.ndarray:
        """One value for each node; runs of padding are left out."""
        return by.reduceat(values, self.starts)[self.runs]


class Matrix:
    """Sorted rows of a block and the nodes of every column; column 0 is the head."""

    def __init__(self, block: dict[str, np.ndarray], width: int):
        n = block["n"]
        used = int(n.max(initial=0))
        own = np.arange(used) < n[:, None]
        u, v = (np.full(own.shape, _PAD) for _ in range(2))
        words = np.zeros(own.shape, np.int64)
        u[own], v[own], words[own] = block["u"], block["v"], block["words"]
        seg, x, y = block["seg"], block["x"], block["y"]
        columns = [key for at in range(used) for key in (u[:, at], v[:, at])]
        self.order = np.lexsort([*columns[::-1], y, x, seg])
        self.width, self.rows = width, len(n)
        self.conv, self.seg, self.n, self.last = (block[k][self.order] for k in ("conv", "seg", "n", "last"))
        self.u, self.v, self.words = u[self.order], v[self.order], words[self.order]
        self.x, self.y = x[self.order], y[self.order]
        self.edges = [int(np.flatnonzero(self.order == at)[0]) for at in (0, len(n) - 1)]

    def _differs(self, values: np.ndarray) -> np.ndarray:
        return np.append(True, values[1:] != values[:-1])

    @cached_property
    def levels(self) -> list[Level]:
        x, y = self.x.copy(), self.y.copy()
        change = self._differs(self.seg) | self._differs(x) | self._differs(y)
        found: list[Level] = []
        for column in range(self.u.shape[1] + 1):
            if column:
                u, v = self.u[:, column - 1], self.v[:, column - 1]
                change = change | self._differs(u) | self._differs(v)
                real = self.n >= column
                x[real] ^= u[real]
                y[real] ^= v[real]
            starts = np.flatnonzero(change)
            runs = self.n[starts] >= column
            start, end = starts[runs], np.append(starts[1:], self.rows)[runs]
            inside = [(start <= edge) & (edge < end) for edge in self.edges]
            shared = column in (0, self.width)
            above = np.searchsorted(found[-1].start, start, side="right") - 1 if column else start
            words = self.words[start, column - 1] if column else np.zeros(len(start), np.int64)
            depth = self.seg[start] * self.width + column
            boundary = inside[0] | inside[1] | shared
            found.append(Level(start, end, depth, x[start], y[start], words, above, boundary, starts, runs))
        return found

    def children(self, column: int) -> np.ndarray:
        """Children of each node: all of an inner node, those that are inner of a boundary node."""
        level = self.levels[column]
        if column + 1 == len(self.levels):
            return np.zeros(len(level.start), np.int64)
        below = self.levels[column + 1]
        counted = ~(below.boundary & level.boundary[below.parent])
        return np.bincount(below.parent[counted], minlength=len(level.start))

    def members(self, level: Level) -> np.ndarray:
        return level.end - level.start

    def inner_shares(self) -> tuple[np.ndarray, np.ndarray]:
        """(leaves, saved tokens) that inner nodes charge, by row and column."""
        leaves, saved = (np.zeros((self.rows, len(self.levels)), np.int64) for _ in range(2))
        for column, level in enumerate(self.levels):
            inner = ~level.boundary
            at = level.start[inner]
            leaves[at, column] = self.children(column)[inner] == 0
            saved[at, column] = (self.members(level)[inner] - 1) * level.words[inner]
        return leaves, saved


def _as_block(batch: pa.RecordBatch, at: int) -> dict[str, np.ndarray]:
    lists = {name: batch.column(name)[at].values for name in _BLOCK_NAMES[1:]}
    return {name: values.to_numpy(zero_copy_only=False) for name, values in lists.items()}


_FIRST = (
    "kind int, block long, row int, slot int, depth long, x long, y long, above_x long, above_y long,"
    " above_conv long, n_convs long, conv_id long, n_children long, words long, seg long, leaves long,"
    " saved long"
)
_FIRST_NAMES = [field.split()[0] for field in _FIRST.split(", ")]
_NODE, _ROW = 0, 1


def _first_rows(number: int, matrix: Matrix) -> Iterator[dict[str, np.ndarray]]:
    """Partial rows of boundary nodes, then what inner nodes charge to rows of long conversations.

    ``row`` is the place in the block, before sorting.
    """
    slot = 0
    for column, level in enumerate(matrix.levels):
        at = np.flatnonzero(level.boundary)
        least = level.reduced(np.minimum, matrix.conv)[at]
        holds = np.zeros(len(at), np.int64)
        for i, (node, conv) in enumerate(zip(at, least, strict=True)):
            start, end = level.start[node], level.end[node]
            holds[i] = matrix.order[start + int(np.argmax(matrix.conv[start:end] == conv))]
        stub = (level.depth[at] > 0) & (column == 0)  # members are counted in the segment before
        if column:
            above = matrix.levels[column - 1]
            parent = level.parent[at]
            outer = above.boundary[parent]
            parent_conv = above.reduced(np.minimum, matrix.conv)[parent]
            links = (above.x[parent], ~outer), (above.y[parent], ~outer), (parent_conv, outer)
        else:
            links = (3 * [(np.zeros(len(at), np.int64), np.ones(len(at), bool))])
        yield {
            "kind": np.full(len(at), _NODE),
            "block": np.full(len(at), number),
            "row": (holds, stub),
            "slot": slot + np.arange(len(at)),
            "depth": level.depth[at],
            "x": level.x[at],
            "y": level.y[at],
            "above_x": links[0],
            "above_y": links[1],
            "above_conv": links[2],
            "n_convs": (matrix.members(level)[at], stub),
            "conv_id": (least, stub),
            "n_children": matrix.children(column)[at],
            "words": level.words[at],
        }
        slot += len(at)
    long = np.flatnonzero((matrix.seg > 0) | ~matrix.last)
    leaves, saved = (share.sum(axis=1)[long] for share in matrix.inner_shares())
    yield {
        "kind": np.full(len(long), _ROW),
        "block": np.full(len(long), number),
        "row": matrix.order[long],
        "conv_id": matrix.conv[long],
        "seg": matrix.seg[long],
        "leaves": leaves,
        "saved": saved,
    }


_SECOND = (
    "kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string, x long, y long"
)
_SECOND_NAMES = [field.split()[0] for field in _SECOND.split(", ")]
_INNER, _PART, _END = 0, 1, 2


def _ids_hash(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, np.sort(ids).tolist())).encode()).hexdigest()


def _second_rows(matrix: Matrix, nodes: list[dict], later: list[dict]) -> Iterator[dict[str, np.ndarray]]:
    """Whole rows of inner nodes, sums of boundary nodes and the ids that end in them.

    ``nodes`` are the recombined boundary nodes of this block, by slot, and
    ``later`` what the block's rows were charged in later segments.
    """
    known = {node["slot"]: node for node in nodes}
    place = np.empty(matrix.rows, np.int64)
    place[matrix.order] = np.arange(matrix.rows)
    shares = matrix.inner_shares()
    slot = 0
    conv_of: list[np.ndarray] = []
    for column, level in enumerate(matrix.levels):
        conv = level.reduced(np.minimum, matrix.conv).copy()
        for node in np.flatnonzero(level.boundary):
            final = known[slot]
            conv[node] = final["conv_id"]
            if final["row"] is not None:
                shares[0][place[final["row"]], column] = final["leaves"]
                shares[1][place[final["row"]], column] = final["saved"]
            slot += 1
        conv_of.append(conv)
    sums = [np.cumsum(share[:, ::-1], axis=1)[:, ::-1] for share in shares]
    for row in later:
        sums[0][place[row["row"]]] += row["leaves"]
        sums[1][place[row["row"]]] += row["saved"]
    for column, level in enumerate(matrix.levels):
        leaves, saved = (level.reduced(np.add, total[:, column]) for total in sums)
        ends = matrix.last & (matrix.n == column)
        ended = level.reduced(np.add, ends.astype(np.int64))
        inner = np.flatnonzero(~level.boundary)
        hashes = [
            _ids_hash(matrix.conv[s:e][ends[s:e]]) if some else _NOTHING
            for s, e, some in zip(level.start[inner], level.end[inner], ended[inner], strict=True)
        ]
        if column:
            yield {
                "kind": np.full(len(inner), _INNER),
                "conv_id": conv_of[column][inner],
                "depth": level.depth[inner],
                "parent_conv_id": conv_of[column - 1][level.parent[inner]],
                "n_convs": matrix.members(level)[inner],
                "n_children": matrix.children(column)[inner],
                "n_leaves": leaves[inner],
                "saved_tokens": saved[inner],
                "ends_sha256": np.array(hashes, object),
            }
        whole = (level.depth == 0) | (column > 0)  # else the segment before sums this node
        outer = np.flatnonzero(level.boundary & whole)
        yield {
            "kind": np.full(len(outer), _PART),
            "depth": level.depth[outer],
            "n_leaves": leaves[outer],
            "saved_tokens": saved[outer],
            "x": level.x[outer],
            "y": level.y[outer],
        }
        row = np.flatnonzero(ends)
        node = np.searchsorted(level.start, row, side="right") - 1
        here = (level.boundary & whole)[node]
        node, row = node[here], row[here]
        yield {
            "kind": np.full(len(row), _END),
            "conv_id": matrix.conv[row],
            "depth": level.depth[node],
            "x": level.x[node],
            "y": level.y[node],
        }


def _batch(rows: dict, names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    """A batch with all columns; a pair is values and where they are null, absent ones are null."""
    size = len(rows["kind"])
    arrays = []
    for name in names:
        value = rows.get(name)
        values, mask = value if isinstance(value, tuple) else (value, None)
        kind = schema.field(name).type
        arrays.append(pa.nulls(size, kind) if value is None else pa.array(values, mask=mask).cast(kind))
    return pa.RecordBatch.from_arrays(arrays, names)


_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def _arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


# The trie


def _boundary_nodes(partial: DataFrame, width: int) -> DataFrame:
    """One row for each boundary node, recombined from its blocks, written."""
    spark = partial.sparkSession
    place = F.when(F.col("conv_id").isNotNull(), F.struct("conv_id", "block", "row"))
    above = F.when(F.col("above_x").isNotNull(), F.struct("above_x", "above_y"))
    nodes = partial.groupBy(*_KEY).agg(
        F.min(place).alias("place"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner_children"),
        F.max("words").alias("words"),
        F.max("above_conv").alias("above_conv"),
        F.max(above).alias("above"),
    )
    nodes = written(spark, nodes.select("*", "place.*", "above.*").drop("place", "above"), "nodes")
    parent_key = [(F.col("depth") - 1).alias("depth"), F.col("above_x").alias("x"), F.col("above_y").alias("y")]
    children = nodes.filter("above_x is not null").select(*parent_key).groupBy(*_KEY).agg(
        F.count("*").alias("outer_children")
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("x").alias("above_x"),
        F.col("y").alias("above_y"),
        F.col("conv_id").alias("outer_parent"),
    )
    n_children = F.col("inner_children") + F.coalesce("outer_children", F.lit(0))
    found = (
        nodes.join(children, _KEY, "left")
        .join(parents, ["depth", "above_x", "above_y"], "left")
        .select(
            *_KEY,
            "block",
            "row",
            "conv_id",
            F.coalesce("above_conv", "outer_parent").alias("parent_conv_id"),
            "n_convs",
            n_children.alias("n_children"),
            (n_children == 0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
            F.floor((F.greatest("depth", F.lit(1)) - 1) / width).alias("seg"),
        )
    )
    return written(spark, found, "nodes")


def _known_to_blocks(blocks: DataFrame, first: DataFrame, nodes: DataFrame) -> DataFrame:
    """The blocks with what the second pass has to know about their nodes and rows."""
    partial = first.filter(F.col("kind") == _NODE).select(
        "block", "slot", *_KEY, F.col("n_convs").isNull().alias("stub")
    )
    final = nodes.select(
        *_KEY, "conv_id", "leaves", "saved", F.col("block").alias("home"), F.col("row").alias("home_row")
    )
    at_home = (F.col("block") == F.col("home")) & ~F.col("stub")
    of_block = (
        partial.join(final, _KEY)
        .withColumn("row", F.when(at_home, F.col("home_row")))
        .groupBy("block")
        .agg(F.collect_list(F.struct("slot", "conv_id", "row", "leaves", "saved")).alias("nodes"))
    )
    charged = first.filter(F.col("kind") == _ROW).select(
        "conv_id", "seg", "leaves", "saved", "block", "row"
    )
    none = F.lit(None).cast("long").alias("block"), F.lit(None).cast("int").alias("row")
    charged = charged.union(nodes.select("conv_id", "seg", "leaves", "saved", *none))
    charged = charged.groupBy("conv_id", "seg").agg(
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
        F.max("block").alias("block"),
        F.max("row").alias("row"),
    )
    later = _totals_before(charged, ["leaves", "saved"], F.sum, lambda a, b: a + b, backwards=True)
    later = later.filter("block is not null and (leaves > 0 or saved > 0)").groupBy("block").agg(
        F.collect_list(F.struct("row", "leaves", "saved")).alias("later")
    )
    return blocks.join(of_block, "block", "left").join(later, "block", "left")


def _hashes_of_ends(ends: DataFrame, per_chunk: int) -> DataFrame:
    """(depth, x, y, ends_sha256) of (depth, x, y, conv_id): ids ascending, joined by commas."""
    order = [*_KEY, "conv_id"]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            ids = batch.column(3).to_numpy()
            new = np.append(True, (keys[1:] != keys[:-1]).any(axis=1)) if len(ids) else np.zeros(0, bool)
            starts = np.flatnonzero(new)
            cuts = [
                at
                for a, b in zip(starts, np.append(starts[1:], len(ids)), strict=True)
                for at in range(a, b, per_chunk)
            ]
            ends_at = [*cuts[1:], len(ids)]
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(cuts, ends_at, strict=True)]
            columns = [pa.array(keys[cuts, i]) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(ids[cuts]), pa.array(texts, pa.string())], [*_KEY, "first", "ids"]
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        schema = pa.schema([(name, pa.int64()) for name in _KEY] + [("ends_sha256", pa.string())])

        def done(rows):
            arrays = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(a, f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema
            )

        for batch in batches:
            rows = []
            for *here, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if here != key:
                    if key is not None:
                        rows.append((*key, state.hexdigest()))
                    key, state = here, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            if rows:
                yield done(rows)
        if key is not None:
            yield done([(*key, state.hexdigest())])

    parts = (
        ends.select(*order)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(chunks, "depth long, x long, y long, first long, ids string")
    )
    by_node = parts.repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
    return by_node.mapInArrow(digest, "depth long, x long, y long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    bounds: TrieBounds = TrieBounds(),
    borrowed: int = 4,
    family: int = 20,
) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations.

    A conversation c takes its first ``crc32(c) % borrowed`` turns from
    conversation ``c - c % family``.
    """
    spark, width = conversations.sparkSession, bounds.segment_turns
    segments = _segments(*_rebuilt(conversations, borrowed, family), width)
    blocks = _blocks(segments, bounds.rows_per_block)
    first_schema, second_schema = _arrow_schema(_FIRST), _arrow_schema(_SECOND)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                number = batch.column("block")[at].as_py()
                for rows in _first_rows(number, Matrix(_as_block(batch, at), width)):
                    yield _batch(rows, _FIRST_NAMES, first_schema)

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                nodes, later = (batch.column(name)[at].as_py() or [] for name in ("nodes", "later"))
                for rows in _second_rows(Matrix(_as_block(batch, at), width), nodes, later):
                    yield _batch(rows, _SECOND_NAMES, second_schema)

    first = written(spark, blocks.mapInArrow(first_pass, _FIRST), "first-pass")
    nodes = _boundary_nodes(first.filter(F.col("kind") == _NODE), width)
    known = _known_to_blocks(blocks, first, nodes)
    second = written(spark, known.mapInArrow(second_pass, _SECOND), "second-pass")
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    inner = second.filter(F.col("kind") == _INNER).select(*result, "ends_sha256")
    sums = second.filter(F.col("kind") == _PART).groupBy(*_KEY).agg(
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    hashes = _hashes_of_ends(second.filter(F.col("kind") == _END), bounds.ids_per_chunk)
    outer = (
        nodes.join(sums, _KEY)
        .join(hashes, _KEY, "left")
        .select(*result, F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"))
    )
    return inner.union(outer)
