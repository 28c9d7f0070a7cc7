"""SimHash near-duplicates through vantage-point trees.

A fingerprint has a bit where over half of a text's shingle hashes have it.
Equal fingerprints are one point. Points are dealt to shards by a routing tree
of vantage points: a point goes left if its Hamming distance from the vantage
point is at most the radius, and right if the distance exceeds the radius less
``max_bits``. By the triangle inequality two points that differ in ``max_bits``
bits or fewer meet in at least one shard, so every pair is found exactly.
Within a shard the same rule splits points into buckets small enough to
compare. A shard reports a spanning forest of its links, never all pairs, and
the forests are joined into components by label passes over written tables.

Defined cases: a null or wordless text has fingerprint zero, linked like any
other; fewer than ``shingle`` words are one shingle; null doc_ids take part as
members, and a component of such rows alone has a null id; repeated rows keep
one result each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnower.storage import written

_SEED = 42
_ROUTING_POINTS = 4096
_ROUTING_POINTS_PER_SHARD = 48
_BUCKET = 192
_HASHES_AT_ONCE = 1 << 16


def _shingles(text: str | None, size: int) -> list[bytes]:
    """Shingles in UTF-8; bytes have just the case and the white space that is asked for."""
    words = (text or "").encode().lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 majority bits over the XXH64 hashes of all shingles, repeats included."""
    shingles = _shingles(text, shingle)
    counts = np.zeros(64, np.int64)
    for start in range(0, len(shingles), _HASHES_AT_ONCE):
        part = shingles[start : start + _HASHES_AT_ONCE]
        digests = b"".join(map(xxhash.xxh64_digest, part, repeat(_SEED)))
        bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64)
        for at in range(0, len(part), 255):  # a byte holds the sum of so many bits
            counts += bits[at : at + 255].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * counts > len(shingles)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str, keep: list[Column], shingle: int) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed long."""
    rows = docs.select(*keep, F.col(text).alias("_text"))
    fields = [field for field in rows.schema.fields if field.name != "_text"]
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("_text")).to_pylist()
            marks = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            kept = [batch.column(batch.schema.get_field_index(f.name)) for f in fields]
            names = [field.name for field in fields]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(marks)], [*names, "fp"])

    return rows.mapInArrow(mark, f"{schema}, fp long")


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def _split(points: np.ndarray, max_bits: int, tries: int = 4):
    """Vantage point and radius that leave the fewest points on both sides.

    None if no vantage point tried makes either side smaller than the whole.
    """
    best = None
    for at in np.linspace(0, len(points) - 1, tries).astype(int):
        distance = _distance(points, points[at])
        radius = int(np.median(distance))
        left = int((distance <= radius).sum())
        right = int((distance > radius - max_bits).sum())
        if max(left, right) < len(points) and (best is None or left + right < best[0]):
            best = (left + right, points[at], radius)
    return best and best[1:]


def routing_tree(sample: np.ndarray, shards: int, max_bits: int) -> list[tuple[int, int]]:
    """Vantage points and radii in heap order, one for each inner node of a full tree.

    A node that cannot be split sends all of its points left.
    """
    levels = max(0, (shards - 1).bit_length())
    nodes: list[tuple[int, int]] = []
    level = [np.unique(sample)]
    for _ in range(levels):
        below = []
        for points in level:
            found = _split(points, max_bits) if len(points) > 1 else None
            vantage, radius = found or (np.uint64(0), 64 + max_bits)
            distance = _distance(points, vantage)
            nodes.append((int(vantage), radius))
            below += [points[distance <= radius], points[distance > radius - max_bits]]
        level = below
    return nodes


def route(points: np.ndarray, nodes: list[tuple[int, int]], max_bits: int):
    """(shard, index of point) for every shard that a point has to visit."""
    here = [(0, np.arange(len(points)))]
    while here and here[0][0] < len(nodes):
        below = []
        for node, index in here:
            vantage, radius = nodes[node]
            distance = _distance(points[index], np.uint64(vantage))
            below.append((2 * node + 1, index[distance <= radius]))
            below.append((2 * node + 2, index[distance > radius - max_bits]))
        here = below
    shard = np.concatenate([np.full(len(i), n - len(nodes), np.int32) for n, i in here])
    return shard, np.concatenate([i for _, i in here])


class _Forest:
    """Union by smallest index over the points of one shard."""

    def __init__(self, size: int):
        self.parent = list(range(size))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def _link_bucket(points, index, forest, max_bits) -> None:
    """Compare all points of a bucket, in blocks of bounded memory."""
    block = max(1, (1 << 20) // len(index))
    own = points[index]
    for start in range(0, len(index), block):
        close = np.bitwise_count(own[start : start + block, None] ^ own[None, start:]) <= max_bits
        first, second = np.nonzero(close)
        later = second > first
        ends = index[start + first[later]].tolist(), index[start + second[later]].tolist()
        for a, b in zip(*ends, strict=True):
            forest.join(a, b)


def link_shard(points: np.ndarray, max_bits: int) -> list[int]:
    """Smallest linked index within the shard for each of its distinct points."""
    forest, open_buckets = _Forest(len(points)), [np.arange(len(points))]
    while open_buckets:
        index = open_buckets.pop()
        found = _split(points[index], max_bits) if len(index) > _BUCKET else None
        if found is None:
            if len(index) > 1:
                _link_bucket(points, index, forest, max_bits)
            continue
        distance = _distance(points[index], found[0])
        open_buckets += [index[distance <= found[1]], index[distance > found[1] - max_bits]]
    return [forest.root(i) for i in range(len(points))]


def _links(points: DataFrame, nodes: list[tuple[int, int]], max_bits: int) -> DataFrame:
    """(a, b) with a < b as signed longs: spanning forests of all shards."""
    shards = len(nodes) + 1

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy(np.int64)
            shard, index = route(values.view(np.uint64), nodes, max_bits)
            yield pd.DataFrame({"shard": shard, "fp": values[index]})

    def forest(rows: pd.DataFrame) -> pd.DataFrame:
        values = np.unique(rows["fp"].to_numpy(np.int64))
        roots = values[link_shard(values.view(np.uint64), max_bits)]
        linked = roots != values
        return pd.DataFrame({"a": roots[linked], "b": values[linked]})

    dealt = points.select("fp").mapInPandas(visits, "shard int, fp long")
    # A given number, as adaptive execution would merge shards by their few bytes.
    dealt = dealt.repartition(shards, "shard")
    return dealt.groupBy("shard").applyInPandas(forest, "a long, b long").distinct()


def connected_components(
    spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b"
) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    Alternates two rounds until no edge changes: every node tells its larger
    neighbours the smallest one it knows, then its smaller ones. Each round is a
    pair of grouped minima, so a node with very many neighbours is summed in the
    map tasks first. Rounds are cut by written tables.
    """
    edges = written(
        spark,
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u <> v")
        .distinct(),
        "links",
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low"))
        least = least.select("u", F.least("u", "low").alias("low"))
        large = both.filter("v > u").join(least, "u")
        large = large.select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = written(spark, large.filter("u <> v").distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").filter("v <> low")
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.union(low.select("u", F.col("low").alias("v")))
        after = written(spark, small.filter("u <> v").distinct(), "links")
        state = [
            frame.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            for frame in (edges, after)
        ]
        edges = after
        if state[0] == state[1]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def simhash_components(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    max_bits: int = 3,
    shingle: int = 3,
    points_per_shard: int = 250_000,
) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id), one row per row of ``docs``.

    ``text_hash`` is Spark's xxhash64 of the text, ``root`` the smallest
    fingerprint of the component. The routing tree comes from a sample of
    distinct fingerprints, some dozens for each shard; it decides balance only,
    never which links are found.
    """
    spark = docs.sparkSession
    keep = [F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash")]
    marked = written(spark, with_fingerprint(docs, text, keep, shingle), "fingerprints")
    points = written(
        spark, marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "points"
    )
    n_points = points.count()
    shards = max(8, -(-n_points // points_per_shard))
    share = min(1.0, max(_ROUTING_POINTS, _ROUTING_POINTS_PER_SHARD * shards) / max(n_points, 1))
    drawn = F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) < int(share * (1 << 20))
    sample = points.filter(drawn).select("fp").toPandas()
    nodes = routing_tree(sample["fp"].to_numpy(np.int64).view(np.uint64), shards, max_bits)
    roots = connected_components(spark, _links(points, nodes, max_bits))
    placed = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    placed = written(spark, placed, "placed")
    ids = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_point = placed.join(ids, "root").select("fp", "root", "component_id")
    # One fingerprint may hold a third of all rows; they are narrow, and the
    # sort-merge join of a unique side lets Spark split such a partition.
    return marked.join(of_point, "fp")


def fingerprint_hex(fp: Column) -> Column:
    """16 lowercase hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    max_bits: int = 3,
    shingle: int = 3,
) -> DataFrame:
    """The rows of ``docs`` that represent their component, one each.

    That is the row of the smallest doc_id (nulls last, then the text's hash).
    """
    found = simhash_components(docs, text, doc_id, max_bits, shingle)
    order = F.struct(
        F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("text_hash")
    )
    chosen = found.groupBy("root").agg(F.min(order).alias("kept"))
    return rows_of(docs, chosen.select("kept.doc_id", "kept.text_hash"), text, doc_id)


def rows_of(docs: DataFrame, chosen: DataFrame, text: str, doc_id: str) -> DataFrame:
    """One row of ``docs`` for each chosen (doc_id, text_hash); both may be null-safe equal."""
    names = [f"c_{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    rows = rows.withColumn("_h", F.xxhash64(names[docs.columns.index(text)])).withColumn(
        "_id", F.col(names[docs.columns.index(doc_id)]).cast("long")
    )
    same = rows["_id"].eqNullSafe(chosen["doc_id"]) & (rows["_h"] == chosen["text_hash"])
    kept = rows.join(chosen.distinct(), same, "left_semi").dropDuplicates(["_id", "_h"])
    return kept.select(*names).toDF(*docs.columns)
