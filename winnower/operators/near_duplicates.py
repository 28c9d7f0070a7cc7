"""Classes of texts that nearly repeat each other.

Two texts are linked if the sets of their word shingles have a Jaccard similarity
of the least share or more; a class is what links connect. Equal sets are one
node. Candidates come from MinHash bands: the smallest hash of a set in each of many
ranges of hashes, in bands of a few, so that linked sets agree in one band at
least with a probability of 1 - (1 - s^rows)^bands, 0.9998 at a similarity of 0.8.

A band's bucket is compared as a whole only if it is small. In a larger one every
member is compared with a few hubs, members taken by hash, which links a crowd of
copies for a few comparisons each; then buckets with a member that is linked to no
hub go on with longer keys, which part what is not alike. So the comparisons
grow with the members of a bucket, never with their square. What that can lose are
links between two texts of one crowded bucket that meet no common hub and part
again before their bucket is small; ``tests`` measure the recall.

All of it is built-in expressions: every text is hashed once for its signature;
only those of candidates are built and hashed once more, to verify exact sets. Of
all bands only the entries of shared buckets are kept, and longer keys are made of
open nodes alone, so each round costs what is still to be settled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnower.operators.components import connected_classes
from winnower.storage import written

_SPOKES_PER_TASK = 2048


@dataclass(frozen=True)
class Likeness:
    """What counts as alike, and how candidates are found."""

    words: int = 5
    least_percent: int = 80
    bands: int = 16
    rows: int = 4
    whole_bucket: int = 32
    hubs: int = 3
    lengths: tuple[int, ...] = (1, 2, 4)

    def __post_init__(self) -> None:
        ranges = self.bands * self.rows
        if ranges & (ranges - 1):
            raise ValueError(f"{self.bands} bands of {self.rows} are not a power of two")


def shingle_hashes(text: Column, words: int) -> Column:
    """Distinct hashes of all runs of so many words; of a shorter text, of all its words."""

    def hashed(tokens: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(tokens) - F.lit(words))
        runs = F.transform(
            starts, lambda at: F.xxhash64(*(F.get(tokens, at + F.lit(i)) for i in range(words)))
        )
        return F.when(F.size(tokens) < words, F.array(F.xxhash64(text))).otherwise(runs)

    # A one-element array names the words, so that a text is split once.
    split = F.transform(F.array(F.split(text, " ")), hashed)
    none = F.array().cast("array<bigint>")
    return F.when(text == "", none).otherwise(F.array_distinct(F.get(split, F.lit(0))))


def _minima(hashes: Column, bins: int) -> Column:
    """The least hash of each of so many equal ranges, from sorted hashes.

    An empty range has the least hash of the next one that is not, from the top
    on to the bottom again; equal sets agree in all ranges, and others in a range
    about as often as they are similar.
    """
    shift = 64 - (bins - 1).bit_length()

    def of(sorted_hashes: Column) -> Column:
        def begins(h: Column, at: Column) -> Column:
            before = F.get(sorted_hashes, at - 1)
            return (at == 0) | (F.shiftright(h, shift) != F.shiftright(before, shift))

        return F.filter(sorted_hashes, begins)

    def filled(firsts: Column) -> Column:
        def at(place: Column) -> Column:
            later = F.filter(firsts, lambda h: F.shiftright(h, shift) + F.lit(bins // 2) >= place)
            return F.coalesce(F.get(later, F.lit(0)), F.get(firsts, F.lit(0)))

        full = F.size(firsts) == bins
        return F.when(full, firsts).otherwise(F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), at))

    return F.get(F.transform(F.array(of(hashes)), filled), F.lit(0))


def _signatures(rows: DataFrame, how: Likeness) -> DataFrame:
    """(id, text_hash, node, n, minima): ``node`` stands for the set of shingles."""
    sets = rows.select(
        "id",
        F.xxhash64("text").alias("text_hash"),
        F.sort_array(shingle_hashes(F.col("text"), how.words)).alias("hashes"),
    )
    halves = (F.lpad(F.hex(F.xxhash64(F.lit(i), "hashes")), 16, "0") for i in range(2))
    return sets.select(
        "id",
        "text_hash",
        F.unhex(F.concat(*halves)).alias("node"),
        F.size("hashes").alias("n"),
        _minima(F.col("hashes"), how.bands * how.rows).alias("minima"),
    )


def _entries(nodes: DataFrame, how: Likeness, length: int) -> DataFrame:
    """(band, key, node, n): keys of ``length * rows`` minima, from the band's own ones on."""
    total, size = how.bands * how.rows, how.rows * length
    keys = [
        F.xxhash64(*(F.get("minima", F.lit((band * how.rows + i) % total)) for i in range(size)))
        for band in range(how.bands)
    ]
    return nodes.select("node", "n", F.posexplode(F.array(*keys)).alias("band", "key"))


def _open_entries(nodes: DataFrame, open_nodes: DataFrame, how: Likeness, length: int) -> DataFrame:
    """The entries of open (band, node) only; no key is made of any other node."""
    some = nodes.join(open_nodes.select("node").distinct(), "node", "left_semi")
    return _entries(some, how, length).join(open_nodes, ["band", "node"], "left_semi")


def _shared(entries: DataFrame) -> DataFrame:
    """The entries of keys that more than one node has; only counts of the others are shuffled."""
    keys = entries.groupBy("band", "key").agg(F.count("*").alias("size")).filter("size > 1")
    return entries.join(keys.select("band", "key"), ["band", "key"], "left_semi")


def _buckets(entries: DataFrame, how: Likeness, length: int) -> DataFrame:
    """(band, key, size, hubs) of buckets with more than one member."""
    hubs = [
        F.min(F.struct(F.xxhash64("node", F.lit(100 * length + i)).alias("at"), "node", "n"))
        for i in range(how.hubs)
    ]
    found = entries.groupBy("band", "key").agg(
        F.count("*").alias("size"), *(hub.alias(f"hub{i}") for i, hub in enumerate(hubs))
    )
    names = [f"hub{i}" for i in range(how.hubs)]
    return found.filter("size > 1").select("band", "key", "size", F.array_distinct(F.array(*names)).alias("hubs"))


def _fits(how: Likeness, a: str, b: str) -> Column:
    """Whether sets of these sizes can be alike at all."""
    return 100 * F.least(a, b) >= how.least_percent * F.greatest(a, b)


def _candidates(entries: DataFrame, buckets: DataFrame, how: Likeness) -> DataFrame:
    """(a, b, n_a, n_b) without repeats: spokes and hubs, and all pairs of small buckets."""
    members = entries.join(buckets, ["band", "key"])
    large = members.filter(F.col("size") > how.whole_bucket).select(
        F.col("node").alias("a"), F.col("n").alias("n_a"), F.explode("hubs").alias("hub")
    )
    spokes = large.select("a", F.col("hub.node").alias("b"), "n_a", F.col("hub.n").alias("n_b"))
    small = members.filter(F.col("size") <= how.whole_bucket).groupBy("band", "key").agg(
        F.sort_array(F.collect_list(F.struct("node", "n"))).alias("all")
    )
    firsts = small.select(F.posexplode("all").alias("at", "one"), "all")
    pairs = firsts.select("one", F.explode(F.slice("all", F.col("at") + 2, F.size("all"))).alias("other"))
    pairs = pairs.select(
        F.col("other.node").alias("a"), F.col("one.node").alias("b"),
        F.col("other.n").alias("n_a"), F.col("one.n").alias("n_b"),
    )
    return spokes.union(pairs).filter("a <> b").filter(_fits(how, "n_a", "n_b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, how: Likeness) -> DataFrame:
    """The pairs whose exact sets are alike.

    A spoke brings its set to the hub. The hub's own set is copied once for every
    few thousand spokes, so a hub of very many is spread over tasks.
    """
    load = pairs.groupBy("b").agg(F.ceil(F.count("*") / _SPOKES_PER_TASK).cast("int").alias("parts"))
    spokes = pairs.join(load, "b").select(
        "a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part")
    )
    spokes = spokes.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("of_a")), "a")
    parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    hubs = load.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("of_b")), "b")
    both = spokes.join(hubs.select("b", parts, "of_b"), ["b", "part"])
    common = both.select(
        "a",
        "b",
        F.size(F.array_intersect("of_a", "of_b")).alias("common"),
        (F.size("of_a") + F.size("of_b")).alias("sum"),
    )
    alike = 100 * F.col("common") >= how.least_percent * (F.col("sum") - F.col("common"))
    return common.filter(alike).select("a", "b")


def near_duplicate_classes(
    rows: DataFrame, text: Column, row_id: str = "seq", how: Likeness = Likeness()
) -> DataFrame:
    """(id, text_hash, class_id), one row for each row.

    ``text`` is normalised text, words divided by one space. ``class_id`` is the
    smallest id of the class. Wordless texts are one class; null ids take part.
    """
    spark = rows.sparkSession
    texts = rows.select(F.col(row_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    signed = written(spark, _signatures(texts, how), "signatures")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first")
    nodes = signed.filter("n > 0").groupBy("node").agg(
        first, F.any_value("n").alias("n"), F.any_value("minima").alias("minima")
    )
    nodes = written(spark, nodes, "nodes")
    links = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    sets = nodes.select("node", F.col("minima").alias("hashes")).limit(0)
    entries = _entries(nodes, how, how.lengths[0])
    for length, longer in zip(how.lengths, (*how.lengths[1:], None), strict=True):
        entries = written(spark, _shared(entries), "entries")
        buckets = written(spark, _buckets(entries, how, length), "buckets")
        pairs = written(spark, _candidates(entries, buckets, how), "pairs")
        sets = _with_sets_of(sets, texts, nodes, pairs, how)
        found = written(spark, _verified(pairs, sets, how), "links")
        links = links.union(found)
        if longer is None:
            break
        open_nodes = written(spark, _unattached(entries, buckets, found, how), "open")
        if open_nodes.isEmpty():
            break
        entries = written(spark, _open_entries(nodes, open_nodes, how, longer), "entries")
    classes = connected_classes(links)
    of_node = signed.join(classes, signed["node"] == classes["node"], "left").select(
        "id", "text_hash", F.coalesce("root", signed["node"]).alias("root")
    )
    of_node = written(spark, of_node, "classes")
    least = of_node.groupBy("root").agg(F.min("id").alias("class_id"))
    return of_node.join(least, "root").select("id", "text_hash", "class_id")


def _unattached(
    entries: DataFrame, buckets: DataFrame, links: DataFrame, how: Likeness
) -> DataFrame:
    """(band, node) of all members of large buckets where some member is linked to no hub."""
    crowded = buckets.filter(F.col("size") > how.whole_bucket)
    members = entries.join(crowded.select("band", "key", "hubs"), ["band", "key"])
    members = members.select("band", "key", "node", F.explode("hubs.node").alias("hub"))
    linked = links.select(F.col("a").alias("node"), F.col("b").alias("hub"), F.lit(True).alias("_linked"))
    attached = members.join(linked, ["node", "hub"], "left").select(
        "band", "key", "node", (F.col("_linked").isNotNull() | (F.col("node") == F.col("hub"))).alias("attached")
    )
    attached = attached.groupBy("band", "key", "node").agg(F.max("attached").alias("attached"))
    unsettled = attached.filter(~F.col("attached")).select("band", "key").distinct()
    return attached.join(unsettled, ["band", "key"]).select("band", "node")


def _with_sets_of(
    sets: DataFrame, texts: DataFrame, nodes: DataFrame, pairs: DataFrame, how: Likeness
) -> DataFrame:
    """(node, hashes): the sets at hand and those of other nodes in the pairs, from one text of each."""
    asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    asked = asked.join(sets, "node", "left_anti").join(nodes.select("node", "first.*"), "node")
    asked = written(texts.sparkSession, asked.select("node", "id", "text_hash"), "asked")
    if asked.isEmpty():
        return sets
    ids = asked.select(F.col("id").alias("_asked")).distinct()
    some = texts.join(ids, F.col("id").eqNullSafe(F.col("_asked")), "left_semi")
    keyed = some.select(F.col("id").alias("_id"), F.xxhash64("text").alias("_hash"), "text")
    same = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("text_hash"))
    found = keyed.join(asked, same).select("node", shingle_hashes(F.col("text"), how.words).alias("hashes"))
    return sets.union(written(texts.sparkSession, found.dropDuplicates(["node"]), "sets"))
