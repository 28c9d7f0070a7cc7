"""Exact deduplication that keeps the first copy in source order."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(selected: DataFrame, key: str = "key", order: str = "seq") -> DataFrame:
    """Keep the row with the lowest ``order`` of each ``key``.

    Spark puts a group limit in front of the shuffle, so a map task sends one
    row per key: a key that fills a third of the table arrives as one row per
    map task. Of rows equal in both, any one is kept. A NULL ``order`` comes last,
    here as in the other functions of this module.
    """
    by_key = Window.partitionBy(key).orderBy(F.asc_nulls_last(order))
    return (
        selected.withColumn("_copy", F.row_number().over(by_key))
        .where(F.col("_copy") == 1)
        .drop("_copy")
    )


def keep_first_in_order(selected: DataFrame, key: str = "key", order: str = "seq") -> DataFrame:
    """One row of each ``key``, that of its lowest ``order``, sorted, for one shuffle of rows.

    Deduplicating and then sorting would shuffle the texts twice. Here the first
    ``order`` of each key comes from an aggregation of these two columns, which
    combines copies before its shuffle. One range shuffle by both then brings
    rows and survivors together, so a repeated ``order`` does not gather in one
    task and may belong to several keys; of rows equal in both, one is kept.
    A NULL ``order`` counts only for a key that has no other, and sorts last.
    ``selected`` is read twice and should be a written table.
    """
    survivors = selected.groupBy(key).agg(F.min(order).alias(order))
    marked = selected.withColumn("_survivor", F.lit(False)).unionByName(
        survivors.withColumn("_survivor", F.lit(True)), allowMissingColumns=True
    )
    same = Window.partitionBy(order, key)
    return (
        marked.repartitionByRange(F.asc_nulls_last(order), key)
        .withColumn("_survives", F.max("_survivor").over(same))
        .withColumn("_copy", F.row_number().over(same.orderBy("_survivor")))
        .where(F.col("_survives") & ~F.col("_survivor") & (F.col("_copy") == 1))
        .sortWithinPartitions(F.asc_nulls_last(order), key)
        .drop("_survives", "_survivor", "_copy")
    )


def first_kept(selected: DataFrame, rows: int, order: str = "seq") -> DataFrame:
    """First ``rows`` of ``keep_first(selected)`` in source order.

    Whether a row survives depends on earlier rows only, so the answer lies in
    a head of the table. The head starts at four times the rows wanted and grows
    until it holds enough; ``order`` prunes the row groups of a written table, so
    that a few hundred rows do not cost a deduplication of everything.
    """
    low, high, total = selected.agg(F.min(order), F.max(order), F.count(order)).first()
    last = F.asc_nulls_last(order)
    span = 4 * rows * math.ceil((high - low + 1) / total) if total else 0
    while total and low + span <= high:
        head = keep_first(selected.where(F.col(order) < low + span), order=order)
        if head.count() >= rows:
            return head.orderBy(last).limit(rows)
        span *= 4
    return keep_first(selected, order=order).orderBy(last).limit(rows)
