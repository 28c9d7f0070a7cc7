"""Joining row numbers to rows without an unchecked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of offsets that are broadcast at most, some 40 bytes each.
BROADCAST_OFFSETS = 1_000_000


def bounded(offsets: DataFrame, rows: int) -> DataFrame:
    """Offsets marked for broadcast if so many rows are few enough; else Spark shuffles both sides."""
    return F.broadcast(offsets) if rows <= BROADCAST_OFFSETS else offsets
