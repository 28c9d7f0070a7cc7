"""Use of all cores when a source comes in few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame

PIECES_SETTING = "winnower.source.pieces"


def spread(scan: DataFrame, pieces: int | None) -> DataFrame:
    """The scan, dealt to so many tasks if the caller asks for it.

    A file of one row group, or a compressed JSON file, is one task however
    expensive the work on its rows, so a small table may be worth a shuffle of
    its rows. A large one has pieces enough; nothing is decided by counting.
    """
    return scan.repartition(pieces) if pieces else scan
