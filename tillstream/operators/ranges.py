"""Rows in ranges of (key, order), so that no key decides the size of a task.

Spark's range partitioning cuts the sorted rows into even pieces, whatever the keys, their nulls and the types of the
ordering columns. A piece holds whole keys except at its two ends. Operators run one window per piece and carry one
row from each piece to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = "_piece"


def in_ranges(df: DataFrame, key: str, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """``df`` with the number of its piece, ascending along (key, order).

    ``ranges`` sets how many pieces there are; by default Spark sizes them. The number holds inside one plan
    branch: a second branch would be sampled anew.
    """
    by = (key, *order)
    ranged = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    return ranged.withColumn(PIECE, F.spark_partition_id())
