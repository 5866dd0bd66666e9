"""Last write per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def order_value(seq: str | Sequence[str]) -> Column:
    """One comparable value out of one or more ordering columns."""
    names = [seq] if isinstance(seq, str) else list(seq)
    return F.col(names[0]) if len(names) == 1 else F.struct(*names)


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], seq: str | Sequence[str] = "seq"
) -> DataFrame:
    """For every key the row with the greatest ``seq``.

    Spark turns "first row of each window" into a limit per key that every task applies before
    the shuffle, so a key with very many writes moves no more data than any other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = [seq] if isinstance(seq, str) else list(seq)
    newest_first = W.partitionBy(*keys).orderBy(*[F.desc(name) for name in names])
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
