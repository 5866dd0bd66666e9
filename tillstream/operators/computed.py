"""Expensive expressions, evaluated once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, *columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, however often they are used.

    Projections are merged, and a filter is pushed below them together with a copy of every
    expression it uses: a JSON read would then run once per use. Neither passes a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))
