"""Sales totals per category, day and month, and the running totals behind them.

Two modes. ``calendar`` groups by what the table names say. ``as_written`` gives what ends up
in the tables when totals are kept under one key and stored under another:

* category: the all-time total of a category, stored once per date on which it sold;
* day: each millisecond of arrival has its own total, and the last one of a date stays;
* month: totals are kept per month number, all years together, under the first year seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillstream.functions.values import money_parts, money_sum, money_total
from tillstream.operators.latest import order_value
from tillstream.operators.ranges import PIECE, in_ranges
from tillstream.session import scratch_folder

_MODES = ("calendar", "as_written")
_PARTS = ("_high", "_low", "_millionths", "_huge")
RUNNING_PARTS = tuple(f"_running{part}" for part in _PARTS)


def _check(mode: str) -> None:
    if mode not in _MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {_MODES}")


def sales_per_category(
    df: DataFrame, mode: str = "calendar", time_col: str | None = None
) -> DataFrame:
    """(transaction_date, category, total_sales); batch, or ``calendar`` on a stream.

    ``tillstream.streaming.as_written`` keeps the other mode on a stream.
    """
    _check(mode)
    day = F.to_date(_time(time_col, mode)).alias("transaction_date")
    category = F.col("product_category").alias("category")
    if mode == "calendar":
        return df.groupBy(day, category).agg(money_sum("total_amount").alias("total_sales"))
    # The window sees one row per date and category, never the transactions.
    per_day = df.groupBy(day, category).agg(
        *(F.sum(part).alias(name) for name, part in zip(_PARTS, money_parts("total_amount")))
    )
    so_far = W.partitionBy("category").orderBy("transaction_date").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    return per_day.select(
        "transaction_date",
        "category",
        money_total(*(F.sum(part).over(so_far) for part in _PARTS)).alias("total_sales"),
    )


def sales_per_day(df: DataFrame, mode: str = "calendar", time_col: str | None = None) -> DataFrame:
    """(transaction_date, total_sales); batch, or ``calendar`` on a stream (see ``streaming.as_written``)."""
    _check(mode)
    time = _time(time_col, mode)
    day = F.to_date(time).alias("transaction_date")
    total = money_sum("total_amount").alias("total_sales")
    if mode == "calendar":
        return df.groupBy(day).agg(total)
    # Only the last millisecond of a date counts. Finding it first saves a shuffle of all rows by
    # millisecond. Spark decides by size whether the one row per date is broadcast.
    stamped = df.select(day, F.unix_millis(time).alias("_ms"), "total_amount")
    last = stamped.groupBy("transaction_date").agg(F.max("_ms").alias("_ms"))
    return (
        stamped.join(last, ["transaction_date", "_ms"], "left_semi")
        .groupBy("transaction_date")
        .agg(total)
    )


def sales_per_month(
    df: DataFrame,
    mode: str = "calendar",
    time_col: str | None = None,
    seq: str | Sequence[str] = "seq",
) -> DataFrame:
    """(year, month, total_sales); batch or stream."""
    _check(mode)
    time = _time(time_col, mode)
    month = F.month(time).alias("month")
    total = money_sum("total_amount").alias("total_sales")
    if mode == "calendar":
        return df.groupBy(F.year(time).alias("year"), month).agg(total)
    first_year = F.min_by(F.year(time), order_value(seq)).alias("year")
    return df.groupBy(month).agg(first_year, total).select("year", "month", "total_sales")


def _time(time_col: str | None, mode: str) -> Column:
    return F.col(time_col or ("transaction_date" if mode == "calendar" else "ingest_ts"))


def running_totals(
    df: DataFrame,
    key: str,
    seq: str | Sequence[str] = "seq",
    amount: str = "total_amount",
    ranges: int | None = None,
) -> DataFrame:
    """Add ``running_total``: the key's total up to and including the row, in ``seq`` order.

    Batch; ``tillstream.streaming.running`` carries the totals from micro-batch to micro-batch. The rows are
    range-partitioned by (key, seq) and written with their totals inside the piece; a row's total is that plus what
    the key had when the piece began. One row per piece carries that over, so neither heavy keys nor null keys meet in
    one task.
    """
    rows = running_parts(df, key, seq, amount, ranges)
    return rows.select(*df.columns, money_total(*(F.col(part) for part in RUNNING_PARTS)).alias("running_total"))


def running_parts(
    df: DataFrame, key: str, seq: str | Sequence[str], amount: str, ranges: int | None = None
) -> DataFrame:
    """``df`` with the exact parts of each row's running total (null as long as there is nothing to sum)."""
    names = [seq] if isinstance(seq, str) else list(seq)
    so_far = (
        W.partitionBy(PIECE, key).orderBy(*names).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    parts = dict(zip(_PARTS, money_parts(amount)))
    rows = in_ranges(df, key, names, ranges)
    rows = rows.withColumns({name: F.sum(part).over(so_far) for name, part in parts.items()})
    # The table fixes the pieces for both of its readers.
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession, "running")
    rows.write.parquet(folder)
    rows = spark.read.parquet(folder)

    last = F.max_by(F.struct(F.col(key).alias("k"), *_PARTS), F.struct(key, *names)).alias("last")
    ends = rows.groupBy(PIECE).agg(last).select(PIECE, "last.*")
    earlier = W.partitionBy("k").orderBy(PIECE)
    carried = ends.select(
        F.lead(PIECE).over(W.orderBy(PIECE)).alias("_next"),
        "k",
        *(F.sum(part).over(earlier).alias(f"_c{part}") for part in _PARTS),
    )
    # One row per piece at most; its size on paper grows with the rows, and a stream has no second look at it.
    carried = F.broadcast(carried.where(F.col("_next").isNotNull()))
    joined = rows.join(
        carried, (F.col(PIECE) == F.col("_next")) & F.col(key).eqNullSafe(F.col("k")), "left"
    )
    sums = [sum_of(F.col(part), F.col(f"_c{part}")).alias(name) for part, name in zip(_PARTS, RUNNING_PARTS)]
    return joined.select(*df.columns, *sums)


def sum_of(a: Column, b: Column) -> Column:
    """The sum of two parts, of which one or both may be missing."""
    return F.coalesce(a + b, a, b)
