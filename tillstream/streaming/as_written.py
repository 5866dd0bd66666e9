"""The sales tables as a job stores them that sums under one key and upserts under another, on a stream.

* category: a date keeps the category's total up to and including it. A batch reads the dates from its earliest one on
  (they all grow when a late sale comes) and the last total of each category, nothing else.
* day: only the last millisecond of a date counts, so (last millisecond, its total) per date is the state. A batch
  reads the dates from its earliest to its latest.

Totals are kept as exact parts. The state is a folder table next to the checkpoint, merged every MERGE_EVERY batches
and sorted by date, so what a batch reads does not grow with the number of batches before it; a repeated batch
stores the same again. Rows without a date have no place here (parsing rejects them) and are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions.values import money_parts, money_total
from tillstream.schema import TableDef
from tillstream.sinks.tables import FolderTables
from tillstream.streaming.run import Trigger, run

Store = Callable[[DataFrame, int], None]
MERGE_EVERY = 10
DATE, CATEGORY = "transaction_date", "category"
PARTS = ("high", "low", "millionths", "huge", "amounts")
TOTALS = tuple(f"total_{part}" for part in PARTS)
_STATE = {
    "category_days": TableDef((), (DATE, CATEGORY)),
    "category_totals": TableDef((), (CATEGORY,)),
    "last_ms": TableDef((), (DATE,)),
}


def state_tables(checkpoint: str) -> FolderTables:
    """The stream is the only reader of its state: merged folders can go at once."""
    return FolderTables(f"{checkpoint}-state", _STATE, compact_every=MERGE_EVERY, grace=0)


def part_sums(amount: str = "total_amount") -> list[Column]:
    """Exact parts of a sum and how many amounts it has; 0 where there is nothing to sum."""
    sums = [F.coalesce(F.sum(part), F.lit(0)) for part in money_parts(amount)]
    return [column.alias(name) for column, name in zip([*sums, F.count(amount)], PARTS)]


def part_total(names: Sequence[str] = PARTS) -> Column:
    """The amount of summed parts; null if there was nothing to sum."""
    *parts, amounts = (F.col(name) for name in names)
    return F.when(amounts > 0, money_total(*parts))


def category_totals(new: DataFrame, days: DataFrame, totals: DataFrame) -> DataFrame:
    """The rows (date, category, parts of the day, parts of the total) that ``new`` sums of days change.

    ``days`` are the stored rows from the first new date on; ``totals`` the last totals of all categories.
    """
    touched = new.select(CATEGORY).distinct()
    days = days.join(touched, days[CATEGORY].eqNullSafe(touched[CATEGORY]), "left_semi")
    # What a category had before its first date here: that date's total without its own sales, or the last total.
    before = F.struct(*((F.col(t) - F.col(p)).alias(t) for t, p in zip(TOTALS, PARTS)))
    first = days.groupBy(F.col(CATEGORY).alias("_a")).agg(F.min_by(before, DATE).alias("_first"))
    last = totals.select(F.col(CATEGORY).alias("_b"), F.struct(*TOTALS).alias("_last"))
    start = (
        touched.withColumnRenamed(CATEGORY, "_c")
        .join(first, F.col("_c").eqNullSafe(F.col("_a")), "left")
        .join(last, F.col("_c").eqNullSafe(F.col("_b")), "left")
        .select("_c", F.coalesce("_first", "_last").alias("_start"))
    )
    every = new.withColumn("_new", F.lit(1)).unionByName(days.select(DATE, CATEGORY, *PARTS, F.lit(0).alias("_new")))
    every = every.groupBy(DATE, CATEGORY).agg(*(F.sum(p).alias(p) for p in PARTS), F.max("_new").alias("_new"))
    so_far = W.partitionBy(CATEGORY).orderBy(DATE).rowsBetween(W.unboundedPreceding, W.currentRow)
    every = every.join(start, F.col(CATEGORY).eqNullSafe(F.col("_c")))
    sums = [(F.sum(p).over(so_far) + F.coalesce(F.col(f"_start.{t}"), F.lit(0))).alias(t) for p, t in zip(PARTS, TOTALS)]
    changed = every.select(DATE, CATEGORY, *PARTS, *sums, F.max("_new").over(so_far).alias("_changed"))
    return changed.where(F.col("_changed") == 1).drop("_changed")


def start_category_as_written(
    transactions: DataFrame, store: Store, checkpoint: str, time_col: str, trigger: Trigger
) -> StreamingQuery:
    state = state_tables(checkpoint)
    slim = transactions.select(
        F.to_date(time_col).alias(DATE), F.col("product_category").alias(CATEGORY), "total_amount"
    ).where(F.col(DATE).isNotNull())

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.groupBy(DATE, CATEGORY).agg(*part_sums()).persist()
        try:
            low = new.agg(F.min(DATE)).first()[0]
            none = new.select("*", *(F.col(p).alias(t) for p, t in zip(PARTS, TOTALS))).limit(0)
            days = state.read_before(spark, "category_days", batch_id)
            days = none if days is None else days.where(F.col(DATE) >= F.lit(low))
            totals = state.read_before(spark, "category_totals", batch_id)
            state.upsert(category_totals(new, days, none if totals is None else totals), "category_days", batch_id)
        finally:
            new.unpersist()
        changed = state.read_batch(spark, "category_days", batch_id)
        newest = F.max_by(F.struct(*TOTALS), DATE).alias("newest")
        last = changed.groupBy(CATEGORY).agg(newest).select(CATEGORY, "newest.*")
        state.upsert(last, "category_totals", batch_id)
        store(changed.select(DATE, CATEGORY, part_total(TOTALS).alias("total_sales")), batch_id)

    return run(slim.writeStream.foreachBatch(update), checkpoint, trigger)


def last_ms_totals(new: DataFrame, stored: DataFrame | None) -> DataFrame:
    """(date, ms, parts) of each date's last millisecond; rows of one millisecond may come in several batches."""
    if stored is not None:
        new = new.unionByName(stored)
    both = new.groupBy(DATE, "ms").agg(*(F.sum(part).alias(part) for part in PARTS))
    newest = both.groupBy(DATE).agg(F.max_by(F.struct("ms", *PARTS), "ms").alias("newest"))
    return newest.select(DATE, "newest.*")


def start_day_as_written(
    transactions: DataFrame, store: Store, checkpoint: str, time_col: str, trigger: Trigger
) -> StreamingQuery:
    state = state_tables(checkpoint)
    slim = transactions.select(
        F.to_date(time_col).alias(DATE), F.unix_millis(time_col).alias("ms"), "total_amount"
    ).where(F.col(DATE).isNotNull())

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = batch.groupBy(DATE).agg(F.max("ms").alias("ms"))
        new = batch.join(last, [DATE, "ms"], "left_semi").groupBy(DATE, "ms").agg(*part_sums()).persist()
        try:
            low, high = new.agg(F.min(DATE), F.max(DATE)).first()
            stored = state.read_before(spark, "last_ms", batch_id)
            if stored is not None:
                stored = stored.where(F.col(DATE).between(F.lit(low), F.lit(high)))
                stored = stored.join(new.select(DATE).distinct(), DATE, "left_semi")
            state.upsert(last_ms_totals(new, stored), "last_ms", batch_id)
        finally:
            new.unpersist()
        rows = state.read_batch(spark, "last_ms", batch_id)
        store(rows.select(DATE, part_total().alias("total_sales")), batch_id)

    return run(slim.writeStream.foreachBatch(update), checkpoint, trigger)
