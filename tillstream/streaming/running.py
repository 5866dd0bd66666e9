"""Running totals on a stream: each transaction with its key's total so far, over all micro-batches.

Two chained queries. The first computes the totals inside each micro-batch with the batch operator (ranges of rows, so a
heavy key is no task of its own) and passes on one row per key: what the batch adds to it. The second keeps each key's
total as state and says what a key had before a batch; the rows of that batch are then stored with their totals. So
Python sees one row per active key and micro-batch.

A row of a later micro-batch counts as a later arrival; inside a micro-batch ``seq`` decides. Totals travel as exact
parts, as texts, since a whole number next to a missing one would become a double in pandas.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillstream.functions.values import money_total
from tillstream.operators.latest import order_value
from tillstream.operators.sales import RUNNING_PARTS, running_parts, sum_of
from tillstream.sinks.files import Files
from tillstream.streaming.run import Trigger, make_folder, run

Store = Callable[[DataFrame, int], None]
_KEY, _BATCH = "_key", "_batch"
_TYPES = ("bigint", "bigint", "bigint", "double")
_TEXTS = ", ".join(f"{part} string" for part in RUNNING_PARTS)
_SUMS = f"{_KEY} string, {_TEXTS}, {_BATCH} bigint"
_BEFORE = f"{_KEY} string, {_BATCH} bigint, {_TEXTS}"
_STATE = f"{_BATCH} bigint, {_TEXTS}"


def _key(key: str) -> Column:
    """The key as a text that is never null."""
    return F.to_json(F.struct(F.col(key).alias("k")))


def _carrier(columns: Sequence[str], parts: Sequence[str]) -> Callable:
    """The state function; as a closure it travels with the task, without this package."""
    batch, first = columns.index("_batch"), [columns.index(part) for part in parts]

    def number(text: str | None, whole: bool) -> int | float | None:
        return None if text is None or text != text else int(text) if whole else float(text)

    def plus(a: str | None, b: str | None, whole: bool) -> str | None:
        x, y = number(a, whole), number(b, whole)
        return (b if x is None else a) if x is None or y is None else repr(x + y)

    def carry(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """What the key had before each batch; a batch that was passed on twice is known already."""
        known, total = (state.get[0], list(state.get[1:])) if state.exists else (None, [None] * len(parts))
        rows = [row for frame in frames for row in zip(*(frame[c].tolist() for c in columns))]
        found = []
        for row in sorted(rows, key=lambda row: row[batch]):
            if known is not None and row[batch] <= known:
                continue
            known = row[batch]
            found.append((key[0], known, *total))
            total = [plus(a, row[i], k < len(parts) - 1) for k, (a, i) in enumerate(zip(total, first))]
        if found:
            state.update((known, *total))
            yield pd.DataFrame(found, columns=["_key", "_batch", *parts], dtype=object).astype({"_batch": "int64"})

    return carry


def start_running_totals(
    transactions: DataFrame,
    store: Store,
    folder: str,
    key: str,
    seq: str | Sequence[str] = "seq",
    amount: str = "total_amount",
    trigger: Trigger = "5 seconds",
    ranges: int | None = None,
) -> list[StreamingQuery]:
    """Start both queries; ``store`` gets the transactions with ``running_total`` and a batch id, and is safe to repeat.

    ``folder`` keeps the rows between the two, the sums and the checkpoints. What the second query has stored is
    deleted when it goes on to later batches.
    """
    spark = transactions.sparkSession
    rows_at, sums_at, before_at = (f"{folder}/{name}" for name in ("rows", "sums", "before"))

    def inside_batch(batch: DataFrame, batch_id: int) -> None:
        path = f"{rows_at}/{batch_id}"
        running_parts(batch, key, seq, amount, ranges).withColumn(_KEY, _key(key)).write.mode("overwrite").parquet(path)
        last = F.max_by(F.struct(*(F.col(part).cast("string").alias(part) for part in RUNNING_PARTS)), order_value(seq))
        sums = spark.read.parquet(path).groupBy(_KEY).agg(last.alias("last")).select(_KEY, "last.*")
        # The rows are there before their sums, and a repeated batch adds sums that the state knows.
        sums.withColumn(_BATCH, F.lit(batch_id).cast("bigint")).write.mode("append").parquet(sums_at)

    def with_totals(before: DataFrame, batch_id: int) -> None:
        # Every partition of the stateful query must run to its end, whatever the target reads.
        path = f"{before_at}/{batch_id}"
        before.write.mode("overwrite").parquet(path)
        before = spark.read.schema(before.schema).parquet(path)
        batches = sorted(row[0] for row in before.select(_BATCH).distinct().collect())
        carried = before.select(
            _KEY, _BATCH, *(F.col(part).cast(kind).alias(f"_before{part}") for part, kind in zip(RUNNING_PARTS, _TYPES))
        )
        for number in batches:
            rows = spark.read.parquet(f"{rows_at}/{number}")
            # Spark decides by size whether the keys are broadcast.
            rows = rows.join(carried.where(F.col(_BATCH) == number), _KEY)
            total = money_total(*(sum_of(F.col(part), F.col(f"_before{part}")) for part in RUNNING_PARTS))
            store(rows.select(*transactions.columns, total.alias("running_total")), number)
        files = Files(spark, folder)
        for name in files.names(before_at):
            if int(name) < batch_id:
                files.delete(f"{before_at}/{name}")
        for name in files.names(rows_at):
            if batches and int(name) < batches[0]:
                files.delete(f"{rows_at}/{name}")

    make_folder(spark, sums_at)
    inside = run(transactions.writeStream.foreachBatch(inside_batch), f"{folder}/inside", trigger)
    sums = (
        spark.readStream.schema(_SUMS)
        .option("ignoreMissingFiles", "true")
        .option("cleanSource", "delete")
        .parquet(sums_at)
    )
    before = sums.groupBy(_KEY).applyInPandasWithState(
        _carrier(sums.columns, RUNNING_PARTS), _BEFORE, _STATE, "append", GroupStateTimeout.NoTimeout
    )
    across = run(before.writeStream.outputMode("append").foreachBatch(with_totals), f"{folder}/across", trigger)
    return [inside, across]
