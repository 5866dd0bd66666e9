"""Fraud alerts on a stream.

Two chained queries. The first takes each micro-batch as a plain DataFrame: alerts inside it come
from the batch operator (with its cutting of heavy customers), and per customer the first and last
row go to a ``runs`` folder, from which they are deleted when the second query has read them. The second keeps every customer's last row as state and compares it
with the first row of that customer's next run. So Python sees one row per active customer and
micro-batch, however many transactions the customer made.

A row of a later micro-batch counts as a later arrival; inside a micro-batch ``seq`` decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import TimestampType

from tillstream.operators.fraud import (
    CUSTOMER,
    MAX_MINUTES,
    REMEMBERED,
    alert_columns,
    fraud_alerts,
    is_alert,
)
from tillstream.operators.latest import order_value
from tillstream.sinks.files import keep_newest
from tillstream.streaming.run import AVAILABLE_NOW, Trigger, make_folder, run

WriteAlerts = Callable[[DataFrame, str, int], None]
"""Receives alerts, the part that found them and the batch id; must be safe to repeat."""

# The remembered columns with the date as a number, as the state function handles them.
_PLAIN = ("country string", "ms bigint", "product string", "amount double")
_NAMES = [column.split()[0] for column in _PLAIN]
_STATE = ", ".join(("batch_id bigint", *_PLAIN))


def _prefixed(prefix: str) -> str:
    return ", ".join(f"{prefix}_{column}" for column in _PLAIN)


def _plain(row: str, prefix: str) -> list[Column]:
    country, date, product, amount = (F.col(f"{row}.{name}") for name in REMEMBERED)
    values = (country, F.unix_millis(date), product, amount)
    return [value.alias(f"{prefix}_{name}") for value, name in zip(values, _NAMES)]


def _remembered(prefix: str) -> Column:
    values = (
        F.col(f"{prefix}_country"),
        F.timestamp_millis(f"{prefix}_ms"),
        F.col(f"{prefix}_product"),
        F.col(f"{prefix}_amount"),
    )
    return F.struct(*[value.alias(name) for value, name in zip(values, REMEMBERED)])


class _Order:
    """The ordering columns on their way through Python: timestamps travel as microseconds."""

    def __init__(self, df: DataFrame, seq: Sequence[str]):
        self.names = list(seq)
        self.types = {name: df.schema[name].dataType for name in self.names}

    def _is_time(self, name: str) -> bool:
        return isinstance(self.types[name], TimestampType)

    def schema(self) -> str:
        return ", ".join(
            f"`{name}` {'bigint' if self._is_time(name) else self.types[name].simpleString()}"
            for name in self.names
        )

    def pack(self, row: str) -> list[Column]:
        columns = [(name, F.col(f"{row}.{name}")) for name in self.names]
        return [(F.unix_micros(c) if self._is_time(n) else c).alias(n) for n, c in columns]

    def unpack(self) -> list[Column]:
        return [
            (F.timestamp_micros(n) if self._is_time(n) else F.col(n)).alias(n) for n in self.names
        ]


def customer_runs(batch: DataFrame, seq: Sequence[str]) -> DataFrame:
    """Each customer's first and last transaction of the batch: one row per customer."""
    order = _Order(batch, seq)
    row = F.struct(*REMEMBERED, *seq)
    ends = batch.groupBy(CUSTOMER).agg(
        F.min_by(row, order_value(seq)).alias("first"),
        F.max_by(row, order_value(seq)).alias("last"),
    )
    return ends.select(
        CUSTOMER, *_plain("first", "first"), *_plain("last", "last"), *order.pack("first")
    )


def _carrier(
    columns: Sequence[str], kept: Sequence[str], max_ms: int, forget_ms: int | None = None
) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """The state function over the runs' ``columns``; as a closure it travels with the task, without this package.

    Most calls see one row, so rows are plain tuples and a frame is built for alerts only.
    """
    batch, size = columns.index("batch_id"), len(_NAMES)
    first, last = columns.index(f"first_{_NAMES[0]}"), columns.index(f"last_{_NAMES[0]}")
    passed_on = [columns.index(name) for name in kept]
    previous_columns = [f"previous_{name}" for name in _NAMES]
    types = {"previous_ms": "Int64", "previous_amount": "Float64"}

    def plain(value):
        return None if value is None or value != value else value

    def carry(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        """Pair the first row of every run with the last row of the run before it."""
        if forget_ms and state.hasTimedOut:
            state.remove()
            return
        seen = state.get if state.exists else None
        known = None if seen is None else seen[0]
        rows = [row for frame in frames for row in zip(*(frame[c].tolist() for c in columns))]
        rows.sort(key=lambda row: row[batch])
        alerts = []
        for row in rows:
            # A batch that was written twice is known already.
            if known is not None and row[batch] <= known:
                continue
            country, ms = plain(row[first]), row[first + 1]
            if seen is not None and country is not None and seen[1] not in (None, country):
                if 0 < ms - seen[2] < max_ms:
                    alerts.append((*(plain(row[i]) for i in passed_on), *seen[1:]))
            known = row[batch]
            values = [plain(value) for value in row[last:last + size]]
            # A column with a null comes as floats.
            values[1] = None if values[1] is None else int(values[1])
            seen = (known, *values)
        if rows and seen is not None:
            state.update(seen)
            if forget_ms:
                state.setTimeoutDuration(forget_ms)
        if alerts:
            found = pd.DataFrame(alerts, columns=[*kept, *previous_columns], dtype=object)
            yield found.astype(types)

    return carry


def link_runs(
    runs: DataFrame, order: _Order, max_minutes: int = MAX_MINUTES, forget_ms: int | None = None
) -> DataFrame:
    """(customer, previous, current, seq): consecutive runs of a customer that make an alert, on a stream."""
    output = ", ".join(
        (f"{CUSTOMER} string", _prefixed("first"), order.schema(), _prefixed("previous"))
    )
    kept = [CUSTOMER, *(f"first_{name}" for name in _NAMES), *order.names]
    carry = _carrier(runs.columns, kept, (max_minutes + 1) * 60000, forget_ms)
    timeout = GroupStateTimeout.ProcessingTimeTimeout if forget_ms else GroupStateTimeout.NoTimeout
    linked = runs.groupBy(CUSTOMER).applyInPandasWithState(
        carry, output, _STATE, "append", timeout
    )
    return linked.select(
        CUSTOMER,
        _remembered("previous").alias("previous"),
        _remembered("first").alias("current"),
        *order.unpack(),
    )


def start_fraud_alerts(
    transactions: DataFrame,
    write_alerts: WriteAlerts,
    folder: str,
    seq: Sequence[str] = ("seq",),
    trigger: Trigger = "5 seconds",
    max_minutes: int = MAX_MINUTES,
    ranges: int | None = None,
    forget_ms: int | None = None,
) -> list[StreamingQuery]:
    """Start both queries; ``folder`` keeps the runs, the alerts across batches and the checkpoints.

    Every customer's last row stays in the state for good, unless ``forget_ms`` says for how long without a
    transaction (by the clock) it is kept; a customer's next transaction then counts as the first. That needs a
    live trigger: a query that stops when all is read would wait for its time-outs for ever.
    """
    if forget_ms and trigger == AVAILABLE_NOW:
        raise ValueError("forget_ms needs a live trigger")
    spark = transactions.sparkSession
    seq = list(seq)
    order = _Order(transactions, seq)
    slim = transactions.where(F.col(CUSTOMER).isNotNull()).select(CUSTOMER, *REMEMBERED, *seq)

    def inside_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write_alerts(fraud_alerts(batch, seq, max_minutes, ranges), "inside", batch_id)
            # A repeated batch adds runs that the state knows.
            runs = customer_runs(batch, seq).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            runs.write.mode("append").parquet(f"{folder}/runs")
        finally:
            batch.unpersist()

    def across_batches(links: DataFrame, batch_id: int) -> None:
        # Every partition of the stateful query must run to its end, whatever the target reads.
        path = f"{folder}/links/batch_id={batch_id}"
        links.write.mode("overwrite").parquet(path)
        write_alerts(spark.read.schema(links.schema).parquet(path), "across", batch_id)
        keep_newest(spark, f"{folder}/links", 2)

    make_folder(spark, f"{folder}/runs")
    inside = run(slim.writeStream.foreachBatch(inside_batch), f"{folder}/inside", trigger)
    schema = ", ".join(
        (f"{CUSTOMER} string", _prefixed("first"), _prefixed("last"), order.schema(),
         "batch_id bigint")
    )
    runs = (
        spark.readStream.schema(schema)
        .option("ignoreMissingFiles", "true")
        # What the state has taken in is deleted.
        .option("cleanSource", "delete")
        .parquet(f"{folder}/runs")
    )
    alerts = link_runs(runs, order, max_minutes, forget_ms).where(is_alert("previous", "current", max_minutes))
    across = run(
        alerts.select(*alert_columns("previous", "current"), *seq)
        .writeStream.outputMode("append")
        .foreachBatch(across_batches),
        f"{folder}/across",
        trigger,
    )
    return [inside, across]
