"""Fraud alerts: one customer, two countries, minutes apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillstream.functions import text
from tillstream.functions.values import elapsed_ms, remaining_seconds, whole_minutes
from tillstream.operators.ranges import PIECE, in_ranges

MAX_MINUTES = 5
CUSTOMER = "customer_id"
# What is remembered of the previous transaction.
REMEMBERED = ("customer_country", "transaction_date", "product_name", "total_amount")


def remembered() -> Column:
    return F.struct(*REMEMBERED)


def is_alert(previous: str, current: str, max_minutes: int = MAX_MINUTES) -> Column:
    """Countries known and different, time going forward, and at most ``max_minutes`` whole minutes.

    Whole minutes are compared, so five minutes and 59.999 seconds still count as five. A null
    country or a missing previous row makes the comparison null, which is no alert.
    """
    ms = elapsed_ms(F.col(f"{current}.transaction_date"), F.col(f"{previous}.transaction_date"))
    differs = F.col(f"{current}.customer_country") != F.col(f"{previous}.customer_country")
    return differs & (ms > 0) & (ms < (max_minutes + 1) * 60000)


def alert_columns(previous: str, current: str) -> list[Column]:
    ms = elapsed_ms(F.col(f"{current}.transaction_date"), F.col(f"{previous}.transaction_date"))
    return [
        F.col(CUSTOMER),
        F.col(f"{previous}.customer_country").alias("previous_country"),
        F.col(f"{previous}.transaction_date").alias("previous_date"),
        F.col(f"{previous}.product_name").alias("previous_product"),
        F.col(f"{previous}.total_amount").alias("previous_amount"),
        F.col(f"{current}.customer_country").alias("country"),
        F.col(f"{current}.transaction_date").alias("date"),
        F.col(f"{current}.product_name").alias("product"),
        F.col(f"{current}.total_amount").alias("amount"),
        whole_minutes(ms).cast("bigint").alias("minutes"),
        remaining_seconds(ms).cast("bigint").alias("seconds"),
    ]


def fraud_alerts(
    df: DataFrame,
    seq: str | Sequence[str] = "seq",
    max_minutes: int = MAX_MINUTES,
    ranges: int | None = None,
) -> DataFrame:
    """Compare every transaction with the same customer's previous one in arrival order.

    Batch only; ``tillstream.streaming.fraud`` is the stream form. The previous row is whatever
    arrived before, also when its date is later or its country unknown. The rows are range-partitioned by
    (customer, seq), so a customer of any size is spread over pieces: alerts inside a piece are found
    there, and the first and last row of each piece meet in a second, small window.
    """
    names = [seq] if isinstance(seq, str) else list(seq)
    slim = df.where(F.col(CUSTOMER).isNotNull()).select(
        CUSTOMER, *names, remembered().alias("current")
    )
    order = (CUSTOMER, *names)
    in_piece = W.partitionBy(PIECE).orderBy(*order)
    row = F.struct(F.col(CUSTOMER).alias("customer"), "current")

    def same_customer(before: str) -> Column:
        return F.when(F.col(f"{before}.customer") == F.col(CUSTOMER), F.col(f"{before}.current"))

    linked = in_ranges(slim, CUSTOMER, names, ranges).withColumns(
        {"_before": F.lag(row).over(in_piece), "_last": F.lead(F.lit(True)).over(in_piece).isNull()}
    )
    linked = linked.withColumns(
        {"previous": same_customer("_before"), "_first": F.col("_before").isNull()}
    )
    alert = is_alert("previous", "current", max_minutes)
    survivors = linked.where(F.col("_first") | F.col("_last") | alert)
    # Two rows per piece meet; the alerts found already stay apart in their pieces.
    group = F.when(~(F.col("_first") | F.col("_last")), F.col(PIECE))
    survivors = survivors.withColumn("_before", F.lag(row).over(W.partitionBy(group).orderBy(*order)))
    linked = survivors.withColumn(
        "previous", F.when(F.col("_first"), same_customer("_before")).otherwise(F.col("previous"))
    )
    return linked.where(alert).select(*alert_columns("previous", "current"), *names)


def alert_text(alerts: DataFrame) -> DataFrame:
    """Add the printable alert box."""
    return alerts.withColumn("alert", text.alert_text())
