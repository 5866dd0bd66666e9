"""Row-wise forms of a transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions import text
from tillstream.functions.values import money_round
from tillstream.schema import SINK_COLUMNS


def transactions_view(
    df: DataFrame, name: str | None = "transactions", watermark: str | None = None
) -> DataFrame:
    """The six columns offered to SQL, the date twice: as data and as event time.

    ``watermark`` (such as ``"5 seconds"``) bounds the state of event-time queries on a stream;
    such queries then leave out rows that arrive later than that.
    """
    view = df.select(
        "transaction_id",
        "customer_id",
        "customer_country",
        "total_amount",
        "transaction_date",
        F.col("transaction_date").alias("event_time"),
    )
    if watermark is not None:
        view = view.withWatermark("event_time", watermark)
    if name is not None:
        view.createOrReplaceTempView(name)
    return view


def with_total_amount(df: DataFrame, scale: int | None = 2) -> DataFrame:
    """total_amount = price x quantity, rounded to cents unless ``scale`` is None."""
    product = F.col("product_price") * F.col("product_quantity")
    if scale is None:
        amount = product
    elif scale == 2:
        amount = money_round(product)
    else:
        amount = F.round(product, scale)
    return df.withColumn("total_amount", amount)


def transaction_text(df: DataFrame) -> DataFrame:
    return df.withColumn("text", text.transaction_text())


def to_sink_columns(df: DataFrame, *extra: str) -> DataFrame:
    """The 12 columns of the relational table (without the country), then ``extra``."""
    return df.select(*SINK_COLUMNS, *extra)
