"""Headline figures and the list of most recent transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions import text
from tillstream.functions.values import money_sum


def kpi_summary(df: DataFrame, ok: Column | str = "ok") -> DataFrame:
    """One row: how many transactions, successes and failures, and the successes' revenue."""
    ok = F.coalesce(F.col(ok) if isinstance(ok, str) else ok, F.lit(False))
    revenue = money_sum(F.when(ok, F.col("total_amount")))
    return df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(ok).alias("success_transactions"),
        F.count_if(~ok).alias("failed_transactions"),
        F.coalesce(revenue, F.lit(0.0)).alias("total_revenue"),
    )


def recent_transactions(df: DataFrame, n: int = 20, seq: str | Sequence[str] = "seq") -> DataFrame:
    """The ``n`` newest rows by arrival, newest first: each task keeps its own newest ``n``."""
    names = [seq] if isinstance(seq, str) else list(seq)
    return df.orderBy(*[F.desc(name) for name in names]).limit(n)


def recent_log(recent: DataFrame, ok: Column | str = "ok") -> DataFrame:
    """The recent list as displayed: shortened id, status, local date and labels."""
    return recent.withColumns(
        {
            "short_id": text.short_id("transaction_id"),
            "status": text.status_label(ok),
            "local_date": text.local_datetime("transaction_date"),
            "product": F.concat_ws("", "product_name", F.lit(" ("), "product_brand", F.lit(")")),
            "category_icon": text.category_icon("product_category"),
            "payment_label": text.payment_label("payment_method"),
        }
    )
