"""Row-wise forms, lookups, dimensions and headline figures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillstream.functions import text
from tillstream.operators.enrich import enrich_country, enrich_product, with_labels
from tillstream.operators.kpi import kpi_summary, recent_log, recent_transactions
from tillstream.operators.latest import latest_per_key
from tillstream.operators.project import (
    to_sink_columns,
    transaction_text,
    transactions_view,
    with_total_amount,
)
from tillstream.schema import SINK_COLUMNS
from tillstream.sources import dims


def test_dimensions(spark):
    products = dims.products(spark)
    assert products.count() == 32
    assert products.schema["price_range"].dataType.simpleString() == "array<int>"
    [jeans] = products.where("product_id = 'product23'").collect()
    assert (jeans.product_brand, jeans.price_range) == ("Levi's", [50, 150])
    assert dims.countries(spark).count() == 8
    pairs = dims.customer_countries(spark)
    assert pairs.count() == 40
    assert pairs.select("customer_id").distinct().count() == 33
    assert pairs.where("customer_id = 'john_smith'").count() == 8


def test_lookups_add_and_keep(transactions):
    rows = [
        {"product_id": "product5", "product_name": "something else", "customer_country": "Japan"},
        {"product_id": "unknown", "customer_country": None},
    ]
    found = enrich_country(enrich_product(transactions(rows))).orderBy("seq").collect()
    assert [r.product_name for r in found] == ["something else", "Laptop"]
    assert [r.catalog_name for r in found] == ["Mobile", None]
    assert [(r.catalog_low, r.catalog_high) for r in found] == [(400, 800), (None, None)]
    assert [(r.flag, r.location) for r in found] == [("🇯🇵", "Japan"), (None, None)]


def test_lookup_with_own_dimension(spark, transactions):
    dim = spark.createDataFrame([("USA", "x", "y")], "customer_country string, flag string, location string")
    [row] = enrich_country(transactions([{}]), dim).collect()
    assert (row.flag, row.location) == ("x", "y")


def test_labels(transactions):
    rows = [
        {"payment_method": "debit_card", "product_category": "home", "product_name": "Yoga Mat"},
        {"payment_method": "cash", "product_category": "x", "product_name": "y"},
        {"payment_method": None, "product_category": None, "product_name": None},
    ]
    found = with_labels(transactions(rows)).orderBy("seq").collect()
    labels = [(r.payment_label, r.category_icon, r.product_icon) for r in found]
    assert labels == [("Thẻ ghi nợ", "🏠", "🧘"), ("cash", "📦", "📦"), (None, "📦", "📦")]


def test_timestamp_text(spark):
    times = ["2025-01-01 00:00:00", "2025-01-01 10:20:30.1", "2025-01-01 10:20:30.12", "2025-01-01 10:20:30.123"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(
        text.timestamp_text(F.col("t").cast("timestamp")).alias("text")
    )
    assert [r.text for r in df.collect()] == ["2025-01-01 00:00:00.0", *times[1:]]


def test_transaction_text(transactions):
    rows = [{"transaction_id": "t", "product_name": None, "total_amount": 12345678.9}]
    [row] = transaction_text(transactions(rows)).collect()
    assert row.text == (
        "Transaction{transactionId='t', productId='product1', productName='null', "
        "totalAmount=1.23456789E7}"
    )


def test_amount(transactions):
    df = transactions([{"product_price": 9.99, "product_quantity": 3}])
    assert with_total_amount(df).first().total_amount == 29.97
    assert with_total_amount(df, None).first().total_amount == 9.99 * 3
    assert with_total_amount(df, 1).first().total_amount == 30.0


def test_view(spark, transactions):
    transactions_view(transactions([{}]), "some_transactions")
    columns = spark.sql("SELECT * FROM some_transactions").columns
    assert columns == [
        "transaction_id", "customer_id", "customer_country", "total_amount", "transaction_date",
        "event_time",
    ]


def test_sink_columns(transactions):
    assert to_sink_columns(transactions([{}]), "seq").columns == [*SINK_COLUMNS, "seq"]
    assert "customer_country" not in SINK_COLUMNS and len(SINK_COLUMNS) == 12


def test_latest(transactions):
    rows = [
        {"transaction_id": "a", "total_amount": 1.0, "seq": 3},
        {"transaction_id": "a", "total_amount": 2.0, "seq": 5},
        {"transaction_id": "a", "total_amount": None, "seq": 7},
        {"transaction_id": "b", "total_amount": 4.0, "seq": 1},
    ]
    df = transactions(rows)
    latest = latest_per_key(df, "transaction_id")
    assert latest.columns == df.columns
    assert {r.transaction_id: r.total_amount for r in latest.collect()} == {"a": None, "b": 4.0}


def test_kpi(transactions):
    rows = [{"total_amount": 0.1}, {"total_amount": 0.2}, {"total_amount": 5.0}]
    df = transactions(rows).withColumn("ok", F.when(F.col("seq") < 2, True))
    assert kpi_summary(df).first().asDict() == {
        "total_transactions": 3, "success_transactions": 2, "failed_transactions": 1,
        "total_revenue": 0.3,
    }
    assert kpi_summary(df.limit(0)).first().total_revenue == 0.0


def test_recent(transactions):
    rows = [{"transaction_id": f"transaction{i}", "transaction_date": dt.datetime(2025, 3, 4, 5, 6, 7)}
            for i in range(30)]
    recent = recent_transactions(transactions(rows))
    log = recent_log(recent, F.col("seq") % 2 == 0).collect()
    assert [r.seq for r in log] == list(range(29, 9, -1))
    assert (log[0].short_id, log[0].status, log[1].status) == ("transact...", "Thất bại", "Thành công")
    assert (log[0].local_date, log[0].product) == ("05:06:07 4/3/2025", "Laptop (Apple)")
