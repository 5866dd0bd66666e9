"""Texts shown to people: labels, dates, the short transaction form and the fraud alert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment method labels, category icons, product icons, status labels.
PAYMENT_LABELS = {
    "credit_card": "Thẻ tín dụng",
    "debit_card": "Thẻ ghi nợ",
    "online_transfer": "Chuyển khoản",
}
CATEGORY_ICONS = {
    "electronics": "⚡",
    "fashion": "👗",
    "home": "🏠",
    "grocery": "🛒",
    "beauty": "💅",
    "sports": "⚽",
}
PRODUCT_ICONS = {
    "Laptop": "💻",
    "Mobile": "📱",
    "Tablet": "📱",
    "Watch": "⌚",
    "Headphone": "🎧",
    "Speaker": "🔊",
    "Camera": "📷",
    "T-Shirt": "👕",
    "Jeans": "👖",
    "Sneakers": "👟",
    "Coffee": "☕",
    "Snacks Pack": "🍿",
    "Perfume": "💐",
    "Lipstick": "💄",
    "Face Cream": "🧴",
    "Yoga Mat": "🧘",
    "Dumbbells": "🏋️",
    "Running Shoes": "👟",
}
DEFAULT_ICON = "📦"
SUCCESS_LABEL = "Thành công"
FAILED_LABEL = "Thất bại"

# Fixed value: the alert as printed, one placeholder per argument.
ALERT_TEMPLATE = """
╔════════════════════════════════════════════════════════════════╗
║          🚨 CẢNH BÁO GIAO DỊCH KHẢ NGHI 🚨                     ║
╠════════════════════════════════════════════════════════════════╣
║ Customer ID: %-50s║
║                                                                ║
║ 📍 Giao dịch 1:                                                ║
║    Quốc gia: %-49s║
║    Thời gian: %-48s║
║    Sản phẩm: %-49s║
║    Số tiền: %-50.2f║
║                                                                ║
║ 📍 Giao dịch 2:                                                ║
║    Quốc gia: %-49s║
║    Thời gian: %-48s║
║    Sản phẩm: %-49s║
║    Số tiền: %-50.2f║
║                                                                ║
║ ⏱️  Khoảng cách thời gian: %d phút %d giây                     ║
╚════════════════════════════════════════════════════════════════╝
"""


def _lookup(labels: dict[str, str], key: Column | str, fallback: Column) -> Column:
    entries = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, _col(key)), fallback)


def payment_label(method: Column | str) -> Column:
    return _lookup(PAYMENT_LABELS, method, _col(method))


def category_icon(category: Column | str) -> Column:
    return _lookup(CATEGORY_ICONS, category, F.lit(DEFAULT_ICON))


def product_icon(name: Column | str) -> Column:
    return _lookup(PRODUCT_ICONS, name, F.lit(DEFAULT_ICON))


def status_label(ok: Column | str) -> Column:
    return F.when(_col(ok), SUCCESS_LABEL).otherwise(FAILED_LABEL)


def short_id(transaction_id: Column | str) -> Column:
    return F.concat(F.substring(_col(transaction_id), 1, 8), F.lit("..."))


def local_datetime(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "HH:mm:ss d/M/yyyy")


def timestamp_text(ts: Column | str) -> Column:
    """Milliseconds without trailing zeros, but never fewer than one fraction digit."""
    return F.regexp_replace(F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss.SSS"), "0{1,2}$", "")


def transaction_text() -> Column:
    def quoted(name: str) -> Column:
        return F.concat(F.lit("'"), F.coalesce(F.col(name), F.lit("null")), F.lit("'"))

    return F.concat(
        F.lit("Transaction{transactionId="), quoted("transaction_id"),
        F.lit(", productId="), quoted("product_id"),
        F.lit(", productName="), quoted("product_name"),
        F.lit(", totalAmount="), F.col("total_amount").cast("string"),
        F.lit("}"),
    )


def alert_text() -> Column:
    """The alert box for one row of ``fraud_alerts``."""
    return F.format_string(
        ALERT_TEMPLATE,
        F.col("customer_id"),
        F.col("previous_country"),
        timestamp_text("previous_date"),
        F.col("previous_product"),
        F.col("previous_amount"),
        F.col("country"),
        timestamp_text("date"),
        F.col("product"),
        F.col("amount"),
        F.col("minutes"),
        F.col("seconds"),
    )


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
