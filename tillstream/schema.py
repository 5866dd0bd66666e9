"""The transaction relation: wire names, column names, types, and the keyed result tables."""

from __future__ import annotations

from typing import NamedTuple


class Field(NamedTuple):
    wire: str
    column: str
    type: str


# The message's property names in declaration order, with our column names and types.
FIELDS = (
    Field("transactionId", "transaction_id", "string"),
    Field("productId", "product_id", "string"),
    Field("productName", "product_name", "string"),
    Field("productCategory", "product_category", "string"),
    Field("productPrice", "product_price", "double"),
    Field("productQuantity", "product_quantity", "int"),
    Field("productBrand", "product_brand", "string"),
    Field("totalAmount", "total_amount", "double"),
    Field("currency", "currency", "string"),
    Field("customerId", "customer_id", "string"),
    Field("transactionDate", "transaction_date", "timestamp"),
    Field("paymentMethod", "payment_method", "string"),
    Field("customerCountry", "customer_country", "string"),
)

COLUMNS = tuple(f.column for f in FIELDS)

# The relational table leaves the country out.
SINK_COLUMNS = tuple(c for c in COLUMNS if c != "customer_country")

# The names of the topic and the document index.
TOPIC = "financial_transactions"
DOCUMENT_INDEX = "transactions"


class TableDef(NamedTuple):
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]


_SQL_TYPES = {
    "string": "VARCHAR(255)",
    "double": "DOUBLE PRECISION",
    "int": "INTEGER",
    "timestamp": "TIMESTAMP",
}

# Names, columns and primary keys of the four result tables.
TABLES = {
    "transactions": TableDef(
        tuple((f.column, _SQL_TYPES[f.type]) for f in FIELDS if f.column in SINK_COLUMNS),
        ("transaction_id",),
    ),
    "sales_per_category": TableDef(
        (
            ("transaction_date", "DATE"),
            ("category", "VARCHAR(255)"),
            ("total_sales", "DOUBLE PRECISION"),
        ),
        ("transaction_date", "category"),
    ),
    "sales_per_day": TableDef(
        (("transaction_date", "DATE"), ("total_sales", "DOUBLE PRECISION")),
        ("transaction_date",),
    ),
    "sales_per_month": TableDef(
        (("year", "INTEGER"), ("month", "INTEGER"), ("total_sales", "DOUBLE PRECISION")),
        ("year", "month"),
    ),
}
