"""Lookups that add columns to a transaction and never replace its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions import text
from tillstream.sources import dims


def enrich_product(df: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Add the catalogue's view of the product as ``catalog_*`` columns.

    The built-in 32 rows are broadcast; a dimension passed in is left to Spark's own size check.
    """
    dim = F.broadcast(dims.products(df.sparkSession)) if products is None else products
    renamed = dim.select(
        "product_id",
        F.col("product_name").alias("catalog_name"),
        F.col("product_category").alias("catalog_category"),
        F.col("product_brand").alias("catalog_brand"),
        F.element_at("price_range", 1).alias("catalog_low"),
        F.element_at("price_range", 2).alias("catalog_high"),
        F.col("currency").alias("catalog_currency"),
        F.col("payment_method").alias("catalog_payment"),
    )
    added = [c for c in renamed.columns if c != "product_id"]
    return df.join(renamed, "product_id", "left").select(*df.columns, *added)


def enrich_country(df: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Add flag and location of the customer's country (the built-in 8 rows are broadcast)."""
    dim = F.broadcast(dims.countries(df.sparkSession)) if countries is None else countries
    found = dim.select("customer_country", "flag", "location")
    return df.join(found, "customer_country", "left").select(*df.columns, "flag", "location")


def with_labels(df: DataFrame) -> DataFrame:
    """Add the payment label and the category and product icons."""
    return df.withColumns(
        {
            "payment_label": text.payment_label("payment_method"),
            "category_icon": text.category_icon("product_category"),
            "product_icon": text.product_icon("product_name"),
        }
    )
