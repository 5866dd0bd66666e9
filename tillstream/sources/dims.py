"""The shop's two inline dimensions: 32 products, and 8 countries with five customers each."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# product1 to product32 in order, as
# (name, category, brand, lowest price, highest price, currency, payment method).
PRODUCTS = (
    ("Laptop", "electronics", "Apple", 800, 1000, "USD", "credit_card"),
    ("Laptop", "electronics", "Samsung", 600, 900, "USD", "debit_card"),
    ("Laptop", "electronics", "Sony", 700, 950, "GBP", "online_transfer"),
    ("Mobile", "electronics", "Apple", 700, 1000, "USD", "credit_card"),
    ("Mobile", "electronics", "Samsung", 400, 800, "GBP", "debit_card"),
    ("Mobile", "electronics", "OnePlus", 300, 600, "USD", "online_transfer"),
    ("Mobile", "electronics", "Mi", 200, 500, "USD", "debit_card"),
    ("Tablet", "electronics", "Apple", 500, 900, "USD", "credit_card"),
    ("Tablet", "electronics", "Samsung", 300, 700, "GBP", "online_transfer"),
    ("Tablet", "electronics", "Mi", 250, 500, "USD", "debit_card"),
    ("Watch", "fashion", "Apple", 400, 800, "USD", "credit_card"),
    ("Watch", "fashion", "Samsung", 200, 600, "GBP", "debit_card"),
    ("Watch", "fashion", "Mi", 100, 400, "USD", "online_transfer"),
    ("Headphone", "electronics", "Apple", 200, 500, "USD", "credit_card"),
    ("Headphone", "electronics", "Sony", 150, 450, "GBP", "debit_card"),
    ("Headphone", "electronics", "Boat", 50, 300, "USD", "online_transfer"),
    ("Speaker", "home", "Samsung", 150, 600, "USD", "credit_card"),
    ("Speaker", "home", "Sony", 120, 550, "GBP", "debit_card"),
    ("Speaker", "home", "Boat", 80, 400, "USD", "online_transfer"),
    ("Camera", "electronics", "Sony", 500, 1200, "USD", "credit_card"),
    ("Camera", "electronics", "Samsung", 400, 1000, "GBP", "debit_card"),
    ("T-Shirt", "fashion", "Nike", 20, 80, "USD", "credit_card"),
    ("Jeans", "fashion", "Levi's", 50, 150, "USD", "debit_card"),
    ("Sneakers", "fashion", "Adidas", 60, 200, "GBP", "online_transfer"),
    ("Coffee", "grocery", "Starbucks", 10, 50, "USD", "debit_card"),
    ("Snacks Pack", "grocery", "Lay's", 5, 30, "USD", "online_transfer"),
    ("Perfume", "beauty", "Dior", 80, 300, "GBP", "credit_card"),
    ("Lipstick", "beauty", "MAC", 20, 60, "USD", "debit_card"),
    ("Face Cream", "beauty", "L'Oreal", 15, 80, "USD", "online_transfer"),
    ("Yoga Mat", "sports", "Nike", 20, 80, "USD", "debit_card"),
    ("Dumbbells", "sports", "Adidas", 30, 150, "GBP", "credit_card"),
    ("Running Shoes", "sports", "Puma", 50, 180, "USD", "online_transfer"),
)

# Country -> (customers, flag, location).
COUNTRIES = {
    "USA": (
        ["john_smith", "sarah_johnson", "michael_brown", "emily_davis", "david_wilson"],
        "🇺🇸", "United States",
    ),
    "UK": (
        ["john_smith", "olivia_anderson", "william_thomas", "sophie_jackson", "harry_white"],
        "🇬🇧", "United Kingdom",
    ),
    "Vietnam": (
        ["john_smith", "tran_thi_b", "le_van_c", "pham_thi_d", "hoang_van_e"],
        "🇻🇳", "Vietnam",
    ),
    "Japan": (
        ["john_smith", "sato_akira", "suzuki_hana", "yamamoto_kenji", "watanabe_mei"],
        "🇯🇵", "Japan",
    ),
    "Germany": (
        ["john_smith", "schmidt_anna", "weber_klaus", "wagner_lisa", "becker_tom"],
        "🇩🇪", "Germany",
    ),
    "France": (
        ["john_smith", "martin_marie", "bernard_jean", "petit_sophie", "robert_luc"],
        "🇫🇷", "France",
    ),
    "Australia": (
        ["john_smith", "brown_emma", "wilson_oliver", "taylor_mia", "anderson_noah"],
        "🇦🇺", "Australia",
    ),
    "Canada": (
        ["john_smith", "gagnon_marie", "tremblay_luc", "cote_emma", "bouchard_alex"],
        "🇨🇦", "Canada",
    ),
}

_PRODUCT_SCHEMA = pa.schema(
    {
        "product_id": pa.string(),
        "product_name": pa.string(),
        "product_category": pa.string(),
        "product_brand": pa.string(),
        "price_range": pa.list_(pa.int32()),
        "currency": pa.string(),
        "payment_method": pa.string(),
    }
)
_COUNTRY = pa.struct(
    {"customers": pa.list_(pa.string()), "flag": pa.string(), "location": pa.string()}
)
_COUNTRY_MAP_SCHEMA = pa.schema({"by_country": pa.map_(pa.string(), _COUNTRY)})


def products(spark: SparkSession) -> DataFrame:
    """The 32 products, price range kept as an array of two."""
    rows = [
        (f"product{i}", name, category, brand, [low, high], currency, payment)
        for i, (name, category, brand, low, high, currency, payment) in enumerate(PRODUCTS, 1)
    ]
    columns = [list(column) for column in zip(*rows)]
    return spark.createDataFrame(pa.table(columns, schema=_PRODUCT_SCHEMA))


def country_map(spark: SparkSession) -> DataFrame:
    """One row, one map column: country to its customers, flag and location."""
    entries = [
        (country, {"customers": customers, "flag": flag, "location": location})
        for country, (customers, flag, location) in COUNTRIES.items()
    ]
    return spark.createDataFrame(pa.table([[entries]], schema=_COUNTRY_MAP_SCHEMA))


def countries(spark: SparkSession) -> DataFrame:
    """(customer_country, flag, location), 8 rows."""
    exploded = country_map(spark).select(F.explode("by_country").alias("customer_country", "info"))
    return exploded.select("customer_country", "info.flag", "info.location")


def customer_countries(spark: SparkSession) -> DataFrame:
    """(customer_id, customer_country, slot), 40 rows: the nested map flattened twice.

    ``slot`` is the customer's place in the country's list, from 0.
    """
    exploded = country_map(spark).select(F.explode("by_country").alias("customer_country", "info"))
    return exploded.select(
        "customer_country", F.posexplode("info.customers").alias("slot", "customer_id")
    ).select("customer_id", "customer_country", "slot")
