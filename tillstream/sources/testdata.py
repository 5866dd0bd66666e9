"""The test tables seen as transactions.

Every mapping works on a batch or a stream of its fact table and yields the 13 transaction
columns, ordering columns and ``ingest_ts``, the time of arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.values import cut_to_millis
from tillstream.operators.computed import with_computed
from tillstream.schema import COLUMNS, FIELDS
from tillstream.sources import dims

LINE_SEQ = ("seq_date", "seq_part", "seq_supplier")
# What line_transactions takes of lineitem.
LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
)
PERTURBED_SEQ = ("seq", "seq_tie")
# Number of message variants; those not named in raw_messages are ordinary messages.
VARIANTS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ordered(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(*COLUMNS, *extra, "ingest_ts")


def _event_sales(events: DataFrame) -> DataFrame:
    """Everything about an event's purchase but the customer and the country."""
    number = (F.col("event_id") % 32 + 1).cast("string")
    products = dims.products(events.sparkSession).drop("price_range")
    sales = events.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.concat(F.lit("product"), number).alias("product_id"),
        F.col("value").alias("product_price"),
        (F.col("event_id") % 10 + 1).cast("int").alias("product_quantity"),
        (F.col("value").cast("decimal(18,2)") * (F.col("event_id") % 10 + 1).cast("int"))
        .cast("double").alias("total_amount"),
        cut_to_millis(F.col("ts").cast("timestamp")).alias("transaction_date"),
        F.get_json_object("props", "$.k").cast("int").alias("_k"),
        F.col("user_id").alias("_user"),
        F.col("event_id").alias("seq"),
    ).withColumn("ingest_ts", F.col("transaction_date"))
    return sales.join(F.broadcast(products), "product_id")


def event_transactions(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Fixture E: the country comes from the event's properties (always 25 nations)."""
    nations = nation.select(F.col("n_nationkey").alias("_nation"), F.col("n_name"))
    sales = _event_sales(events)
    joined = sales.join(nations, F.col("_k") % 25 == F.col("_nation"))
    return _ordered(
        joined.withColumn("customer_id", F.col("_user").cast("string")).withColumnRenamed(
            "n_name", "customer_country"
        ),
        "seq",
    )


def web_transactions(events: DataFrame) -> DataFrame:
    """Fixture W: customers and countries of the shop; one customer is known in every country."""
    names = F.array(*[F.lit(name) for name in dims.COUNTRIES])
    pairs = F.broadcast(dims.customer_countries(events.sparkSession))
    sales = _event_sales(events).withColumns(
        {
            "customer_country": F.element_at(names, (F.col("_user") % 8 + 1).cast("int")),
            "slot": (F.floor(F.col("_user") / 8) % 5).cast("int"),
        }
    )
    return _ordered(sales.join(pairs, ["customer_country", "slot"]), "seq")


def perturbed(transactions: DataFrame) -> DataFrame:
    """Another arrival order for fixture E: up to 400 places late."""
    late = F.col("seq") + (F.col("seq") * 7919) % 401
    return transactions.withColumns({"seq_tie": F.col("seq"), "seq": late})


def order_transactions(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Fixture O: market segments as categories; arrival follows the order date."""
    nations = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    buyers = customer.select("c_custkey", "c_nationkey", "c_mktsegment").join(
        nations, "c_nationkey"
    )
    date = F.col("o_orderdate").cast("timestamp")
    return orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").alias("total_amount"),
        date.alias("transaction_date"),
        F.col("c_mktsegment").alias("product_category"),
        F.col("n_name").alias("customer_country"),
        F.col("o_orderpriority").alias("payment_method"),
        F.struct("o_orderdate", "o_orderkey").alias("seq"),
        date.alias("ingest_ts"),
    )


def line_transactions(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Fixture L: several writes per transaction id, ordered by LINE_SEQ."""
    date = F.col("l_shipdate").cast("timestamp")
    joined = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("transaction_id"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("p_retailprice").alias("product_price"),
        F.col("l_quantity").cast("int").alias("product_quantity"),
        F.col("p_brand").alias("product_brand"),
        F.col("l_extendedprice").alias("total_amount"),
        F.lit("USD").alias("currency"),
        F.col("l_suppkey").cast("string").alias("customer_id"),
        date.alias("transaction_date"),
        F.lit("credit_card").alias("payment_method"),
        F.col("l_shipdate").alias("seq_date"),
        F.col("l_partkey").alias("seq_part"),
        F.col("l_suppkey").alias("seq_supplier"),
    )


def raw_messages(transactions: DataFrame) -> DataFrame:
    """Fixture R: (value, seq), every transaction as JSON text in one of 32 spellings.

    The spelling follows from the sequence number; most spellings are ordinary, the others are
    the accepted oddities and the faults listed below.
    """
    variant = F.col("seq") % VARIANTS
    ts = F.col("transaction_date")

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    def iso(time: Column, end: str, pattern: str = "yyyy-MM-dd'T'HH:mm:ss.SSS") -> Column:
        return quoted(F.concat(F.date_format(time, pattern), F.lit(end)))

    def choose(cases: dict[int, Column], ordinary: Column) -> Column:
        chosen = ordinary
        for number, text in cases.items():
            chosen = F.when(variant == number, text).otherwise(chosen)
        return chosen

    null = F.lit("null")
    epoch = F.unix_millis(ts).cast("string")
    quantity = F.col("product_quantity").cast("string")
    price = F.col("product_price").cast("string")
    missing = F.lit(None).cast("string")

    values = {f.wire: quoted(F.col(f.column)) for f in FIELDS if f.type == "string"}
    values["transactionId"] = choose({14: missing, 18: missing}, values["transactionId"])
    values["productCategory"] = choose({13: null}, values["productCategory"])
    values["customerId"] = choose({12: null}, values["customerId"])
    values["customerCountry"] = choose({24: missing}, values["customerCountry"])
    values["productPrice"] = choose({3: quoted(price), 4: missing}, price)
    values["productQuantity"] = choose(
        {
            2: quoted(quantity),
            3: F.concat(quantity, F.lit(".7")),
            4: null,
            16: F.lit('"abc"'),
        },
        quantity,
    )
    amount = F.col("total_amount").cast("string")
    values["totalAmount"] = choose({23: F.lit('"NaN"')}, amount)
    values["transactionDate"] = choose(
        {
            1: iso(ts, "987+0000"),
            2: epoch,
            9: iso(ts + F.expr("INTERVAL 7 HOURS"), "+07:00"),
            10: F.lit('""'),
            17: F.lit('"yesterday"'),
            20: quoted(epoch),
            21: iso(ts, ""),
            22: iso(ts, "Z", "yyyy-MM-dd'T'HH:mm"),
        },
        iso(ts, "Z"),
    )
    extra = choose(
        {
            8: F.lit('"zzz":1'),
            15: F.lit('"customerCountry":"Nowhere"'),
            18: F.concat(F.lit('"TransactionID":'), quoted(F.col("transaction_id"))),
        },
        missing,
    )
    # concat is null, and thus left out by concat_ws, where the value is missing.
    properties = [F.concat(F.lit(f'"{f.wire}":'), values[f.wire]) for f in FIELDS]
    body = F.concat(F.lit("{"), F.concat_ws(",", extra, *properties), F.lit("}")).alias("body")
    transactions = with_computed(transactions, body)
    body = F.col("body")
    value = choose(
        {
            5: null,
            6: F.substring(body, 1, 40),
            7: F.lit("[]"),
            11: F.concat(body, F.lit(" and more")),
        },
        body,
    )
    return with_computed(transactions, value.alias("value")).select("value", "seq")
