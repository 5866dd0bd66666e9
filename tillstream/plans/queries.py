"""Named queries over the test tables: (spark, folder) -> DataFrame.

Timestamps leave as TIMESTAMP_NTZ in UTC, so results compare without a session time zone.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tillstream.functions.text import status_label
from tillstream.functions.values import money_sum
from tillstream.operators.enrich import enrich_country, enrich_product, with_labels
from tillstream.operators.fraud import alert_text, fraud_alerts
from tillstream.operators.kpi import kpi_summary, recent_log, recent_transactions
from tillstream.operators.latest import latest_per_key
from tillstream.operators.parse import accepted, classify_messages, parse_transactions, without_null_literals
from tillstream.operators.project import (
    to_sink_columns,
    transaction_text,
    transactions_view,
    with_total_amount,
)
from tillstream.operators.sales import (
    running_totals,
    sales_per_category,
    sales_per_day,
    sales_per_month,
)
from tillstream.schema import COLUMNS
from tillstream.session import configure, scratch_folder
from tillstream.sinks.documents import file_transport, send_bulk, to_bulk_lines, to_documents, to_messages
from tillstream.sinks.tables import ConnectionTables, FolderTables, file_connections
from tillstream.sources import testdata
from tillstream.sources.messages import file_source, spread
from tillstream.sources.testdata import LINE_SEQ, PERTURBED_SEQ, table
from tillstream.streaming.fraud import start_fraud_alerts
from tillstream.streaming.headline import read_newest, start_kpi, start_recent
from tillstream.streaming.pipeline import (
    INGEST,
    folder_alerts,
    folder_targets,
    start_parse,
    start_pipeline,
    start_raw,
    start_sales,
    text_alerts,
)
from tillstream.streaming.progress import ProgressStore, read_progress
from tillstream.streaming.run import AVAILABLE_NOW, make_folder, run
from tillstream.streaming.running import start_running_totals

Query = Callable[[SparkSession, str], DataFrame]

# More pieces than the test tables have large customers and categories.
MANY_RANGES = 40


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.event_transactions(
        table(spark, sf_dir, "events"), table(spark, sf_dir, "nation")
    )


def _web(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.web_transactions(table(spark, sf_dir, "events"))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.order_transactions(
        *(table(spark, sf_dir, name) for name in ("orders", "customer", "nation"))
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.line_transactions(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(table(spark, sf_dir, "events"))
    return testdata.raw_messages(testdata.event_transactions(events, table(spark, sf_dir, "nation")))


# A stream query reads its table in this many parts, each a micro-batch of a restarted query.
PARTS = 3
# Rows in a file of events: a file is one task, and a part of a sorted table comes from few of the scan's tasks.
FILE_ROWS = 20_000


def _in_parts(
    rows: DataFrame, order: Column, folder: str, start: Callable[[DataFrame], object], file_rows: int = 0
) -> None:
    """Stream the table in parts along ``order``: store a part, run the query on what is new, and so on.

    ``file_rows`` bounds the rows of a file (0: no bound), for rows that cost much more to work on than to store.
    """
    shares = [i / PARTS for i in range(1, PARTS)]
    cuts = rows.agg(F.percentile_approx(order, shares, 1000)).first()[0] or []
    bounds = [None, *sorted(set(cuts)), None]
    source = f"{folder}/source"
    for low, high in zip(bounds, bounds[1:]):
        above = F.lit(True) if low is None else order > low
        # A row without a position belongs to the first part.
        upto = F.lit(True) if high is None else F.coalesce(order <= high, F.lit(low is None))
        rows.where(above & upto).write.mode("append").option("maxRecordsPerFile", file_rows).parquet(source)
        start(file_source(rows.sparkSession, source, rows.schema))


def _event_parts(
    spark: SparkSession, sf_dir: str, folder: str, start: Callable[[DataFrame], object]
) -> None:
    nation = table(spark, sf_dir, "nation")
    _in_parts(
        table(spark, sf_dir, "events"), F.col("event_id"), folder,
        lambda events: start(testdata.event_transactions(events, nation)), FILE_ROWS,
    )


def _order_parts(
    spark: SparkSession, sf_dir: str, folder: str, start: Callable[[DataFrame], object]
) -> None:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    _in_parts(
        table(spark, sf_dir, "orders"), F.unix_micros(F.col("o_orderdate").cast("timestamp")), folder,
        lambda orders: start(testdata.order_transactions(orders, customer, nation)),
    )


def _line_parts(
    spark: SparkSession, sf_dir: str, folder: str, start: Callable[[DataFrame], object]
) -> None:
    part = table(spark, sf_dir, "part")
    lines = table(spark, sf_dir, "lineitem").select(*testdata.LINE_COLUMNS)
    _in_parts(
        lines, F.unix_micros(F.col("l_shipdate").cast("timestamp")), folder,
        lambda lines: start(testdata.line_transactions(lines, part)),
    )


def _message_parts(
    spark: SparkSession, sf_dir: str, folder: str, start: Callable[[DataFrame], object]
) -> None:
    _event_parts(spark, sf_dir, folder, lambda rows: start(testdata.raw_messages(rows)))


def _plain(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


# Sales


def q_sales_per_day(spark, sf_dir):
    return sales_per_day(_events(spark, sf_dir))


def q_sales_per_day_as_written(spark, sf_dir):
    return sales_per_day(_events(spark, sf_dir), "as_written")


def q_sales_per_category(spark, sf_dir):
    return sales_per_category(_orders(spark, sf_dir))


def q_sales_per_category_as_written(spark, sf_dir):
    return sales_per_category(_orders(spark, sf_dir), "as_written")


def q_sales_per_month(spark, sf_dir):
    return sales_per_month(_orders(spark, sf_dir))


def q_sales_per_month_as_written(spark, sf_dir):
    return sales_per_month(_orders(spark, sf_dir), "as_written")


def _running(rows: DataFrame, key: str, **options) -> DataFrame:
    return running_totals(rows, key, **options).select("transaction_id", key, "running_total")


def q_running_category_totals(spark, sf_dir):
    return _running(_events(spark, sf_dir), "product_category")


def q_running_category_totals_cut(spark, sf_dir):
    return _running(_events(spark, sf_dir), "product_category", ranges=MANY_RANGES)


def q_running_day_totals(spark, sf_dir):
    days = _events(spark, sf_dir).withColumn("day", F.to_date("transaction_date"))
    return _running(days, "day")


def q_running_month_totals(spark, sf_dir):
    months = _events(spark, sf_dir).withColumn("month", F.month("transaction_date"))
    return _running(months, "month", ranges=MANY_RANGES)


# Fraud


def q_fraud_alerts(spark, sf_dir):
    return _plain(fraud_alerts(_events(spark, sf_dir)))


def q_fraud_alerts_out_of_order(spark, sf_dir):
    return _plain(fraud_alerts(testdata.perturbed(_events(spark, sf_dir)), PERTURBED_SEQ))


def q_fraud_alerts_shared_customer(spark, sf_dir):
    return _plain(fraud_alerts(_web(spark, sf_dir), ranges=MANY_RANGES))


def q_fraud_alert_text(spark, sf_dir):
    return alert_text(fraud_alerts(_events(spark, sf_dir))).select("seq", "alert")


# Row-wise forms and lookups


def q_transactions_view(spark, sf_dir):
    transactions_view(_events(spark, sf_dir), "transactions", watermark="5 seconds")
    return _plain(spark.sql("SELECT * FROM transactions"))


def q_derived_amount(spark, sf_dir):
    rows = _events(spark, sf_dir)
    unrounded = with_total_amount(rows, None).withColumnRenamed("total_amount", "raw_amount")
    return with_total_amount(unrounded).select("transaction_id", "raw_amount", "total_amount")


def q_sink_columns(spark, sf_dir):
    return _plain(to_sink_columns(_events(spark, sf_dir)))


def q_transaction_text(spark, sf_dir):
    return transaction_text(_events(spark, sf_dir)).select("transaction_id", "text")


def q_enrich_product(spark, sf_dir):
    added = [f"catalog_{x}" for x in ("name", "category", "brand", "low", "high", "currency", "payment")]
    return enrich_product(_events(spark, sf_dir)).select("transaction_id", "product_name", *added)


def q_enrich_country(spark, sf_dir):
    found = enrich_country(_web(spark, sf_dir))
    return found.select("transaction_id", "customer_country", "flag", "location")


def q_customer_countries(spark, sf_dir):
    return _web(spark, sf_dir).select("transaction_id", "customer_id", "customer_country")


def q_display_labels(spark, sf_dir):
    return with_labels(_events(spark, sf_dir)).select(
        "transaction_id", "payment_label", "category_icon", "product_icon"
    )


# Messages, documents, headline figures


def q_parse_transactions(spark, sf_dir):
    good, _ = parse_transactions(_messages(spark, sf_dir))
    return _plain(good.select(*COLUMNS, "seq"))


def q_rejected_transactions(spark, sf_dir):
    _, rejects = parse_transactions(_messages(spark, sf_dir))
    return rejects.select("seq", "reason")


def q_transaction_documents(spark, sf_dir):
    return to_documents(_events(spark, sf_dir))


def q_bulk_lines(spark, sf_dir):
    return to_bulk_lines(to_documents(_events(spark, sf_dir)))


def q_keyed_messages(spark, sf_dir):
    return to_messages(_events(spark, sf_dir))


def q_kpi_summary(spark, sf_dir):
    classified = classify_messages(_messages(spark, sf_dir))
    return kpi_summary(classified, F.col("reason").isNull())


def q_message_status(spark, sf_dir):
    classified = classify_messages(_messages(spark, sf_dir))
    return classified.select("seq", status_label(F.col("reason").isNull()).alias("status"))


_RECENT = (
    "seq", "short_id", "status", "local_date", "product", "category_icon", "customer_id",
    "customer_country", "product_quantity", "product_price", "payment_label", "total_amount",
)


def q_recent_transactions(spark, sf_dir):
    """Accepted and failed messages; only those on the list are parsed."""
    newest = classify_messages(recent_transactions(without_null_literals(_messages(spark, sf_dir))))
    return recent_log(newest, F.col("reason").isNull()).select(*_RECENT)


# Keyed tables


def q_latest_transactions(spark, sf_dir):
    return _plain(to_sink_columns(latest_per_key(_lines(spark, sf_dir), "transaction_id", LINE_SEQ)))


# Streams: part after part through a restarted streaming query, then a look at the result


def _streamed_sales(spark, sf_dir, parts, name, **options):
    folder = scratch_folder(spark, f"stream_{name}")
    tables = FolderTables(f"{folder}/tables")
    parts(
        spark, sf_dir, folder,
        lambda rows: start_sales(rows, name, tables, f"{folder}/checkpoint", AVAILABLE_NOW, **options),
    )
    return tables.read(spark, name)


def q_stream_sales_per_day(spark, sf_dir):
    return _streamed_sales(spark, sf_dir, _event_parts, "sales_per_day")


def q_stream_sales_per_day_as_written(spark, sf_dir):
    return _streamed_sales(spark, sf_dir, _event_parts, "sales_per_day", mode="as_written")


def q_stream_sales_per_category(spark, sf_dir):
    return _streamed_sales(spark, sf_dir, _order_parts, "sales_per_category")


def q_stream_sales_per_category_as_written(spark, sf_dir):
    return _streamed_sales(spark, sf_dir, _order_parts, "sales_per_category", mode="as_written")


def q_stream_sales_per_month(spark, sf_dir):
    return _streamed_sales(spark, sf_dir, _order_parts, "sales_per_month")


def q_stream_sales_per_month_as_written(spark, sf_dir):
    return _streamed_sales(spark, sf_dir, _order_parts, "sales_per_month", mode="as_written")


# Longer than the events span, so that nothing is too late.
REPLAYS = "5000 days"


def _across_event_time(
    spark: SparkSession, sf_dir: str, folder: str, start: Callable[[DataFrame], object]
) -> None:
    """Parts that each span all dates, so the later ones are late; the last one repeats the rows of the first."""
    nation, events = table(spark, sf_dir, "nation"), table(spark, sf_dir, "events")
    part, source = F.pmod(F.col("event_id"), F.lit(PARTS)), f"{folder}/source"
    for number in range(PARTS):
        wanted = part == number
        if number == PARTS - 1:
            wanted = wanted | (part == 0)
        rows = events.where(F.coalesce(wanted, F.lit(number == 0)))
        rows.write.mode("append").option("maxRecordsPerFile", FILE_ROWS).parquet(source)
        start(testdata.event_transactions(file_source(spark, source, events.schema), nation))


def q_stream_sales_per_day_late(spark, sf_dir):
    """Late rows and rows that come again."""
    return _streamed_sales(spark, sf_dir, _across_event_time, "sales_per_day", replays=REPLAYS)


def q_stream_sales_per_month_late(spark, sf_dir):
    return _streamed_sales(spark, sf_dir, _across_event_time, "sales_per_month", replays=REPLAYS)


def _streamed_running(spark, sf_dir, key, parts):
    folder = scratch_folder(spark, "stream_running")
    out = f"{folder}/out"

    def store(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    parts(
        spark, sf_dir, folder,
        lambda rows: start_running_totals(rows, store, f"{folder}/work", key, trigger=AVAILABLE_NOW),
    )
    return spark.read.parquet(out).select("transaction_id", key, "running_total")


def q_stream_running_totals(spark, sf_dir):
    return _streamed_running(spark, sf_dir, "product_category", _event_parts)


def q_stream_running_day_totals(spark, sf_dir):
    def parts(spark, sf_dir, folder, start):
        day = F.to_date("transaction_date")
        _event_parts(spark, sf_dir, folder, lambda rows: start(rows.withColumn("day", day)))

    return _streamed_running(spark, sf_dir, "day", parts)


def q_stream_progress(spark, sf_dir):
    """What the stored progress of the parsing query adds up to."""
    folder = scratch_folder(spark, "stream_progress")
    parsed, progress = f"{folder}/parsed", ProgressStore(spark, f"{folder}/progress", INGEST)
    make_folder(spark, parsed)
    spark.streams.addListener(progress)
    try:
        _message_parts(
            spark, sf_dir, folder,
            lambda messages: progress.wait_for([start_parse(messages, parsed, f"{folder}/checkpoint", AVAILABLE_NOW)]),
        )
    finally:
        spark.streams.removeListener(progress)
    found = read_progress(spark, f"{folder}/progress")
    return found.agg(F.sum("messages").alias("messages"), F.sum("rejected").alias("rejected"))


def q_bulk_delivery(spark, sf_dir):
    """Documents sent in bulk requests of which every third one fails at first: what arrived, what was refused."""
    folder = scratch_folder(spark, "bulk")
    events = spread(table(spark, sf_dir, "events"))
    documents = to_documents(testdata.event_transactions(events, table(spark, sf_dir, "nation")))
    send = file_transport(f"{folder}/sent", refuse='"productQuantity":7,', fail_every=3)
    send_bulk(documents, send, rejects=f"{folder}/rejects", actions=200)
    sent = spark.read.text(f"{folder}/sent").where(F.col("value").startswith('{"index"'))
    doc_id = F.get_json_object("value", "$.index._id").alias("doc_id")
    arrived = sent.select(doc_id, F.lit("arrived").alias("outcome"))
    return arrived.unionByName(
        spark.read.parquet(f"{folder}/rejects").select("doc_id", F.lit("refused").alias("outcome"))
    )


def q_connection_tables(spark, sf_dir):
    """Upserts in small chunks through connections of which every third commit breaks at first; a later batch wins."""
    folder = scratch_folder(spark, "connections")
    target = ConnectionTables(file_connections(f"{folder}/rows", fail_every=3), "?", rows=5)
    target.ensure_tables(spark)
    orders = _orders(spark, sf_dir)
    for batch_id, part in enumerate((orders.where(F.xxhash64("transaction_id") % 2 == 0), orders)):
        target.upsert(sales_per_month(part), "sales_per_month", batch_id)
    rows = spark.read.schema("at bigint, values array<string>").json(f"{folder}/rows")
    kinds = {"year": "int", "month": "int", "total_sales": "double"}
    columns = [F.col("values")[k].cast(kind).alias(name) for k, (name, kind) in enumerate(kinds.items())]
    return latest_per_key(rows.select("at", *columns), ("year", "month"), "at").drop("at")


def _streamed_alerts(spark, sf_dir, target):
    folder = scratch_folder(spark, "stream_fraud")
    write = target(f"{folder}/alerts")
    _event_parts(
        spark, sf_dir, folder, lambda rows: start_fraud_alerts(rows, write, folder, trigger=AVAILABLE_NOW)
    )
    return f"{folder}/alerts"


def q_stream_fraud_alerts(spark, sf_dir):
    found = spark.read.parquet(_streamed_alerts(spark, sf_dir, folder_alerts))
    return _plain(found.drop("part", "batch_id"))


def q_stream_alert_text(spark, sf_dir):
    """The lines of all alert boxes."""
    return spark.read.text(_streamed_alerts(spark, sf_dir, text_alerts)).select("value")


def q_stream_latest_transactions(spark, sf_dir):
    """The second batch comes again after a compaction, as after a crash before its commit; a third one follows."""
    folder = scratch_folder(spark, "stream_latest")
    tables = FolderTables(f"{folder}/tables")

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = to_sink_columns(batch, *LINE_SEQ)
        if batch_id != 1:
            return tables.upsert(rows, "transactions", batch_id, LINE_SEQ)
        # Both writes start from the same rows, which are joined and shuffled once.
        rows = latest_per_key(rows, "transaction_id", LINE_SEQ).persist()
        try:
            tables.upsert(rows, "transactions", batch_id, LINE_SEQ)
            tables.compact(spark, "transactions")
            tables.upsert(rows, "transactions", batch_id, LINE_SEQ)
        finally:
            rows.unpersist()

    _line_parts(
        spark, sf_dir, folder,
        lambda rows: run(rows.writeStream.foreachBatch(store), f"{folder}/checkpoint", AVAILABLE_NOW),
    )
    tables.compact(spark, "transactions")
    return _plain(to_sink_columns(tables.read(spark, "transactions")))


def q_stream_parse(spark, sf_dir):
    folder = scratch_folder(spark, "stream_parse")
    parsed = f"{folder}/parsed"
    make_folder(spark, parsed)
    _message_parts(
        spark, sf_dir, folder,
        lambda messages: start_parse(messages, parsed, f"{folder}/checkpoint", AVAILABLE_NOW),
    )
    return _plain(accepted(spark.read.parquet(parsed)).select(*COLUMNS, "seq"))


def _streamed_raw(spark, sf_dir):
    """Raw table, documents and rejects of the messages, below the returned folder."""
    folder = scratch_folder(spark, "stream_raw")
    targets = folder_targets(f"{folder}/out")
    _message_parts(
        spark, sf_dir, folder,
        lambda messages: start_raw(
            classify_messages(messages), targets, f"{folder}/checkpoint", ["seq"], AVAILABLE_NOW
        ),
    )
    return targets, f"{folder}/out"


def q_stream_raw_transactions(spark, sf_dir):
    targets, _ = _streamed_raw(spark, sf_dir)
    return _plain(to_sink_columns(targets.tables.read(spark, "transactions")))


def q_stream_rejects(spark, sf_dir):
    _, out = _streamed_raw(spark, sf_dir)
    return spark.read.parquet(f"{out}/rejects").select("seq", "reason")


def q_stream_bulk_lines(spark, sf_dir):
    _, out = _streamed_raw(spark, sf_dir)
    return spark.read.text(f"{out}/documents").select("value")


def q_stream_kpi_summary(spark, sf_dir):
    folder = scratch_folder(spark, "stream_kpi")
    _message_parts(
        spark, sf_dir, folder,
        lambda messages: start_kpi(
            classify_messages(messages), f"{folder}/kpi", f"{folder}/checkpoint", AVAILABLE_NOW
        ),
    )
    return read_newest(spark, f"{folder}/kpi")


def q_stream_recent_transactions(spark, sf_dir):
    folder = scratch_folder(spark, "stream_recent")
    _message_parts(
        spark, sf_dir, folder,
        lambda messages: start_recent(
            classify_messages(messages), f"{folder}/recent", f"{folder}/checkpoint", trigger=AVAILABLE_NOW
        ),
    )
    newest = read_newest(spark, f"{folder}/recent")
    return recent_log(newest, F.col("reason").isNull()).select(*_RECENT)


def q_stream_pipeline(spark, sf_dir):
    """What every sink of the whole pipeline holds: (sink, n, total)."""
    folder = scratch_folder(spark, "stream_pipeline")
    targets = folder_targets(f"{folder}/out")
    _message_parts(
        spark, sf_dir, folder,
        lambda messages: start_pipeline(messages, targets, f"{folder}/work", trigger=AVAILABLE_NOW),
    )

    def held(rows: DataFrame, sink: str, amount: str | None = None) -> DataFrame:
        total = money_sum(amount) if amount else F.lit(None).cast("double")
        return rows.agg(F.count(F.lit(1)).alias("n"), total.alias("total")).select(
            F.lit(sink).alias("sink"), "n", "total"
        )

    out = f"{folder}/out"
    found = [
        held(targets.tables.read(spark, name), name, amount)
        for name, amount in (
            ("transactions", "total_amount"), ("sales_per_category", "total_sales"),
            ("sales_per_day", "total_sales"), ("sales_per_month", "total_sales"),
        )
    ]
    found += [
        held(spark.read.parquet(f"{out}/rejects"), "rejects"),
        held(spark.read.parquet(f"{out}/alerts"), "alerts", "amount"),
        held(spark.read.text(f"{out}/documents"), "documents"),
    ]
    return reduce(DataFrame.unionAll, found)


def registry() -> dict[str, Query]:
    def prepared(query: Query) -> Query:
        return lambda spark, sf_dir: query(configure(spark), sf_dir)

    found = {name: query for name, query in globals().items() if name.startswith("q_")}
    return {name.removeprefix("q_"): prepared(query) for name, query in found.items()}
