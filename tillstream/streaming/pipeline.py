"""One message stream fanned out to every sink.

The messages are parsed once, into a folder written by Spark's exactly-once file sink. All other
queries stream from that folder and read only the columns they need:

* ``raw``: raw table, documents and rejects, from one persisted micro-batch;
* ``sales_per_category``, ``sales_per_day``, ``sales_per_month``: running totals as upserts;
* ``kpi``, ``recent``: headline figures and the newest messages;
* ``fraud``: alerts (two chained queries).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.fraud import alert_text
from tillstream.operators.latest import latest_per_key
from tillstream.operators.parse import accepted, classify_messages, rejected
from tillstream.operators.project import to_sink_columns
from tillstream.operators.sales import sales_per_category, sales_per_day, sales_per_month
from tillstream.sinks.documents import to_documents, write_bulk
from tillstream.sinks.tables import FolderTables, JdbcTables
from tillstream.sources.messages import file_source
from tillstream.streaming.as_written import start_category_as_written, start_day_as_written
from tillstream.streaming.fraud import WriteAlerts, start_fraud_alerts
from tillstream.streaming.headline import start_kpi, start_recent
from tillstream.streaming.progress import ProgressStore, Retention
from tillstream.streaming.run import AVAILABLE_NOW, Trigger, make_folder, run

INGEST = "ingest"
PARSED_AT = "parsed_at"
# Readers of the parsed messages that run at the same time when they read what is there and stop.
TOGETHER = 4
WriteBatch = Callable[[DataFrame, int], None]
SALES = {
    "sales_per_category": sales_per_category,
    "sales_per_day": sales_per_day,
    "sales_per_month": sales_per_month,
}
# Totals stored under another key than they are summed under need more than one aggregation.
AS_WRITTEN = {
    "sales_per_category": start_category_as_written,
    "sales_per_day": start_day_as_written,
}


@dataclass
class Targets:
    """Where the results go; every function must be safe to repeat for the same batch."""

    tables: FolderTables | JdbcTables
    documents: WriteBatch
    rejects: WriteBatch
    alerts: WriteAlerts


def folder_targets(root: str) -> Targets:
    """Everything below one folder: tables, bulk request files, rejects and alerts."""
    return Targets(
        tables=FolderTables(f"{root}/tables"),
        documents=lambda df, batch_id: write_bulk(df, f"{root}/documents/batch_id={batch_id}"),
        rejects=lambda df, batch_id: df.write.mode("overwrite").parquet(
            f"{root}/rejects/batch_id={batch_id}"
        ),
        alerts=folder_alerts(f"{root}/alerts"),
    )


def folder_alerts(root: str) -> WriteAlerts:
    def write(alerts: DataFrame, part: str, batch_id: int) -> None:
        alerts.write.mode("overwrite").parquet(f"{root}/part={part}/batch_id={batch_id}")

    return write


def text_alerts(root: str) -> WriteAlerts:
    """Store every alert box as text, one file line per line of the box."""

    def write(alerts: DataFrame, part: str, batch_id: int) -> None:
        path = f"{root}/part={part}/batch_id={batch_id}"
        alert_text(alerts).select("alert").write.mode("overwrite").text(path)

    return write


def console_alerts() -> WriteAlerts:
    """Print every alert box; the driver holds one partition of texts at a time."""

    def write(alerts: DataFrame, part: str, batch_id: int) -> None:
        for row in alert_text(alerts).select("alert").toLocalIterator():
            print(row.alert)

    return write


def start_sales(
    transactions: DataFrame,
    table: str,
    tables: FolderTables | JdbcTables,
    checkpoint: str,
    trigger: Trigger = "5 seconds",
    replays: str | None = None,
    **options,
) -> StreamingQuery:
    """Keep one sales table up to date; a repeated batch writes the same totals again.

    ``replays`` (a time such as ``"7 days"``) counts a transaction that is sent again within that time of event time
    once, by its id. The ids are state for that long, and a transaction that comes later than that is left out;
    without ``replays`` each row counts, however late.
    """

    def store(totals: DataFrame, batch_id: int) -> None:
        tables.upsert(totals, table, batch_id)

    mode, time_col = options.get("mode", "calendar"), options.get("time_col")
    if replays:
        marked = transactions.withWatermark(time_col or "transaction_date", replays)
        transactions = marked.dropDuplicatesWithinWatermark(["transaction_id"])
    if mode == "as_written" and table in AS_WRITTEN:
        return AS_WRITTEN[table](transactions, store, checkpoint, time_col or "ingest_ts", trigger)
    totals = SALES[table](transactions, **options)
    return run(totals.writeStream.outputMode("update").foreachBatch(store), checkpoint, trigger)


def start_raw(
    classified: DataFrame,
    targets: Targets,
    checkpoint: str,
    seq: Sequence[str],
    trigger: Trigger = "5 seconds",
) -> StreamingQuery:
    """Raw table, documents and rejects from one pass over each micro-batch."""

    # The text of a message is kept for rejects only.
    if "value" in classified.columns:
        classified = classified.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        # Both the table and the index keep the last write per id.
        latest = latest_per_key(accepted(batch), "transaction_id", seq).drop(*seq).persist()
        try:
            targets.tables.upsert(to_sink_columns(latest), "transactions", batch_id)
            targets.documents(to_documents(latest), batch_id)
            targets.rejects(rejected(batch), batch_id)
        finally:
            latest.unpersist()
            batch.unpersist()

    return run(classified.writeStream.foreachBatch(store), checkpoint, trigger)


def start_parse(
    messages: DataFrame, folder: str, checkpoint: str, trigger: Trigger = "5 seconds"
) -> StreamingQuery:
    """Parse each message once; counts and the newest date are reported per micro-batch (as ``INGEST``).

    The message text is kept for rejects only. Each micro-batch has a sub-folder, named by the time it was planned.
    """
    classified = classify_messages(messages).observe(
        INGEST,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
        F.max("transaction_date").alias("newest"),
    )
    kept = classified.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value")))
    # The time of a micro-batch is part of its plan: a repeated one has the same.
    kept = kept.withColumn(PARSED_AT, F.date_format(F.current_timestamp(), "'t'yyyyMMddHHmmssSSS"))
    writer = kept.writeStream.partitionBy(PARSED_AT).format("parquet").option("path", folder)
    return run(writer, checkpoint, trigger)


def start_pipeline(
    messages: DataFrame,
    targets: Targets,
    folder: str,
    seq: Sequence[str] = ("seq",),
    trigger: Trigger = "5 seconds",
    time_col: str = "transaction_date",
    mode: str = "calendar",
    keep_parsed: bool = False,
) -> list[StreamingQuery]:
    """Start every query; ``folder`` keeps the parsed messages, the checkpoints and the counts of each micro-batch.

    Parsed messages are deleted when all queries have taken them in, unless ``keep_parsed``: a query that is added
    later needs them. ``folder``/progress holds the counts of the parsing query (``read_progress``).

    ``messages`` is a stream with ``value`` and the ordering columns ``seq``, which must grow
    with arrival. A later query takes whole commits of the parsing one, never a part of one, so that the order
    inside a commit stays ``seq``; bound a backlog at the source. ``time_col`` decides the day and month of
    a sale; it may be an arrival time that came with the message. ``mode`` is that of the sales tables.
    Restarting with the same folder goes on where the queries stopped.
    """
    spark = messages.sparkSession
    parsed = f"{folder}/parsed"
    targets.tables.ensure_tables(spark)
    make_folder(spark, parsed)

    schema = classify_messages(messages).schema.add(PARSED_AT, "string")
    progress = ProgressStore(spark, f"{folder}/progress", INGEST)
    # Other pipelines of the session report, too.
    readers = {name: f"{name} of {folder}" for name in ("raw", *SALES, "kpi", "recent", "fraud")}
    retention = Retention(spark, parsed, PARSED_AT, list(readers.values()), f"{folder}/reached.json")
    observers = [progress] if keep_parsed else [progress, retention]
    for observer in observers:
        spark.streams.addListener(observer)
    queries = [start_parse(messages, parsed, f"{folder}/checkpoints/parse", trigger)]

    def classified(name: str) -> DataFrame:
        rows = file_source(spark, parsed, schema)
        return rows.observe(readers[name], F.max(PARSED_AT).alias("upto")).drop(PARSED_AT)

    def raw() -> list[StreamingQuery]:
        return [start_raw(classified("raw"), targets, f"{folder}/checkpoints/raw", seq, trigger)]

    def sales(table: str) -> list[StreamingQuery]:
        rows, checkpoint = accepted(classified(table)), f"{folder}/checkpoints/{table}"
        return [start_sales(rows, table, targets.tables, checkpoint, trigger, time_col=time_col, mode=mode)]

    headline = f"{folder}/headline"

    def kpi() -> list[StreamingQuery]:
        return [start_kpi(classified("kpi"), f"{headline}/kpi", f"{folder}/checkpoints/kpi", trigger)]

    def recent() -> list[StreamingQuery]:
        checkpoint = f"{folder}/checkpoints/recent"
        return [start_recent(classified("recent"), f"{headline}/recent", checkpoint, seq, trigger=trigger)]

    def fraud() -> list[StreamingQuery]:
        return start_fraud_alerts(accepted(classified("fraud")), targets.alerts, f"{folder}/fraud", seq, trigger)

    starts = [raw, *(partial(sales, table) for table in SALES), kpi, recent, fraud]
    # A query that ends by itself keeps its thread until then: one fills the cores that another leaves idle, as it
    # is with a live trigger.
    with ThreadPoolExecutor(TOGETHER if trigger == AVAILABLE_NOW else 1) as pool:
        for started in pool.map(lambda start: start(), starts):
            queries += started
    if trigger == AVAILABLE_NOW:
        for observer in observers:
            observer.wait_for(queries)
            spark.streams.removeListener(observer)
    return queries
