"""Purchase transactions on Spark: parsing, sales totals, fraud alerts, lookups and keyed sinks."""

from tillstream.operators.enrich import enrich_country, enrich_product, with_labels
from tillstream.operators.fraud import alert_text, fraud_alerts
from tillstream.operators.kpi import kpi_summary, recent_log, recent_transactions
from tillstream.operators.latest import latest_per_key
from tillstream.operators.parse import classify_messages, parse_transactions, without_null_literals
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
from tillstream.session import configure
from tillstream.sinks.documents import (
    file_transport,
    publish,
    send_bulk,
    start_publish,
    to_documents,
    to_messages,
    write_bulk,
)
from tillstream.sinks.tables import ConnectionTables, FolderTables, JdbcTables
from tillstream.sources.dims import countries, country_map, customer_countries, products
from tillstream.sources.messages import KAFKA_SEQ, file_source, kafka_source, spread
from tillstream.streaming.fraud import start_fraud_alerts
from tillstream.streaming.headline import read_newest, start_kpi, start_recent
from tillstream.streaming.pipeline import (
    Targets,
    console_alerts,
    folder_alerts,
    folder_targets,
    start_pipeline,
    start_sales,
    text_alerts,
)
from tillstream.streaming.progress import ProgressStore, read_progress
from tillstream.streaming.run import AVAILABLE_NOW
from tillstream.streaming.running import start_running_totals

__all__ = [
    "AVAILABLE_NOW",
    "ConnectionTables",
    "FolderTables",
    "JdbcTables",
    "KAFKA_SEQ",
    "ProgressStore",
    "Targets",
    "alert_text",
    "classify_messages",
    "configure",
    "console_alerts",
    "countries",
    "country_map",
    "customer_countries",
    "enrich_country",
    "enrich_product",
    "file_source",
    "file_transport",
    "folder_alerts",
    "folder_targets",
    "fraud_alerts",
    "kafka_source",
    "kpi_summary",
    "latest_per_key",
    "parse_transactions",
    "products",
    "publish",
    "read_newest",
    "read_progress",
    "recent_log",
    "recent_transactions",
    "running_totals",
    "sales_per_category",
    "sales_per_day",
    "sales_per_month",
    "send_bulk",
    "spread",
    "start_fraud_alerts",
    "start_pipeline",
    "start_kpi",
    "start_publish",
    "start_recent",
    "start_running_totals",
    "start_sales",
    "text_alerts",
    "to_documents",
    "to_messages",
    "to_sink_columns",
    "transaction_text",
    "transactions_view",
    "with_labels",
    "with_total_amount",
    "without_null_literals",
    "write_bulk",
]
