"""Headline figures and the list of recent transactions, kept up to date on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.kpi import kpi_summary, recent_transactions
from tillstream.sinks.files import Files, keep_newest
from tillstream.streaming.run import Trigger, run

_BATCH = "batch_id"
# The last one is the list; the one before it is what a repeated batch builds on. The others are for open readers.
KEPT_BATCHES = 5


def start_kpi(
    classified: DataFrame, folder: str, checkpoint: str, trigger: Trigger = "5 seconds"
) -> StreamingQuery:
    """Keep the headline figures of all messages so far; ``read_newest`` gives the row."""

    def store(figures: DataFrame, batch_id: int) -> None:
        figures.write.mode("overwrite").parquet(f"{folder}/{_BATCH}={batch_id}")
        keep_newest(figures.sparkSession, folder, KEPT_BATCHES)

    figures = kpi_summary(classified, F.col("reason").isNull())
    return run(figures.writeStream.outputMode("complete").foreachBatch(store), checkpoint, trigger)


def start_recent(
    classified: DataFrame,
    folder: str,
    checkpoint: str,
    seq: str | Sequence[str] = "seq",
    n: int = 20,
    trigger: Trigger = "5 seconds",
) -> StreamingQuery:
    """Keep the ``n`` newest messages, accepted and failed; each batch meets the list before it."""

    def store(batch: DataFrame, batch_id: int) -> None:
        before = _stored(batch.sparkSession, folder, batch_id)
        rows = batch if before is None else batch.unionByName(before)
        newest = recent_transactions(rows, n, seq)
        newest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{_BATCH}={batch_id}")
        keep_newest(batch.sparkSession, folder, KEPT_BATCHES)

    return run(classified.writeStream.foreachBatch(store), checkpoint, trigger)


def read_newest(spark: SparkSession, folder: str) -> DataFrame | None:
    """What the last batch stored."""
    return _stored(spark, folder, None)


def _stored(spark: SparkSession, folder: str, before: int | None) -> DataFrame | None:
    names = Files(spark, folder).names(folder)
    ids = [int(name.split("=")[1]) for name in names if name.startswith(f"{_BATCH}=")]
    ids = [i for i in ids if before is None or i < before]
    return spark.read.parquet(f"{folder}/{_BATCH}={max(ids)}") if ids else None
