"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Overflowing sums fail instead of wrapping around.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Keyed state of unbounded size belongs in RocksDB rather than on the executor heap.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session-level settings; dates and times are always computed in UTC."""
    for name, value in {**SETTINGS, **STREAM_SETTINGS}.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "8g", app: str = "tillstream") -> SparkSession:
    """A local session for tests and benchmarks, without the web interface."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Executors must all see it, so without that setting only a local session gets one (in the
    system's temporary folder).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = os.path.join(tempfile.gettempdir(), "tillstream")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
