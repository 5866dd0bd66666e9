"""Starting queries: live on an interval, or once over everything there is."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

AVAILABLE_NOW = "available now"
Trigger = str
"""An interval such as ``"5 seconds"``, or AVAILABLE_NOW to read what is there and stop."""


def run(writer: DataStreamWriter, checkpoint: str, trigger: Trigger) -> StreamingQuery:
    """Start the query; with AVAILABLE_NOW also wait until it has read everything."""
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger != AVAILABLE_NOW:
        return writer.trigger(processingTime=trigger).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def make_folder(spark: SparkSession, path: str) -> None:
    """A file stream refuses to start on a folder that does not exist yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
