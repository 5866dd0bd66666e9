"""Message streams: a Kafka topic, or a folder of files that stands in for one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstream.schema import TOPIC

# Arrival order of Kafka records: broker time first, position within the partition last.
KAFKA_SEQ = ("timestamp", "partition", "offset")


def kafka_options(
    servers: str,
    topic: str = TOPIC,
    starting: str = "earliest",
    max_offsets: int | None = None,
    group: str | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if group is not None:
        options["kafka.group.id"] = group
    return options


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    starting: str = "earliest",
    bounded: bool = False,
    max_offsets: int | None = None,
    group: str | None = None,
) -> DataFrame:
    """The topic as (value, timestamp, partition, offset); needs Spark's Kafka package.

    ``bounded`` reads what the topic holds now as a batch, otherwise the stream never ends. ``group`` is the consumer
    group that the broker sees; the stream's position is in its checkpoint, so each query needs a group of its own.
    """
    reader = spark.read if bounded else spark.readStream
    options = kafka_options(servers, topic, starting, None if bounded else max_offsets, group)
    return (
        reader.format("kafka")
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"), *KAFKA_SEQ)
    )


def file_source(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    format: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """New files below ``path`` as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.format(format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer tasks than there are cores, dealt out to all of them; any other scan as it is.

    Parsing a message costs several times what sending it does, and one file or one broker partition is one task.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
