"""Message topics and sockets as sources of lines, and lines published to a topic.

The Kafka source and sink need Spark's connector package on the class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def topic_options(servers: str, topic: str, starting: str = "latest") -> dict[str, str]:
    """Options of the topic source. Offsets live in the query's checkpoint, not in a group."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str
) -> DataFrame:
    """Messages of a topic as lines; extra options such as ``maxOffsetsPerTrigger`` pass through."""
    reader = spark.readStream.format("kafka").options(**topic_options(servers, topic, starting))
    return message_lines(reader.options(**options).load())


def message_lines(messages: DataFrame) -> DataFrame:
    """Message values as text."""
    return messages.select(F.col("value").cast("string").alias("value"))


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines sent to a socket. Not replayable, so for trying things out only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def end_of_input(spark: SparkSession, schema: T.StructType, at_ms: int, ts: str = "ts") -> DataFrame:
    """One row with a time and nothing else, to end a bounded stream with.

    No job counts it, but it closes the windows and deadlines before it.
    """
    rows = spark.createDataFrame([tuple(None for _ in schema)], schema)
    return rows.withColumn(ts, F.timestamp_millis(F.lit(at_ms)).cast(schema[ts].dataType))


def publish_lines(
    lines: DataFrame, fmt: str = "kafka", mode: str = "append", **options: str
) -> None:
    """Write each line as one message without a key.

    ``options`` are the sink's own: servers and ``topic`` for a topic, ``path``
    for files.
    """
    lines.select(F.col("value").cast("string").alias("value")).write.format(fmt).mode(
        mode
    ).options(**options).save()
