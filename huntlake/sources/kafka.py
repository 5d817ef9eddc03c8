"""Kafka topics, bounded and unbounded.

Both calls need Spark's Kafka connector package on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    ending_offsets: str | None = None,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Connector options for one topic.

    ``servers`` is ``host:port[,host:port...]``. Data already removed by the
    broker's retention does not fail the read. ``min_partitions`` splits hot
    topic partitions over several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if ending_offsets is not None:
        options["endingOffsets"] = ending_offsets
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    ending_offsets: str = "latest",
    min_partitions: int | None = None,
) -> DataFrame:
    """Bounded read of a topic, for backfill."""
    options = topic_options(servers, topic, starting_offsets, ending_offsets, min_partitions)
    return spark.read.format("kafka").options(**options).load()


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded read of a topic. The checkpoint of the sink remembers the offsets."""
    options = topic_options(
        servers,
        topic,
        starting_offsets,
        min_partitions=min_partitions,
        max_offsets_per_trigger=max_offsets_per_trigger,
    )
    return spark.readStream.format("kafka").options(**options).load()
