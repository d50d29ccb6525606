"""Message streams: Kafka topics, or folders of text files standing in for them.

Both give ``value string``, ``topic string`` and ``_seq``, the message's place
in its source. ``_seq`` orders messages with the same key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQUENCE = "_seq"
# Folder of one publication: this, the time in UTC to the microsecond, and more.
PUBLICATION = "publication="
SEQUENCE_TYPE = T.StructType(
    [
        T.StructField("at", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("position", T.LongType()),
    ]
)


def topic_names(topics: str) -> list[str]:
    """Comma-separated names, without repeats."""
    return list(dict.fromkeys(name for name in topics.split(",") if name))


def paths(root: str, topics: str) -> list[str]:
    """The folders that stand for the topics."""
    return [f"{root}/{name}" for name in topic_names(topics)]


def kafka_options(
    topics: str, brokers: str, group: str | None = None, poll_timeout_ms: int = 5000,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Read from the beginning; the checkpoint, not the broker, keeps offsets.

    ``max_offsets_per_trigger`` cuts a long backlog into micro-batches.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topic_names(topics)),
        "startingOffsets": "earliest",
        "kafkaConsumer.pollTimeoutMs": str(poll_timeout_ms),
    }
    if group:
        options["groupIdPrefix"] = group
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def sequence(at: Column, source: Column, block: Column, position: Column) -> Column:
    return F.struct(
        at.cast("timestamp").alias("at"),
        source.cast("string").alias("source"),
        block.cast("bigint").alias("block"),
        position.cast("bigint").alias("position"),
    ).alias(SEQUENCE)


def kafka_messages(records: DataFrame) -> DataFrame:
    """Text, topic and order of Kafka records.

    The offset alone orders a partition, whatever its producers' clocks say. Messages
    of one key belong in one partition; across partitions the name decides.
    """
    source = F.concat_ws("-", "topic", F.col("partition").cast("string"))
    return records.select(
        F.col("value").cast("string").alias("value"),
        "topic",
        sequence(F.lit(None), source, F.lit(0), F.col("offset")),
    )


def kafka_stream(spark: SparkSession, topics: str, brokers: str, **settings) -> DataFrame:
    """Needs the Kafka package on the class path."""
    options = kafka_options(topics, brokers, **settings)
    return kafka_messages(spark.readStream.format("kafka").options(**options).load())


def published_at() -> Column:
    """When a message was published: the time in its folder's name, else its file's own."""
    path = F.col("_metadata.file_path")
    stamp = F.regexp_extract(path, rf"/{PUBLICATION}(\d{{8}}T\d{{12}})-[^/]*/[^/]*\z", 1)
    named = F.to_timestamp(F.nullif(stamp, F.lit("")), "yyyyMMdd'T'HHmmssSSSSSS")
    return F.coalesce(named, F.col("_metadata.file_modification_time"))


def folder_stream(
    spark: SparkSession, root: str, topics: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """One text folder ``root/<topic>`` per distinct topic."""

    def one(topic: str) -> DataFrame:
        reader = spark.readStream.option("recursiveFileLookup", True)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.text(f"{root}/{topic}").select(
            "value",
            F.lit(topic).alias("topic"),
            # Splits of a file may run in any order. The place within a split is
            # not known to a stream; the keyed write numbers it.
            sequence(
                published_at(),
                F.col("_metadata.file_path"),
                F.col("_metadata.file_block_start"),
                F.lit(None),
            ),
        )

    return reduce(DataFrame.unionByName, [one(topic) for topic in topic_names(topics)])
