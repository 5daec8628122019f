"""Topic source and sink. The connector package is chosen by the deployment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from barflow.sources.bars import symbol_list

# Defaults of the environment settings.
DEFAULT_SERVERS = "localhost:9092"
DEFAULT_TOPIC = "stock-data"
DEFAULT_SYMBOLS = "AAPL,GOOGL,MSFT"

# Delivery settings of the publisher.
DELIVERY = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
    "kafka.buffer.memory": "33554432",
}

# Fixed value: seconds between two publishing rounds.
PUBLISH_EVERY = "30 seconds"


@dataclass(frozen=True)
class TopicSettings:
    servers: str = DEFAULT_SERVERS
    topic: str = DEFAULT_TOPIC
    symbols: list[str] = field(default_factory=lambda: symbol_list(DEFAULT_SYMBOLS))

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> TopicSettings:
        return cls(
            env.get("KAFKA_BOOTSTRAP_SERVERS", DEFAULT_SERVERS),
            env.get("KAFKA_TOPIC", DEFAULT_TOPIC),
            symbol_list(env.get("STOCK_SYMBOLS", DEFAULT_SYMBOLS)),
        )


def source_options(settings: TopicSettings, **extra: str) -> dict[str, str]:
    """Start at the newest messages and go on when old offsets are gone.

    Add ``maxOffsetsPerTrigger`` to bound a micro-batch when a backlog is read, and
    ``startingOffsets="earliest"`` to work off what a topic already holds: a first run otherwise
    begins with what is sent after it has started.
    """
    return {
        "kafka.bootstrap.servers": settings.servers,
        "subscribe": settings.topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        **extra,
    }


def sink_options(settings: TopicSettings, **extra: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": settings.servers, "topic": settings.topic, **DELIVERY, **extra,
    }


def read_topic(spark: SparkSession, settings: TopicSettings, **extra: str) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(settings, **extra)).load()


def publish(messages: DataFrame, settings: TopicSettings, **extra: str) -> None:
    """Write a bounded set of messages; a failed send fails the job instead of being lost."""
    messages.select("key", "value").write.format("kafka").options(**sink_options(settings, **extra)).save()


def publish_stream(
    messages: DataFrame, settings: TopicSettings, checkpoint: str, every: str = PUBLISH_EVERY,
    **extra: str,
) -> DataStreamWriter:
    """Publish in rounds; rounds never overlap and a late round starts at once."""
    return (
        messages.select("key", "value").writeStream.format("kafka").options(**sink_options(settings, **extra))
        .option("checkpointLocation", checkpoint).trigger(processingTime=every)
    )
