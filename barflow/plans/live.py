"""The live jobs: publish bars to a topic, watch the signals of a topic, store them.

Each function starts a query and returns it; the caller waits for it and stops it. Every query
has a name and a checkpoint of its own under ``checkpoints``, so it resumes after a restart.

As a job, with the topic connector on the class path:
``python -m barflow.plans.live <shared folder>``.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barflow import sinks
from barflow.operators import quality
from barflow.operators.signals import monitor
from barflow.plans.flow import bars_of_messages, signal_stream
from barflow.schema import MINUTE_BAR_CHUNK
from barflow.session import ROCKSDB
from barflow.sources import messages
from barflow.sources.topic import TopicSettings, publish_stream, read_topic
from barflow.streaming.history import settled

# How long a bar may arrive behind newer ones before it counts as late.
DELAY = "2 minutes"

# Most messages of one round, so that a restart after an outage works in steps.
ROUND_MESSAGES = 1_000_000

SIGNAL_TABLE = "trading_signals"
BAR_TABLE = "stock_data"


def start_publisher(
    bars: DataFrame, settings: TopicSettings, checkpoints: str
) -> StreamingQuery:
    """Publish a stream of bars, keyed by symbol."""
    sent = messages.encode(bars)
    writer = publish_stream(sent, settings, f"{checkpoints}/bar_publisher")
    return writer.queryName("bar_publisher").start()


def start_signals(
    envelope: DataFrame, store: str, targets: Sequence[sinks.BatchWriter], checkpoints: str,
    delay: str = DELAY, every: str = sinks.DATABASE_EVERY, name: str = "signals", once: bool = False,
    chunk: str | None = MINUTE_BAR_CHUNK,
) -> StreamingQuery:
    """The signals of a message stream, to every target: monitor, files and tables of one job.

    ``once`` works off what the source holds now and ends; the same checkpoint and store then go
    on live, and the other way round. Bound a round with the source's own limit, such as
    ``maxOffsetsPerTrigger``. ``chunk`` fits the unit of the bars (``chunk_of``).
    """
    writer = signal_stream(envelope, store, delay, targets, f"{checkpoints}/{name}", name, every, chunk)
    return (writer.trigger(availableNow=True) if once else writer).start()


def monitor_writer(rows: int = sinks.CONSOLE_ROWS) -> sinks.BatchWriter:
    """Show each round's signals on the console."""
    show = sinks.console_writer(rows)
    return lambda signals, number: show(monitor(signals), number)


def signal_table_writer(connection: Mapping[str, str], rejects: str) -> sinks.BatchWriter:
    """Append signals to the signal table; those that it cannot hold go to files, with the reason."""
    write = sinks.jdbc_writer(connection, SIGNAL_TABLE, sinks.SIGNAL_KEY)
    return sinks.split_writer(
        quality.with_signal_reason, quality.trading_signals_rows, write, rejects)


def start_reject_files(envelope: DataFrame, path: str, checkpoints: str) -> StreamingQuery:
    """Store the messages that are no bars as they came, by reason, for later inspection."""
    _, rejects = bars_of_messages(envelope)
    return (
        rejects.writeStream.queryName("bar_rejects").format("parquet")
        .partitionBy(quality.REASON).option("path", path)
        .option("checkpointLocation", f"{checkpoints}/bar_rejects")
        .trigger(processingTime=sinks.DATABASE_EVERY).start()
    )


def start_field_error_files(envelope: DataFrame, path: str, checkpoints: str) -> StreamingQuery:
    """Store the fields that are not of their type, with their text and message, by field."""
    return (
        messages.field_errors(envelope).writeStream.queryName("field_errors").format("parquet")
        .partitionBy("field").option("path", path)
        .option("checkpointLocation", f"{checkpoints}/field_errors")
        .trigger(processingTime=sinks.DATABASE_EVERY).start()
    )


def start_bar_table(
    envelope: DataFrame, connection: Mapping[str, str], rejects: str, checkpoints: str, delay: str = DELAY
) -> StreamingQuery:
    """Append the bars of a message stream to the bar table, each bar's last copy.

    Bars that the table cannot hold go to files, with the reason and the message.
    """
    bars, _ = bars_of_messages(envelope)
    write = sinks.split_writer(
        quality.with_stock_reason, quality.stock_data_rows,
        sinks.jdbc_writer(connection, BAR_TABLE, sinks.BAR_KEY), rejects)
    return sinks.each_batch(
        settled(bars, delay, ["message_value"]), write, f"{checkpoints}/{BAR_TABLE}", BAR_TABLE
    ).start()


def main(folder: str) -> None:
    """Watch and store the signals of the topic named by the environment until the job is stopped.

    Bars, signals, rejects and checkpoints lie below ``folder``, which all executors share.
    """
    spark = (
        SparkSession.builder.appName("barflow").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB).getOrCreate()
    )
    try:
        envelope = read_topic(
            spark, TopicSettings.from_env(), maxOffsetsPerTrigger=str(ROUND_MESSAGES)
        )
        start_reject_files(envelope, f"{folder}/rejects", f"{folder}/checkpoints")
        start_signals(
            envelope, f"{folder}/bars", [monitor_writer(), sinks.signal_store_writer(f"{folder}/signals")],
            f"{folder}/checkpoints", every=sinks.CONSOLE_EVERY,
        )
        spark.streams.awaitAnyTermination()
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1])
