"""Sinks: console monitor, files, and append to a database table without duplicates."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from barflow.operators import quality
from barflow.session import DENSE

# Rows shown per round, and the rounds of the two streaming sinks.
CONSOLE_ROWS = 20
CONSOLE_EVERY = "30 seconds"
DATABASE_EVERY = "60 seconds"

SIGNAL_KEY = ["symbol", "timestamp", "signal"]
BAR_KEY = ["symbol", "timestamp"]
DAY = "day"

BatchWriter = Callable[[DataFrame, int], None]


def console(signals: DataFrame, checkpoint: str, name: str = "signal_monitor") -> DataStreamWriter:
    """Show each round's signals in full width. The caller starts and stops the query."""
    return (
        signals.writeStream.queryName(name).outputMode("append").format("console")
        .option("truncate", False).option("numRows", CONSOLE_ROWS)
        .option("checkpointLocation", checkpoint).trigger(processingTime=CONSOLE_EVERY)
    )


def console_writer(rows: int = CONSOLE_ROWS) -> BatchWriter:
    """Show ``rows`` rows of each micro-batch in full width and tell how many there are."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            print(f"Batch {batch_id}: {batch.count()} rows")
            batch.show(rows, truncate=False)
        finally:
            batch.unpersist()

    return write


def each_batch(
    rows: DataFrame, write: BatchWriter, checkpoint: str, name: str, every: str = DATABASE_EVERY
) -> DataStreamWriter:
    """Hand every micro-batch to ``write``. Name and checkpoint let a restart resume."""
    return (
        rows.writeStream.queryName(name).outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(processingTime=every)
    )


def batch_folder_writer(path: str) -> BatchWriter:
    """Write micro-batch n to the folder ``batch_id=n``; a replay replaces that folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}", compression=DENSE)

    return write


def split_writer(
    check: Callable[[DataFrame], DataFrame], shape: Callable[[DataFrame], DataFrame],
    write: BatchWriter, rejects: str,
) -> BatchWriter:
    """Write the valid rows of a micro-batch in their shape, and the others to files with the reason."""
    put_aside = batch_folder_writer(rejects)

    def split(batch: DataFrame, batch_id: int) -> None:
        checked = check(batch).persist()
        try:
            put_aside(quality.rejects(checked), batch_id)
            write(shape(quality.valid(checked)), batch_id)
        finally:
            checked.unpersist()

    return split


def signal_store_writer(path: str) -> BatchWriter:
    """``write_signals`` for micro-batches: a replay replaces what it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_signals(batch, path, batch_id)

    return write


def new_rows(batch: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Rows of the batch, one per key, whose key is not in the target yet."""
    return batch.dropDuplicates(key).join(existing.select(*key), key, "left_anti")


def append_once(
    read_target: Callable[[SparkSession, TimeRange], DataFrame],
    append: Callable[[DataFrame], None],
    key: list[str],
) -> BatchWriter:
    """Append the rows of a micro-batch that the target lacks, so that a replay adds none.

    ``read_target`` gets the batch's first and last event time and returns the target's rows of
    that range, so the check reads no more of the target than the batch spans. The times come as
    numbers and text from Spark; the zone of the driver's machine plays no part.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            span = time_range(batch)
            if span is not None:
                append(new_rows(batch, read_target(batch.sparkSession, span), key))
        finally:
            batch.unpersist()

    return write


class TimeRange(NamedTuple):
    """Two event times in microseconds, and as text in the session's zone."""

    first: int
    last: int
    first_text: str
    last_text: str

    def holds(self, column: str = "timestamp") -> Column:
        """Compared as numbers of the type that the bounds are made of, so a scan can use them."""
        bounds = [F.timestamp_micros(F.lit(n)) for n in (self.first, self.last)]
        return F.col(column).between(*bounds)


def time_range(rows: DataFrame, column: str = "timestamp") -> TimeRange | None:
    first, last = F.min(column).cast("timestamp"), F.max(column).cast("timestamp")
    text = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    found = rows.agg(
        F.unix_micros(first), F.unix_micros(last), F.date_format(first, text), F.date_format(last, text)
    ).first()
    return None if found[0] is None else TimeRange(*found)


def jdbc_read_options(
    connection: Mapping[str, str], table: str, span: TimeRange, partitions: int
) -> dict[str, str]:
    """Read a table in parallel by event time. The bounds only set the stride of the split."""
    return {
        **connection, "dbtable": table, "partitionColumn": "timestamp",
        "lowerBound": span.first_text, "upperBound": span.last_text,
        "numPartitions": str(partitions),
    }


def jdbc_writer(
    connection: Mapping[str, str], table: str, key: list[str], partitions: int = 16
) -> BatchWriter:
    """Append micro-batches to a database table; URL, driver and credentials come from the caller.

    ``partitions`` bounds the connections that one batch opens.
    """

    def read_target(spark: SparkSession, span: TimeRange) -> DataFrame:
        options = jdbc_read_options(connection, table, span, partitions)
        return spark.read.format("jdbc").options(**options).load().filter(span.holds())

    def append(rows: DataFrame) -> None:
        options = {**connection, "dbtable": table, "numPartitions": str(partitions)}
        rows.write.format("jdbc").options(**options).mode("append").save()

    return append_once(read_target, append, key)


def first_day(time: Column, period: str) -> Column:
    return F.to_date(F.date_trunc(period, time))


def write_signals(signals: DataFrame, path: str, batch_id: int = 0, period: str = "day") -> None:
    """Store signals by day and kind, each file ordered by symbol and time.

    With a longer ``period`` (week, month, quarter, year), for bars that are days or weeks long, ``day``
    is the first of it; readers name the same one. Writing a batch again replaces the files of that
    batch in the days that it has. A day and kind is split over as many tasks as adaptive
    execution finds its size worth.
    """
    rows = signals.withColumns({DAY: first_day(F.col("timestamp"), period), "batch_id": F.lit(batch_id)})
    (
        rows.hint("rebalance", DAY, "signal").sortWithinPartitions(DAY, "signal", "symbol", "timestamp")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, "signal", "batch_id").parquet(path)
    )


def compact_signals(spark: SparkSession, path: str, target: str, day: date) -> None:
    """Copy a day that gets no more signals into one batch of another store.

    A day at 60 s a round has up to 1,440 small files for each kind; the copy has a few large
    ones. Read it with ``read_signals(..., compacted=(target, first day not copied))``.
    """
    write_signals(spark.read.parquet(path).filter(F.col(DAY) == F.lit(day)).drop(DAY, "batch_id"), target)


def newest_day(stored: DataFrame) -> date | None:
    """The last day that a store has rows of; no column of the files is read for it."""
    return stored.agg(F.max(DAY)).first()[0]


def signals_since(stored: DataFrame, days: int, period: str = "day") -> DataFrame:
    """Stored signals of the last ``days`` times 24 hours before the newest one.

    The newest day is read for its last time; then only the days in question are.
    """
    last_day = newest_day(stored)
    if last_day is None:
        return stored
    newest = stored.filter(F.col(DAY) == F.lit(last_day)).agg(
        F.unix_micros(F.max("timestamp").cast("timestamp"))).first()[0]
    start = F.timestamp_micros(F.lit(newest - days * 86_400_000_000))
    return stored.filter((F.col(DAY) >= first_day(start, period)) & (F.col("timestamp") >= start))


def read_signals(
    spark: SparkSession, path: str, symbol: str | None = None, kind: str | None = None,
    start: Column | None = None, end: Column | None = None,
    compacted: tuple[str, date] | None = None, period: str = "day",
) -> DataFrame:
    """Stored signals of one symbol, one kind or a time range (start inclusive, end exclusive).

    Bounds on the time are bounds on the day too, so other days are not read. ``compacted`` names
    a store of earlier days and the first day that is not in it.
    """
    rows = spark.read.parquet(path)
    if compacted is not None:
        store, first = compacted
        rows = rows.filter(F.col(DAY) >= F.lit(first)).unionByName(
            spark.read.parquet(store).filter(F.col(DAY) < F.lit(first)))
    ts, day = F.col("timestamp"), F.col(DAY)
    for condition in (
        None if symbol is None else F.col("symbol") == symbol,
        None if kind is None else F.col("signal") == kind,
        None if start is None else (ts >= start) & (day >= first_day(start, period)),
        None if end is None else (ts < end) & (day <= first_day(end, period)),
    ):
        if condition is not None:
            rows = rows.filter(condition)
    return rows
