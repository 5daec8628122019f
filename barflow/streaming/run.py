"""Run a streaming frame over what its source holds now."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def run_once(writer: DataStreamWriter) -> None:
    """Process all available input, then end."""
    writer.trigger(availableNow=True).start().awaitTermination()


def drain(rows: DataFrame, path: str, name: str | None = None) -> DataFrame:
    """Process all available input into files below ``path`` and read them back.

    The checkpoint lies beside the files, so a second call on the same path resumes.
    """
    writer = rows.writeStream.format("parquet").outputMode("append")
    if name:
        writer = writer.queryName(name)
    run_once(writer.option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint"))
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/rows")


def drain_to_end(
    stream: Callable[[], DataFrame], close: Callable[[], None], path: str
) -> DataFrame:
    """``drain`` for bounded input: rows that still wait for the watermark come out too.

    ``close`` puts a record far behind all others into the source of ``stream``. The watermark
    then passes all rows but that record's own, which stays open and never comes out.
    """
    drain(stream(), path)
    close()
    return drain(stream(), path)
