"""Late rows kept: a gate in front of the watermark that puts aside what would be dropped behind it.

Round n of the gate holds its rows against the newest event time of all rounds before, less the delay:
rows that are not later go to files of their own, with the time they missed; the others pass. A stream
that reads what has passed, with the same delay, has a watermark that is never ahead of the gate's, as it
sees the rounds in turn, one or more at a time. So it drops nothing, and every row is either settled
there or in the gate's files.

That holds if the reader sees a round whole, as a part of it could move the watermark past the rest. So
what passes in a round is one file, written last by one task; bound rounds with the source's own limit,
such as ``maxOffsetsPerTrigger``. A round's newest time is written beside its rows, under its number. A
replayed round splits as before, and one that has been written to its end is left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.session import exists
from barflow.sinks import BatchWriter

ROUND = "batch_id"
MISSED = "watermark"
_TIMES = T.StructType([T.StructField("newest", T.TimestampType())])


def _folder(path: str, part: str, number: int) -> str:
    return f"{path}/{part}/{ROUND}={number}"


def newest_before(spark: SparkSession, path: str, number: int) -> int | None:
    """The newest event time of all rounds before, in microseconds: each round keeps that of all up to it."""
    while number > 0:
        number -= 1
        if exists(spark, _folder(path, "times", number)):
            found = spark.read.schema(_TIMES).parquet(_folder(path, "times", number))
            return found.agg(F.unix_micros(F.max("newest"))).first()[0]
    return None


def gate(path: str, delay: str, time: str = "timestamp") -> BatchWriter:
    """A ``foreachBatch`` function that writes rounds to ``passed`` and ``late`` below ``path``.

    Rows without a time pass.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark, at = batch.sparkSession, F.col(time).cast("timestamp")
        if exists(spark, f"{_folder(path, 'passed', number)}/_SUCCESS"):
            return
        newest = newest_before(spark, path, number)
        batch = batch.persist()
        try:
            limit = F.lit(None).cast("timestamp")
            if newest is not None:
                limit = F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {delay}")
            # Spark's watermark counts whole milliseconds.
            limit = F.date_trunc("millisecond", limit)
            is_late = F.coalesce(at <= limit, F.lit(False))
            batch.filter(is_late).withColumn(MISSED, limit).write.mode("overwrite").parquet(_folder(path, "late", number))
            batch.agg(F.greatest(F.max(at), F.timestamp_micros(F.lit(newest).cast("long"))).alias("newest")).coalesce(
                1).write.mode("overwrite").parquet(_folder(path, "times", number))
            batch.filter(~is_late).coalesce(1).write.mode("overwrite").parquet(_folder(path, "passed", number))
        finally:
            batch.unpersist()

    return run


def passed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What the gate let through, as a stream in the order of its rounds."""
    return spark.readStream.schema(schema).parquet(f"{path}/passed")


def late(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What came too late, with the round and the time that it missed."""
    known = T.StructType([*schema, T.StructField(MISSED, T.TimestampType()), T.StructField(ROUND, T.LongType())])
    return spark.read.schema(known).parquet(f"{path}/late")
