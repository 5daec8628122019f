"""History features on a stream of bars, round by round with the batch operator.

Row-ordered windows do not exist on streams. But an aggregation under a watermark emits each
(symbol, time) once, when the watermark has passed it, so every round holds bars later than those
of all earlier rounds (``settled``). A round writes its bars to a store under its number, takes
the last 19 bars of its symbols from the rounds before, and runs the batch operator on both: the
work stays in the JVM and a symbol with a large share of the bars is cut into chunks.

The last 19 bars come from a snapshot and the rounds since (``tails``), so a round reads the same
few folders however long the stream has been running. Watermark, late rows and the state of bars that
still wait are Spark's. A replayed round replaces its own folder and reads only earlier ones, so it
gives the same rows again. Catching up on a
backlog and going on live are the same job with another trigger: they share store and checkpoint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.streaming import StreamingQuery

from barflow.operators.enrich import enrich, rows_before
from barflow.schema import BAR_COLUMNS, MINUTE_BAR_CHUNK
from barflow.session import DENSE
from barflow.sinks import BatchWriter
from barflow.sources import messages
from barflow.streaming.tails import EVERY, ROUND, bars_before, round_folder, write_snapshot


def on_time(bars: DataFrame, delay: str) -> DataFrame:
    """Set the watermark: bars older than the newest event time minus ``delay`` are dropped.

    Spark counts them, see ``late_bars``.
    """
    return bars.withWatermark("timestamp", delay)


def settled(parsed: DataFrame, delay: str, keep: Sequence[str] = ()) -> DataFrame:
    """Each bar of a stream of parsed messages once, its last copy, when the watermark passes it.

    ``symbol`` and ``timestamp`` must not be NULL: reject such rows first. ``keep`` names more columns
    of that copy.
    """
    return messages.last_copies(on_time(parsed, delay), keep)


def history_rounds(
    store: str, sinks: Sequence[BatchWriter], chunk: str | None = MINUTE_BAR_CHUNK,
    lookback: str | None = None, every: int = EVERY,
) -> BatchWriter:
    """A ``foreachBatch`` function that enriches settled bars and hands them to every sink.

    A sink may see a round again after a failure and must then replace what it wrote for it. A
    snapshot of the last bars is written ``every`` so many rounds; with a ``lookback`` its older bars
    are read only for symbols with fewer than 19 bars within that time.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark, folder, seen = batch.sparkSession, round_folder(store, number), Observation()
        batch.observe(seen, F.unix_micros(F.min("timestamp").cast("timestamp")).alias("first")).write.mode(
            "overwrite").parquet(folder, compression=DENSE)
        write_snapshot(spark, store, batch.schema, number, every)
        first = seen.get["first"]
        if first is None:
            return
        new = spark.read.schema(batch.schema).parquet(folder)
        start = F.timestamp_micros(F.lit(first))
        symbols = new.select("symbol").distinct()
        earlier = bars_before(spark, store, batch.schema, number, every).select(*BAR_COLUMNS)
        before = rows_before(earlier.join(symbols, "symbol", "left_semi"), start, symbols, lookback=lookback)
        enriched = enrich(new.unionByName(before, allowMissingColumns=True), chunk=chunk).filter(F.col("timestamp") >= start)
        if len(sinks) > 1:
            enriched = enriched.persist()
        try:
            for sink in sinks:
                sink(enriched, number)
        finally:
            if len(sinks) > 1:
                enriched.unpersist()

    return run


def late_bars(query: StreamingQuery) -> int:
    """Bars dropped as later than the watermark, over the rounds that Spark still reports."""
    return sum(
        op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators
    )
