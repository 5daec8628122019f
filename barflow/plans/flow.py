"""The stages put together, for batch and for streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter

from barflow.functions.rules import Thresholds
from barflow.operators import quality
from barflow.operators.enrich import enrich
from barflow.operators.signals import signals_with_risk
from barflow.schema import MINUTE_BAR_CHUNK
from barflow.sinks import BatchWriter, each_batch
from barflow.sources import messages
from barflow.sources.bars import build_bars, chunk_of
from barflow.streaming.history import history_rounds, settled


def signals_of_bars(
    bars: DataFrame, tie_break: Sequence[str] = (), chunk: str | None = MINUTE_BAR_CHUNK,
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """Bars in, actionable signals with risk columns out."""
    return signals_with_risk(enrich(bars, tie_break, chunk), thresholds)


def signals_of_trades(
    trades: DataFrame, unit: str, order: Column, thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """Trades in, signals of their bars out, in the layout that fits the bar unit."""
    bars = build_bars(trades, unit, order)
    return signals_of_bars(bars, chunk=chunk_of(unit), thresholds=thresholds)


def bars_of_messages(envelope: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bars, rejects with their reason) of a batch or a stream of messages.

    A reject is a message that is no bar: damaged, or without symbol or time. What a table cannot
    hold is turned away before that table, not here, so bars and messages give the same signals.
    """
    checked = quality.with_bar_reason(messages.parse(envelope))
    return quality.valid(checked), quality.rejects(checked)


def signals_of_messages(
    envelope: DataFrame, chunk: str | None = MINUTE_BAR_CHUNK,
    thresholds: Thresholds = Thresholds(),
) -> DataFrame:
    """A table of messages in, signals out. A bar that was polled more than once counts once."""
    bars, _ = bars_of_messages(envelope)
    return signals_of_bars(messages.last_copies(bars), chunk=chunk, thresholds=thresholds)


def signal_stream(
    envelope: DataFrame, store: str, delay: str, sinks: Sequence[BatchWriter], checkpoint: str, name: str,
    every: str, chunk: str | None = MINUTE_BAR_CHUNK, thresholds: Thresholds = Thresholds(),
) -> DataStreamWriter:
    """A stream of messages in, signals with risk columns out to every sink, round by round.

    The live form of ``signals_of_bars``. The bars are kept under ``store``.
    """
    bars, _ = bars_of_messages(envelope)

    def signals_to(sink: BatchWriter) -> BatchWriter:
        return lambda enriched, number: sink(signals_with_risk(enriched, thresholds), number)

    run = history_rounds(store, [signals_to(sink) for sink in sinks], chunk)
    return each_batch(settled(bars, delay), run, checkpoint, name, every)
