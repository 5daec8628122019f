"""Per-symbol history features and the row-wise columns derived from them.

Two layouts give the same rows:

* chunks (the default): series cut by event time, each chunk seeded with the 19 bars before it.
  Safe when one symbol holds a large share of all bars: a task gets the bars of one chunk, and one
  row per chunk to link them.
* whole series (``chunk=None``): one exchange by symbol, one sort, one Window. Cheaper, and right
  when a series is bounded by the calendar: daily bars number 366 a year, however hot the symbol.

``sources.bars.chunk_of`` gives the layout that fits a bar unit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.functions import candle
from barflow.schema import LOOKBACK_ROWS, MINUTE_BAR_CHUNK

CHUNK = "_chunk"
BORROWED = "_borrowed"


def add_history(
    bars: DataFrame, tie_break: Sequence[str] = (), keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Previous bar and trailing average volume over each ordered series."""
    series = Window.partitionBy(*keys).orderBy("timestamp", *tie_break)
    trailing = series.rowsBetween(-LOOKBACK_ROWS, 0)
    previous = {f"prev_{c}": F.lag(c, 1).over(series) for c in ("close", "high", "low", "volume")}
    return bars.withColumns({**previous, "avg_volume_20": F.avg("volume").over(trailing)})


def add_candle_shape(bars: DataFrame) -> DataFrame:
    return bars.withColumns({
        "body_size": candle.body_size(),
        "upper_shadow": candle.upper_shadow(),
        "lower_shadow": candle.lower_shadow(),
    })


def add_price_change(bars: DataFrame) -> DataFrame:
    return (
        bars.withColumn("price_change", candle.price_change())
        .withColumn("price_change_pct", candle.price_change_pct())
    )


def add_volume_metrics(bars: DataFrame) -> DataFrame:
    return bars.withColumn("volume_ratio", candle.volume_ratio()).withColumns({
        "volume_spike": candle.volume_spike(),
        "high_volume_up": candle.high_volume_up(),
        "high_volume_down": candle.high_volume_down(),
    })


def derive(bars: DataFrame) -> DataFrame:
    """Every row-wise column. Works on batch and streaming frames alike."""
    return (
        bars.transform(add_candle_shape).transform(add_price_change).transform(add_volume_metrics)
    )


def enrich(
    bars: DataFrame, tie_break: Sequence[str] = (), chunk: str | None = MINUTE_BAR_CHUNK
) -> DataFrame:
    """A bar with its history, shape, price-change and volume columns."""
    if chunk is None:
        return derive(add_history(bars, tie_break))
    return derive(add_history_in_chunks(bars, chunk, tie_break))


def last_rows(bars: DataFrame, n: int, tie_break: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The newest ``n`` rows of each group.

    Spark limits each group to ``n`` rows on the map side, before the exchange, so a hot
    group sends at most ``n`` rows per input task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in ("timestamp", *tie_break)])
    return (
        bars.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= n).drop("_rank")
    )


def chunk_number(chunk: str) -> Column:
    """Number of the fixed-length event-time chunk that a bar falls into.

    Times without zone are read in the session's zone; keep that at UTC, as ``utc_session`` does.
    """
    length = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {chunk}"))
    return F.floor(F.unix_micros(F.col("timestamp").cast("timestamp")) / length)


def add_history_in_chunks(bars: DataFrame, chunk: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """``add_history`` with the work split by (symbol, chunk).

    A chunk needs at most the 19 bars before it. These come from the tails (last 19 rows) of
    earlier chunks: 19 chunks back always suffice since a chunk that exists has a row. Bars are
    dealt by (symbol, chunk) once: tails are whole rows, so both uses of them read the same columns
    and Spark reuses that exchange, and borrowed bars are dealt likewise before they join them.
    """
    keys = ("symbol", CHUNK)
    cut = bars.withColumn(CHUNK, chunk_number(chunk)).repartition(*keys)
    order = ["timestamp", *tie_break]
    bar = F.struct(*order, *[c for c in bars.columns if c not in ("symbol", *order)])

    tails = (
        last_rows(cut, LOOKBACK_ROWS, tie_break, keys)
        .groupBy(*keys).agg(F.sort_array(F.collect_list(bar)).alias("tail"))
    )
    earlier = Window.partitionBy("symbol").orderBy(CHUNK).rowsBetween(-LOOKBACK_ROWS, -1)
    before = F.flatten(F.collect_list("tail").over(earlier))
    nearest = F.slice("before", F.greatest(F.lit(1), F.size("before") - LOOKBACK_ROWS + 1), LOOKBACK_ROWS)
    borrowed = (
        tails.select(*keys, before.alias("before"))
        .select(*keys, F.inline(nearest))
        .withColumn(BORROWED, F.lit(True)).repartition(*keys)
    )
    seeded = cut.withColumn(BORROWED, F.lit(False)).unionByName(borrowed)
    return add_history(seeded, tie_break, keys).filter(~F.col(BORROWED)).drop(CHUNK, BORROWED)


def rows_before(
    bars: DataFrame, start: Column, symbols: DataFrame, tie_break: Sequence[str] = (),
    lookback: str | None = None,
) -> DataFrame:
    """The last 19 bars before ``start`` of each of the symbols.

    With ``lookback`` the bars of that time before ``start`` are read first. Older ones are read
    only for symbols with fewer than 19 bars there; when there are none, adaptive execution drops
    that scan.
    """
    ts = F.col("timestamp")
    if lookback is None:
        return last_rows(bars.filter(ts < start), LOOKBACK_ROWS, tie_break, ["symbol"])
    edge = start - F.expr(f"INTERVAL {lookback}")
    near = last_rows(
        bars.filter((ts >= edge) & (ts < start)), LOOKBACK_ROWS, tie_break, ["symbol"]
    )
    complete = near.groupBy("symbol").count().filter(F.col("count") >= LOOKBACK_ROWS)
    short = symbols.join(complete, "symbol", "left_anti")
    far = bars.filter(ts < edge).join(short, "symbol", "left_semi")
    found = near.unionByName(last_rows(far, LOOKBACK_ROWS, tie_break, ["symbol"]))
    return last_rows(found, LOOKBACK_ROWS, tie_break, ["symbol"])


def enrich_range(
    bars_between: Callable[[Column | None, Column], DataFrame], start: Column, end: Column,
    tie_break: Sequence[str] = (), chunk: str | None = MINUTE_BAR_CHUNK, lookback: str | None = None,
) -> DataFrame:
    """Enriched bars with ``start <= timestamp < end``, equal to those of the full series.

    ``bars_between`` gives the bars from one time (NULL: from the first) up to another, so it can
    bound what they are built from. Of the bars before ``start`` only the last 19 per symbol are
    shuffled. With a ``lookback`` that usually holds 19 bars, older bars are read only for symbols
    that have fewer there; when there are none, adaptive execution drops that scan.
    """
    ts = F.col("timestamp")
    if lookback is None:
        before = last_rows(bars_between(None, start), LOOKBACK_ROWS, tie_break, ["symbol"])
        return enrich(before.unionByName(bars_between(start, end)), tie_break, chunk).filter(ts >= start)
    edge = start - F.expr(f"INTERVAL {lookback}")
    recent = bars_between(edge, end)
    short = recent.groupBy("symbol").agg(
        F.count_if(ts < start).alias("near"), F.max("timestamp").alias("last")
    ).filter((F.col("near") < LOOKBACK_ROWS) & (F.col("last") >= start)).select("symbol")
    older = bars_between(None, edge).join(short, "symbol", "left_semi")
    far = last_rows(older, LOOKBACK_ROWS, tie_break, ["symbol"])
    return enrich(far.unionByName(recent), tie_break, chunk).filter(ts >= start)
