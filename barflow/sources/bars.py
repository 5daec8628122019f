"""Bars from trades, the latest bar per symbol, and symbol selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.schema import BAR_COLUMNS, MINUTE_BAR_CHUNK

# Fixed value: 2**64, the width of the id range in ``time_then_id``.
ID_RANGE = "18446744073709551616"


def time_then_id(time: str, record_id: str) -> Column:
    """Event time, then a 64-bit id, as one 38-digit number of the same order.

    Spark hash-aggregates ``min_by``/``max_by`` only while the ordering is of fixed width;
    with a struct it sorts all input rows first.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp")).cast("decimal(17,0)")
    return (micros * F.expr(ID_RANGE) + F.col(record_id).cast("decimal(19,0)")).cast("decimal(38,0)")


def packed(parts: Sequence[tuple[Column, int]]) -> Column:
    """Whole numbers of at most so many digits each, as one number of the same order.

    38 digits in all. A part that is NULL, negative (but the first) or has more digits raises an
    error; it never runs into its neighbours.
    """
    if sum(digits for _, digits in parts) > 38:
        raise ValueError("a packed number has 38 digits")
    number, left, fits = F.lit(0).cast("decimal(38,0)"), sum(digits for _, digits in parts), F.lit(True)
    for i, (part, digits) in enumerate(parts):
        left -= digits
        value = part.cast("decimal(20,0)")
        fits &= F.coalesce(
            (F.abs(value) if i == 0 else value) < F.expr(f"CAST('1{'0' * digits}' AS DECIMAL(38,0))"), F.lit(False))
        if i:
            fits &= value >= 0
        number = (number + (value * F.expr(f"CAST('1{'0' * left}' AS DECIMAL({left + 1},0))")).cast("decimal(38,0)")
                  ).cast("decimal(38,0)")
    return F.when(fits, number).otherwise(
        F.raise_error(F.lit("a number has more digits than its place in the order")).cast("decimal(38,0)"))


def ohlcv(order: Column) -> list[Column]:
    """Bar aggregates over trades; ``order`` decides the first and the last trade."""
    price = F.col("price").cast("double")
    return [
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
        F.sum("quantity").cast("bigint").alias("volume"),
    ]


def build_bars(trades: DataFrame, unit: str, order: Column) -> DataFrame:
    """One bar per symbol and calendar ``unit`` that has trades.

    Trades are aggregated before the exchange, so a hot symbol costs one partial bar per
    bucket and input task.
    """
    bucket = F.date_trunc(unit, "ts").alias("timestamp")
    return trades.groupBy("symbol", bucket).agg(*ohlcv(order)).select(*BAR_COLUMNS)


def build_bars_between(
    trades: DataFrame, unit: str, order: Column, start: Column | None, end: Column
) -> DataFrame:
    """The bars with ``start <= timestamp < end``, from the trades of their buckets alone.

    Both bounds are bounds on the trades' own time, so the scan can use them.
    """
    ts, length = F.col("ts"), F.expr(f"INTERVAL 1 {unit}")
    first_left_out = F.date_trunc(unit, end)
    after = F.when(first_left_out == end, end).otherwise(first_left_out + length)
    within = trades.filter(ts < after)
    if start is not None:
        bucket = F.date_trunc(unit, start)
        within = within.filter(ts >= F.when(bucket == start, start).otherwise(bucket + length))
    return build_bars(within, unit, order)


def build_bars_stream(
    trades: DataFrame, length: str, order: Column, delay: str, offset: str = "0 seconds"
) -> DataFrame:
    """Bars of a trade stream; each is emitted once the watermark has passed its end.

    ``offset`` moves the bucket edges from the epoch: "4 days" makes weeks start on Monday.
    """
    bucket = F.window("ts", length, startTime=offset)
    return (
        trades.withWatermark("ts", delay).groupBy("symbol", bucket.alias("bucket"))
        .agg(*ohlcv(order))
        .select("symbol", F.col("bucket.start").alias("timestamp"), *BAR_COLUMNS[2:])
    )


def chunk_of(unit: str) -> str | None:
    """How to cut series of such bars into chunks of at most 43,200; None where a century of
    bars is no more than that and whole series are cheaper."""
    return {
        "second": "12 hours", "minute": MINUTE_BAR_CHUNK, "hour": "1800 days",
        "day": None, "week": None, "month": None, "quarter": None, "year": None,
    }[unit.lower()]


def latest_bar_per_symbol(bars: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """The newest bar of each symbol; a symbol without bars gives no row.

    One partial aggregation. When time alone decides, each column keeps a fixed-width buffer
    and the aggregation stays hash-based.
    """
    order = F.struct("timestamp", *tie_break) if tie_break else F.col("timestamp")
    if tie_break:
        newest = F.max_by(F.struct(*BAR_COLUMNS[1:]), order).alias("bar")
        return bars.groupBy("symbol").agg(newest).select("symbol", "bar.*")
    values = [F.max_by(c, order).alias(c) for c in BAR_COLUMNS[2:]]
    return bars.groupBy("symbol").agg(F.max("timestamp").alias("timestamp"), *values)


def coerce_bars(raw: DataFrame) -> DataFrame:
    """Bars from loosely typed columns: prices to double, volume to whole number, else NULL.

    A whole volume of 64 bits stays exact; a fraction is cut off.
    """
    whole = F.col("volume").try_cast("bigint")
    cut_off = F.col("volume").try_cast("decimal(38,9)").try_cast("bigint")
    return raw.withColumns({
        **{c: F.col(c).try_cast("double") for c in BAR_COLUMNS[2:6]},
        "volume": F.coalesce(whole, cut_off),
    })


def symbol_list(text: str) -> list[str]:
    """Symbols of a comma-separated setting."""
    return [s.strip() for s in text.split(",") if s.strip()]


def select_symbols(bars: DataFrame, symbols: Iterable[str] | DataFrame) -> DataFrame:
    """Keep the rows of the given symbols: a short list, or a table with a ``symbol`` column.

    A list becomes a filter that Spark pushes to the scan. A table becomes a semi join, which
    Spark broadcasts only below its own size limit.
    """
    if isinstance(symbols, DataFrame):
        return bars.join(symbols.select("symbol"), "symbol", "left_semi")
    return bars.filter(F.col("symbol").isin(list(symbols)))
