"""Record shapes shared by every stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Fixed value: JSON body of a bar message. Every field may be absent; times travel as ISO-8601 text.
MESSAGE_BODY = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("fetch_time", T.StringType()),
])

# Topic envelope: the columns of it that the engine reads. Partition and offset tell which of two
# copies was sent last; an envelope that never was in a topic may lack them.
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# The message itself, as it stays with a parsed row until the row has found its place.
MESSAGE_COLUMNS = ["message_key", "message_value", "message_partition", "message_offset"]

PRICES = ["open", "high", "low", "close"]
BAR_COLUMNS = ["symbol", "timestamp", *PRICES, "volume"]

BAR = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    *[T.StructField(c, T.DoubleType()) for c in PRICES],
    T.StructField("volume", T.LongType()),
])

# What the per-symbol history step adds to a bar; everything else is computed row by row.
HISTORY_COLUMNS = T.StructType([
    T.StructField("prev_close", T.DoubleType()),
    T.StructField("prev_high", T.DoubleType()),
    T.StructField("prev_low", T.DoubleType()),
    T.StructField("prev_volume", T.LongType()),
    T.StructField("avg_volume_20", T.DoubleType()),
])

# The trailing frame covers the bar itself and the 19 before it.
TRAILING_ROWS = 20
LOOKBACK_ROWS = TRAILING_ROWS - 1

# Event-time length of a chunk for one-minute bars: at most 43,200 bars of a symbol. A chunk
# should hold far more than 20 bars of a typical symbol, or the borrowed bars outnumber its own.
MINUTE_BAR_CHUNK = "30 days"

MONITOR_COLUMNS = [
    "symbol", "timestamp", "close", "volume", "signal", "signal_strength",
    "volume_ratio", "price_change_pct", "stop_loss_price", "take_profit_price",
]


def with_ties(tie_break: Sequence[str]) -> list[str]:
    """The bar columns and those that decide between bars of one time, each once."""
    return list(dict.fromkeys([*BAR_COLUMNS, *tie_break]))
