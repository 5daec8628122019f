"""Column expressions over one bar and its history columns. All run inside codegen.

A comparison with NULL is not true, so each flag is False and each guarded ratio takes its
fallback when an input is missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: volume above this multiple of its trailing average counts as a spike.
SPIKE_MULTIPLE = 1.5


def body_size() -> Column:
    return F.abs(F.col("close") - F.col("open"))


def upper_shadow() -> Column:
    return F.col("high") - F.greatest("open", "close")


def lower_shadow() -> Column:
    return F.least("open", "close") - F.col("low")


def price_change() -> Column:
    return F.col("close") - F.col("prev_close")


def price_change_pct() -> Column:
    """Percent move from the previous close; 0 where there is none or it is zero."""
    move = F.col("price_change") / F.col("prev_close") * 100
    return F.when(F.col("prev_close") != 0, move).otherwise(0.0)


def volume_ratio() -> Column:
    """Volume over its trailing average; 1 where that average is not positive."""
    ratio = F.col("volume") / F.col("avg_volume_20")
    return F.when(F.col("avg_volume_20") > 0, ratio).otherwise(1.0)


def volume_spike() -> Column:
    return F.coalesce(F.col("volume_ratio") > SPIKE_MULTIPLE, F.lit(False))


def high_volume_up() -> Column:
    rising = (F.col("price_change") > 0) & (F.col("volume_ratio") > SPIKE_MULTIPLE)
    return F.coalesce(rising, F.lit(False))


def high_volume_down() -> Column:
    falling = (F.col("price_change") < 0) & (F.col("volume_ratio") > SPIKE_MULTIPLE)
    return F.coalesce(falling, F.lit(False))
