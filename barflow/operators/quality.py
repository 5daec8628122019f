"""Row constraints of the two result tables, and the split into valid rows and rejects."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.schema import PRICES

# Column limits of the result tables. A limit is the smallest magnitude that
# rounds to one digit too many.
SYMBOL_LENGTH = 10
PRICE_TYPE, PRICE_LIMIT = "decimal(10,2)", 99999999.995
RATIO_TYPE, RATIO_LIMIT = "decimal(5,2)", 999.995
SIGNALS = ["BUY", "SELL", "HOLD"]

REASON = "reject_reason"


def _first_of(checks: list[tuple[str, Column]]) -> Column:
    return F.coalesce(*[F.when(broken, F.lit(reason)) for reason, broken in checks])


def _any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def _all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)


def overflows(column: str, limit: float) -> Column:
    """The value has no place in its decimal column; NaN and infinity never have one."""
    return F.abs(F.col(column)) >= limit


def with_bar_reason(parsed: DataFrame) -> DataFrame:
    """Name what keeps a parsed message from being a bar at all, NULL for a bar.

    Only what has no place in a series is turned away here; the limits of the tables are theirs.
    """
    fields = ["symbol", "timestamp", *PRICES, "volume"]
    empty = _all_of([F.col(c).isNull() for c in fields])
    return parsed.withColumn(REASON, _first_of([
        ("malformed", empty),
        ("no symbol", F.col("symbol").isNull()),
        ("no timestamp", F.col("timestamp").isNull()),
    ]))


def with_stock_reason(bars: DataFrame) -> DataFrame:
    """Name the first constraint of the bar table that a bar breaks, NULL for none."""
    return bars.withColumn(REASON, _first_of([
        ("no symbol", F.col("symbol").isNull()),
        ("symbol too long", F.length("symbol") > SYMBOL_LENGTH),
        ("no timestamp", F.col("timestamp").isNull()),
        ("no price", _any_of([F.col(c).isNull() | F.isnan(c) for c in PRICES])),
        ("price out of range", _any_of([overflows(c, PRICE_LIMIT) for c in PRICES])),
        ("no volume", F.col("volume").isNull()),
        ("no fetch time", F.col("fetch_time").try_cast("timestamp").isNull()),
    ]))


def with_signal_reason(signals: DataFrame) -> DataFrame:
    """Name the first constraint of the signal table that a row breaks, NULL for none.

    Filters on symbol and time still reach the scan.
    """
    levels = ["stop_loss_price", "take_profit_price"]
    ratios = ["volume_ratio", "price_change_pct", "risk_reward_ratio"]
    required = ["symbol", "timestamp", *PRICES, "volume", "signal", "signal_strength"]
    # A one-element array of all but the key: the filter on the reason stays above it. Pushed
    # further down it would repeat the rules once per mention of a risk column.
    rest = [c for c in signals.columns if c not in ("symbol", "timestamp")]
    settled = signals.select("symbol", "timestamp", F.inline(F.array(F.struct(*rest)))).select(signals.columns)
    return settled.withColumn(REASON, _first_of([
        ("missing value", _any_of([F.col(c).isNull() for c in required])),
        ("symbol too long", F.length("symbol") > SYMBOL_LENGTH),
        ("unknown signal", ~F.col("signal").isin(SIGNALS)),
        *[(f"{c} out of range", overflows(c, PRICE_LIMIT)) for c in [*PRICES, *levels]],
        *[(f"{c} out of range", overflows(c, RATIO_LIMIT)) for c in ratios],
    ]))


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def rejects(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASON).isNotNull())


def trading_signals_rows(signals: DataFrame) -> DataFrame:
    """Signals in the shape of the ``trading_signals`` table; id and creation time are its own."""
    money = {f"{c}_price": c for c in PRICES}
    return signals.select(
        "symbol", "timestamp", "signal_timestamp",
        *[F.col(c).try_cast(PRICE_TYPE).alias(name) for name, c in money.items()],
        "volume", "signal", "signal_strength",
        *[F.col(c).try_cast(RATIO_TYPE).alias(c) for c in ("volume_ratio", "price_change_pct")],
        *[F.col(c).try_cast(PRICE_TYPE).alias(c) for c in ("stop_loss_price", "take_profit_price")],
        F.col("risk_reward_ratio").try_cast(RATIO_TYPE).alias("risk_reward_ratio"),
    )


def stock_data_rows(bars: DataFrame) -> DataFrame:
    """Bars in the shape of the ``stock_data`` table."""
    return bars.select(
        "symbol", "timestamp",
        *[F.col(c).try_cast(PRICE_TYPE).alias(f"{c}_price") for c in PRICES],
        "volume", F.col("fetch_time").try_cast("timestamp").alias("fetch_time"), "processing_time",
    )
