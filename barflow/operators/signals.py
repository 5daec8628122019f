"""Classification of enriched bars, and the risk columns of a signal."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.functions import rules
from barflow.functions.rules import Thresholds
from barflow.schema import MONITOR_COLUMNS


def classify(enriched: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Add signal, strength, context and decision time to every bar, HOLD included."""
    return enriched.withColumns({
        "signal": rules.signal(thresholds),
        "signal_strength": rules.strength(thresholds),
        "signal_context": rules.context(),
        "signal_timestamp": F.current_timestamp(),
    })


def actionable(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("signal").isin("BUY", "SELL"))


def generate_trading_signals(
    enriched: DataFrame, thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """The actionable signals of enriched bars."""
    return actionable(classify(enriched, thresholds))


@dataclass(frozen=True)
class RiskLevels:
    """Price multiples of the stop and the target, for a long and a short."""

    long_stop: float = 0.98
    long_target: float = 1.03
    short_stop: float = 1.02
    short_target: float = 0.97


def add_risk_management_metrics(
    signals: DataFrame, levels: RiskLevels = RiskLevels()
) -> DataFrame:
    """Stop, target and reward per unit of risk; NULL for HOLD and where the risk is zero."""
    buy, sell, close = F.col("signal") == "BUY", F.col("signal") == "SELL", F.col("close")
    stop, target = F.col("stop_loss_price"), F.col("take_profit_price")
    with_levels = signals.withColumns({
        "stop_loss_price":
            F.when(buy, close * levels.long_stop).when(sell, close * levels.short_stop),
        "take_profit_price":
            F.when(buy, close * levels.long_target).when(sell, close * levels.short_target),
    })
    return with_levels.withColumn(
        "risk_reward_ratio",
        F.when(buy, F.try_divide(target - close, close - stop))
        .when(sell, F.try_divide(close - target, stop - close)),
    )


def signals_with_risk(enriched: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    return add_risk_management_metrics(generate_trading_signals(enriched, thresholds))


def monitor(signals: DataFrame) -> DataFrame:
    """The ten columns shown to an operator."""
    return signals.select(*MONITOR_COLUMNS)
