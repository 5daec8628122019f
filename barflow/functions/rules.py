"""The signal rules as column expressions over an enriched bar."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    """Fixed values of the six rules and the strength ladder; pass others to re-tune."""

    breakout_pct: float = 1.0
    breakout_volume: float = 1.5
    engulfing_volume: float = 1.2
    engulfing_body: float = 0.6
    drift_pct: float = 0.5
    drift_volume: float = 1.3
    very_strong: float = 2.5
    strong: float = 2.0
    moderate: float = 1.5
    weak: float = 1.2


def rule_table(t: Thresholds = Thresholds()) -> list[tuple[str, str, Column]]:
    """(rule, signal, condition) in order of precedence.

    Missing history needs no guard of its own: the comparison is then NULL, the rule does
    not match and the next one is tried.
    """
    pct, ratio = F.col("price_change_pct"), F.col("volume_ratio")
    above = F.col("close") > F.col("prev_high")
    below = F.col("close") < F.col("prev_low")
    surge = ratio > t.breakout_volume
    strong_body = (ratio > t.engulfing_volume) & (
        F.col("body_size") > (F.col("high") - F.col("low")) * t.engulfing_body
    )
    steady = ratio > t.drift_volume
    return [
        ("breakout", "BUY", above & surge & (pct > t.breakout_pct)),
        ("breakdown", "SELL", below & surge & (pct < -t.breakout_pct)),
        ("engulf_bull", "BUY", above & strong_body & (F.col("open") < F.col("prev_close"))),
        ("engulf_bear", "SELL", below & strong_body & (F.col("open") > F.col("prev_close"))),
        ("accumulation", "BUY", steady & (pct > t.drift_pct) & F.col("high_volume_up")),
        ("distribution", "SELL", steady & (pct < -t.drift_pct) & F.col("high_volume_down")),
    ]


def deciding_rule(t: Thresholds = Thresholds()) -> Column:
    """Name of the first rule that matches, NULL for none."""
    return F.coalesce(*[F.when(cond, F.lit(rule)) for rule, _, cond in rule_table(t)])


def signal(t: Thresholds = Thresholds()) -> Column:
    matches = [F.when(cond, F.lit(side)) for _, side, cond in rule_table(t)]
    return F.coalesce(*matches, F.lit("HOLD"))


def strength(t: Thresholds = Thresholds()) -> Column:
    bands = [
        (t.very_strong, "VERY_STRONG"), (t.strong, "STRONG"),
        (t.moderate, "MODERATE"), (t.weak, "WEAK"),
    ]
    reached = [F.when(F.col("volume_ratio") > floor, F.lit(label)) for floor, label in bands]
    return F.coalesce(*reached, F.lit("VERY_WEAK"))


def context() -> Column:
    return F.struct(
        F.col("volume_ratio").alias("volume_multiple"),
        F.col("price_change_pct").alias("price_move_pct"),
        F.col("body_size").alias("candle_body_size"),
        (F.col("upper_shadow") + F.col("lower_shadow")).alias("total_shadows"),
        F.col("volume_spike").alias("volume_anomaly"),
    )
