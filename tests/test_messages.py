"""Encoding, parsing and constraints, with ANSI mode on and off."""

import math
from datetime import datetime

import pytest
from helpers import BASE, bar_frame, series
from pyspark.sql import functions as F

from barflow.operators import quality
from barflow.operators.signals import signals_with_risk
from barflow.operators.enrich import enrich
from barflow.schema import BAR_COLUMNS, ENVELOPE
from barflow.sources import bars as bs
from barflow.sources import messages
from barflow.sources.topic import TopicSettings, sink_options, source_options

SENT = datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture(params=["true", "false"])
def either_ansi(request, spark):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.unset("spark.sql.ansi.enabled")


def parsed(spark, *bodies):
    rows = [(None, b if b is None else bytearray(b.encode()), SENT, 0, i) for i, b in enumerate(bodies)]
    return messages.parse(spark.createDataFrame(rows, ENVELOPE))


def test_dirty_bodies(either_ansi):
    rows = parsed(
        either_ansi, "{bad", None, '{"symbol":"A","volume":"x","open":1.5}',
        '{"symbol":"A","volume":1.5}', '{"symbol":"A","timestamp":"never"}',
        '{"symbol":"A","timestamp":"2024-01-02T03:04:05.000006","other":1}',
    ).collect()
    assert len(rows) == 6
    for row in rows[:2]:
        assert [row[c] for c in BAR_COLUMNS] == [None] * 7
        assert row["kafka_timestamp"] == SENT
    assert (rows[2]["symbol"], rows[2]["volume"], rows[2]["open"]) == ("A", None, 1.5)
    assert (rows[3]["symbol"], rows[3]["volume"]) == ("A", None)
    assert rows[4]["timestamp"] is None
    assert rows[5]["timestamp"] == datetime(2024, 1, 2, 3, 4, 5, 6)
    assert rows[5]["processing_time"] is not None


def test_bar_reasons(either_ansi):
    nan, big = float("nan"), 99999999.995
    t = SENT
    cases = [
        ((None,) * 7, "malformed"),
        ((None, t, 1.0, 1.0, 1.0, 1.0, 1), "no symbol"),
        (("A", None, 1.0, 1.0, 1.0, 1.0, 1), "no timestamp"),
    ]
    for_the_table = [
        (("ABCDEFGHIJK", t, 1.0, 1.0, 1.0, 1.0, 1), "symbol too long"),
        (("A", t, 1.0, None, 1.0, 1.0, 1), "no price"),
        (("A", t, 1.0, 1.0, nan, 1.0, 1), "no price"),
        (("A", t, 1.0, 1.0, 1.0, big, 1), "price out of range"),
        (("A", t, 1.0, 1.0, -math.inf, 1.0, 1), "price out of range"),
        (("A", t, 1.0, 1.0, 1.0, 1.0, None), "no volume"),
        (("ABCDEFGHIJ", t, 1.0, 1.0, 1.0, 99999999.99, 1), None),
    ]
    rows = [c for c, _ in cases + for_the_table]
    checked = quality.with_bar_reason(bar_frame(either_ansi, rows))
    assert [r[quality.REASON] for r in checked.collect()] == [r for _, r in cases] + [None] * len(for_the_table)
    assert quality.valid(checked).count() + quality.rejects(checked).count() == len(rows)
    bars = quality.valid(checked).withColumn("fetch_time", F.lit("2024-01-02T03:04:05"))
    checked = quality.with_stock_reason(bars)
    assert [r[quality.REASON] for r in checked.collect()] == [r for _, r in for_the_table]
    for time in ("never", None):
        late = quality.with_stock_reason(bars.filter("symbol = 'ABCDEFGHIJ'").withColumn("fetch_time", F.lit(time)))
        assert late.first()[quality.REASON] == "no fetch time"


def test_rejects_keep_their_message(spark):
    (row,) = quality.rejects(quality.with_bar_reason(parsed(spark, "{bad payload 42"))).collect()
    assert bytes(row["message_value"]) == b"{bad payload 42"


def test_signal_reason_lets_filters_through(spark, tmp_path):
    bar_frame(spark, series("A", [BASE] * 3)).write.parquet(str(tmp_path / "bars"))
    bars = spark.read.parquet(str(tmp_path / "bars"))
    checked = quality.with_signal_reason(signals_with_risk(enrich(bars, chunk=None)))
    text = checked.filter("symbol = 'A'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(symbol,A)" in text


@pytest.mark.parametrize("limit, kind", [
    (quality.PRICE_LIMIT, quality.PRICE_TYPE), (quality.RATIO_LIMIT, quality.RATIO_TYPE),
])
def test_limits_are_those_of_the_decimal_columns(spark, limit, kind):
    below = math.nextafter(limit, 0)
    rows = spark.createDataFrame([(v,) for v in (limit, -limit, below, -below, math.nan)], "x double")
    for row in rows.select(
        F.col("x").try_cast(kind).isNull().alias("lost"), quality.overflows("x", limit).alias("told")
    ).collect():
        assert row["lost"] == row["told"]


def test_signal_rows(either_ansi):
    rows = series("A", [*[BASE] * 4, (100.0, 104.0, 99.5, 103.0, 400)]) + series(
        "BIG", [*[(1.0, 1.0, 1.0, 1.0, 100)] * 4, (1.0, 2000.0, 1.0, 2000.0, 400)])
    checked = quality.with_signal_reason(signals_with_risk(enrich(bar_frame(either_ansi, rows))))
    (row,) = quality.trading_signals_rows(quality.valid(checked)).collect()
    assert (row["symbol"], str(row["close_price"]), str(row["volume_ratio"])) == ("A", "103.00", "2.50")
    assert (str(row["stop_loss_price"]), str(row["risk_reward_ratio"])) == ("100.94", "1.50")
    (bad,) = quality.rejects(checked).collect()
    assert (bad["symbol"], bad[quality.REASON]) == ("BIG", "price_change_pct out of range")


def test_round_trip_keeps_nulls_and_micros(spark):
    rows = [("A", datetime(2024, 1, 1, 0, 0, 0, 1), 0.1, 1e-9, 1e9, None, 2**62), ("", SENT, *BASE)]
    sent = messages.encode(bar_frame(spark, rows))
    assert [r["key"] and bytes(r["key"]) for r in sent.collect()] == [b"A", None]
    back = messages.bars_of(messages.parse(sent)).collect()
    assert [tuple(r) for r in back] == rows


def test_last_copy_counts(spark):
    old = messages.encode(bar_frame(spark, series("A", [BASE] * 3)), sent_at=F.lit(SENT))
    new = messages.encode(bar_frame(spark, series("A", [(1.0, 2.0, 0.5, None, 7)])))
    parsed_all = messages.parse(new.unionByName(old).unionByName(old))
    rows = messages.last_copies(parsed_all).orderBy("timestamp").collect()
    assert [tuple(r[c] for c in BAR_COLUMNS[2:]) for r in rows] == [(1.0, 2.0, 0.5, None, 7), BASE, BASE]


def test_copies_of_one_instant_are_told_apart(spark):
    """By offset; without one by what they say. The order of reading plays no part."""
    sent = [messages.encode(bar_frame(spark, series("A", [(1.0, 2.0, 0.5, close, 7)])), F.lit(SENT), F.lit(SENT))
            for close in (10.0, 11.5, 12.0)]
    numbered = [s.withColumns({"partition": F.lit(3), "offset": F.lit(o).cast("bigint")})
                for s, o in zip(sent, (5, 9, 7))]
    for frames, expected in ((numbered, 11.5), (sent, None)):
        found = {
            messages.last_copies(messages.parse(a.unionByName(b).unionByName(c))).first()["close"]
            for a, b, c in (frames, frames[::-1])
        }
        assert len(found) == 1 and expected in (None, *found)


def test_topic_options():
    settings = TopicSettings.from_env({"KAFKA_TOPIC": "t", "STOCK_SYMBOLS": "A, B,"})
    assert (settings.servers, settings.topic, settings.symbols) == ("localhost:9092", "t", ["A", "B"])
    assert TopicSettings.from_env({}).symbols == ["AAPL", "GOOGL", "MSFT"]
    assert source_options(settings, maxOffsetsPerTrigger="5") == {
        "kafka.bootstrap.servers": "localhost:9092", "subscribe": "t",
        "startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "5",
    }
    options = sink_options(settings)
    assert options["topic"] == "t"
    assert (options["kafka.acks"], options["kafka.retries"]) == ("all", "3")


def test_symbol_selection(spark):
    bars = bar_frame(spark, [r for s in "ABC" for r in series(s, [BASE] * 3)])
    by_list = bs.select_symbols(bars, ["A", "C"])
    by_table = bs.select_symbols(bars, spark.createDataFrame([("A",), ("C",), ("C",)], "symbol string"))
    assert by_list.count() == by_table.count() == 6


def test_latest_bar(spark):
    bars = bar_frame(spark, [r for s in "AB" for r in series(s, [BASE, (1.0, 2.0, 0.5, None, 7)])])
    for found in (bs.latest_bar_per_symbol(bars), bs.latest_bar_per_symbol(bars, ["volume"])):
        rows = {r["symbol"]: r for r in found.collect()}
        assert set(rows) == {"A", "B"}
        assert rows["A"]["open"] == 1.0 and rows["A"]["timestamp"].minute == 1


def test_latest_bar_keeps_missing_values_of_the_newest_row(spark):
    bars = bar_frame(spark, series("A", [BASE, (1.0, 2.0, 0.5, None, 7)]))
    assert bs.latest_bar_per_symbol(bars).first()["close"] is None


def test_coercion(either_ansi):
    raw = either_ansi.createDataFrame(
        [("A", SENT, "1.5", "x", "2", None, "7.9"), ("A", SENT, "1", "1", "1", "1", "9007199254740993")],
        "symbol string, timestamp timestamp, open string, high string, low string, close string, volume string",
    )
    row, large = bs.coerce_bars(raw).collect()
    assert large["volume"] == 9007199254740993
    assert [row[c] for c in BAR_COLUMNS[2:]] == [1.5, None, 2.0, None, 7]


def test_time_then_id_orders_like_the_pair(spark):
    pairs = [(t, i) for t in (0, 1, 1704067200000000) for i in (-2**63, -1, 0, 1, 2**63 - 1)]
    frame = spark.createDataFrame(pairs, "micros long, id long").withColumn(
        "ts", F.timestamp_micros("micros"))
    ordered = frame.orderBy(bs.time_then_id("ts", "id")).collect()
    assert [(r["micros"], r["id"]) for r in ordered] == sorted(pairs)
